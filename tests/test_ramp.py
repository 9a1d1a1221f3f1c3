"""Ramps where several samples share a second."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from sievemark.operators import retry
from sievemark.plans import catalog

DAY = 86400
#: event_id, user_id, seconds, value: user 1 begins with a tied second, user 2 has a tie later, user 3 has one event.
EVENTS = [(7, 1, 100.2, 5.0), (3, 1, 100.9, 8.0), (9, 1, 160.0, 20.0), (10, 1, 100.0 + DAY, 1.0), (11, 1, 101.0 + DAY, 2.0), (12, 2, 50.0, 1.0), (13, 2, 60.1, 4.0), (14, 2, 60.2, 6.0), (15, 2, 60.0 + DAY, 9.0), (16, 3, 5.0, 2.0)]


def brute(events):
    out = {}
    for i, user, s, value in events:
        first = min((int(z), j, v) for j, u, z, v in events if u == user and int(s) - DAY <= int(z) <= int(s))
        span = int(s) - first[0]
        out[i] = round((value - first[2]) / span, 6) if span else 0.0
    return out


def test_every_event_has_a_ramp(spark, tmp_path):
    rows = [(i, datetime.fromtimestamp(s, UTC), u, v) for i, u, s, v in EVENTS]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = catalog.QUERIES["ramp_rate"](spark, str(tmp_path)).collect()
    assert len(got) == len(EVENTS)
    assert {r.event_id: r.ramp for r in got} == brute(EVENTS)


def test_a_tie_does_not_depend_on_the_order_of_rows(spark):
    rows = [(u, float(int(s)), v, i) for i, u, s, v in EVENTS]
    for given in (rows, rows[::-1]):
        found = retry.ramp(spark.createDataFrame(given, "user_id long, ts double, used double, n long").coalesce(1), "user_id", DAY, "n")
        assert {r.n: r.ramp for r in found.select("n", F.round("ramp", 6).alias("ramp")).collect()} == brute(EVENTS)

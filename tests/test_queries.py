"""Every query of the catalog runs, and agrees with its SQL twin where it has one."""

import pytest

from sievemark.operators.profile import hashed_embedding
from sievemark.plans import catalog

from .oracle import connect, same

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, con, name):
    same(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name])


def test_every_query_without_a_twin_is_tested_below():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"embed_offerings"}


def test_embed_offerings(spark):
    names = {r.p_name for r in spark.read.parquet(f"{SF}/part.parquet").select("p_name").collect()}
    got = [(r.text, list(r.embedding)) for r in catalog.QUERIES["embed_offerings"](spark, SF).collect()]
    assert sorted(got) == sorted((x, hashed_embedding([x])[0]) for x in names)

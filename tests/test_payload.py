"""Payload forms, evidence, presence answers, and how often a model is asked."""

import json

import pytest
from pyspark.sql import functions as F

from sievemark.operators import passes, payload


def parsed(spark, *payloads, unwrap=True):
    rows = [(i, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)]
    df = payload.salvage(spark.createDataFrame(rows, "i int, raw string"), "raw", unwrap)
    out = df.select("i", payload.offering_list(F.col("json")).alias("o")).orderBy("i").collect()
    return [[(x.type, x.name, x.description, list(x.tags)) for x in (r.o or [])] for r in out]


def test_forms(spark):
    one = {"name": "Pump", "type": "product", "description": "Moves water."}
    pump = ("product", "Pump", "Moves water.", [])
    got = parsed(
        spark,
        {"offerings": [one]}, {"items": [one]}, {"products": [{"name": "Pump", "description": "Moves water."}, "Valve"]}, {"services": ["Repair", {"title": "Care", "summary": "All year"}, 5, None]},
        one, [one, {"offerings": [{"label": "Crane", "kind": "goods"}]}, "no", [one]], {"content": json.dumps({"offerings": [one]})}, {"result": "Sure: " + json.dumps({"items": [one]}) + " done"},
        {"data": "nothing", "output": json.dumps([one])}, "Here you go: " + json.dumps({"offerings": [one]}) + " bye", '{"a": 1} and then {"offerings": [{"name": "Pump", "type": "x", "description": "Moves water."}]}',
        "no json at all", None, "", {"offerings": "Pump"}, {"name": "Pump"}, {"name": "Pump", "tags": []}, '{"offerings": [{"name": "Pump", "name": "Pumps", "type": "product"}]}',
    )
    assert got == [
        [pump], [pump], [pump, ("product", "Valve", "Valve", [])], [("service", "Repair", "Repair", []), ("service", "Care", "All year", [])],
        [pump], [pump, ("product", "Crane", "Crane", [])], [pump], [pump],
        [pump], [pump], [pump],
        [], [], [], [], [], [("product", "Pump", "Pump", [])], [("product", "Pumps", "Pumps", [])],
    ]
    assert parsed(spark, {"content": json.dumps({"offerings": [one]})}, unwrap=False) == [[]]


@pytest.mark.parametrize(
    ("said", "kind"),
    [({"type": "Solutions"}, "service"), ({"category": "svc"}, "service"), ({"kind": "Brand"}, "product"), ({"type": "hardware"}, "product"), ({"type": ""}, "product"), ({"name": "Managed hosting"}, "service"), ({"type": "thing", "tags": ["repair shop"]}, "service"), ({"type": "x", "description": "On-site inspections"}, "service"), ({"type": 0, "kind": "service"}, "service")],
)
def test_types(spark, said, kind):
    assert parsed(spark, {"offerings": [{"name": "Thing", "description": "A thing"} | said]})[0][0][0] == kind


def test_fields(spark):
    long = "w" * 600
    got = parsed(
        spark,
        {"offerings": [{"name": "  Big  \n pump ", "details": long, "keywords": "a | B|b ||A | home"}]}, {"offerings": [{"title": 12, "name": "", "summary": False, "description": None, "key_terms": [1, None, True, "x" * 70, {"k": 1}]}]},
        {"offerings": [{"label": "n" * 200, "tag": "one; two, three"}, {"name": "  "}, {"description": "no name"}]}, {"offerings": [{"name": "T", "tags": [f"t{i // 2}" for i in range(40)]}]}, {"products": [{"name": "P", "type": None, "kind": "service"}]}, {"services": [{"name": "S", "type": "product"}]},
    )
    assert got[0] == [("product", "Big pump", "w" * 520, ["a", "B"])]
    assert got[1] == [("product", "12", "12", ["1", "True", "x" * 50, '{"k":1}'])]
    assert got[2] == [("product", "n" * 160, "n" * 160, ["one", "two, three"])]
    assert got[3] == [("product", "T", "T", [f"t{i}" for i in range(10)])]
    assert got[4] == [("service", "P", "P", [])] and got[5] == [("product", "S", "S", [])]


def test_one_of_each_name(spark):
    a = {"name": "Pump", "type": "product"}
    got = parsed(spark, {"offerings": [a | {"description": "short"}, {"name": "Other"}, a | {"name": "PUMP", "description": "longer text"}, a | {"description": "longer tex2", "tags": ["t"]}, a | {"type": "service"}]})
    assert got == [[("product", "Other", "Other", []), ("product", "Pump", "longer tex2", ["t"]), ("service", "Pump", "Pump", [])]]
    many = {"offerings": [{"name": f"n{i % 2500}", "description": "d" * (i % 7)} for i in range(20_000)]}
    assert [len(x) for x in parsed(spark, many)] == [2500]


PAGE = "menu Careers\n# We build robot arms\nOur arms have Grippers and CoolFlow™ valves. Extra_words here."


@pytest.mark.parametrize(
    ("name", "description", "tags", "page", "stays"),
    [
        ("Careers", "", ["x"], PAGE, False), ("Services", "", ["x"], PAGE, True), ("ROBOT arms", "", [], PAGE, True), ("CoolFlow", "", [], PAGE, True), ("Coolflow® valves", "", [], PAGE, True), ("menu", "", [], PAGE, False),
        ("Zzzz", "robots with grippers", [], PAGE, False), ("Zzzz", "arms with grippers", [], PAGE, True), ("Zzzz", "extra with from this", [], PAGE, False), ("Zzzz", "d" * 39, [], PAGE, False), ("Zzzz", "d" * 40, [], PAGE, True),
        ("z" * 45, "Z" * 45, [], PAGE, False), ("Zzzz", "", [], "", True), ("Zzzz", "", [], None, True), ("grip", "", [], PAGE, True), ("xgrippers", "", [], PAGE, False), ("sign  in", "", ["x"], PAGE, False),
    ],
)
def test_evidence(spark, name, description, tags, page, stays):
    row = spark.createDataFrame([([("product", name, description, tags)], page)], "o array<struct<type:string,name:string,description:string,tags:array<string>>>, page string")
    assert (row.select(F.size(payload.supported(F.col("o"), F.col("page")))).first()[0] == 1) is stays


@pytest.mark.parametrize(
    ("raw", "has", "confidence"),
    [
        ('{"r":1}', True, None), ('{"r": 0, "confidence": 0.4}', False, 0.4), ("yes", True, None), (" NO ", False, None), ("[1]", True, None), ("[]", False, None), ('[{"present":"yes","p":0.5}, 0]', True, 0.5), ("true", True, None), ("1.0", True, None), ("2", False, None),
        ('{"presence":"no","score":1.5,"p":0.2}', False, 0.2), ('{"r":1,"score":1.5,"p":0.2}', True, None), ('so {"r":1} it is', True, None), ("maybe", False, None), ("1 or so", False, None), ('{"x": "a} b", "r": 1}', True, None), (None, False, None), ('{"r":"maybe","value":true}', True, None), ('{"x":1,"prob":"0.7"}', False, 0.7), ('"yes"', True, None), ("[[1]]", False, None), ('{"r":2,"result":1}', True, None),
    ],
)
def test_presence(spark, raw, has, confidence):
    df = payload.salvage(spark.createDataFrame([(raw,)], "raw string"), "raw", unwrap=False)
    assert tuple(df.select(payload.presence(F.col("json"), F.col("raw")).alias("p")).select("p.*").first()) == (has, confidence)


def test_a_model_is_asked_once_a_page(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def extract(bodies):
        import os
        import uuid

        with open(os.path.join(str(asked), uuid.uuid4().hex), "w") as f:
            f.write(str(len(bodies)))
        return [json.dumps({"products": [b.split()[0], "Careers"]}) for b in bodies]

    pages = spark.createDataFrame([(i, f"u{i}", "x.md" if i % 5 else None, f"word{i} page" if i % 7 else " ") for i in range(200)], "company_id int, url string, markdown_path string, body string")
    patches, products = passes.full_pass(pages, extract)
    want = [i for i in range(200) if i % 5 and i % 7]
    assert sorted(r.company_id for r in products.collect()) == want
    assert {r.company_id for r in patches.where("presence = 1").collect()} == set(want) and patches.count() == 200
    assert sum(int(f.read_text()) for f in asked.iterdir()) == len(want)

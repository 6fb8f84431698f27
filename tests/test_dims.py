import random

from paytide.model import schema
from paytide.operators.dims import dim_upsert

BASE = schema("customer_id BIGINT, name STRING, country STRING")
UPDATE = "customer_id BIGINT, version INT, sets ARRAY<STRING>, name STRING, country STRING"


def upsert(spark, base, updates):
    out = dim_upsert(spark.createDataFrame(base, BASE), spark.createDataFrame(updates, UPDATE), "customer_id")
    assert out.columns == BASE.names
    return sorted((tuple(r) for r in out.collect()), key=lambda r: r[0])


def test_partial_update_keeps_other_columns(spark):
    assert upsert(spark, [(1, "a", "PK"), (2, "b", "US")], [(1, 1, ["name"], "z", None)]) == [(1, "z", "PK"), (2, "b", "US")]


def test_explicit_null_overwrites_and_absence_does_not(spark):
    assert upsert(spark, [(1, "a", "PK")], [(1, 1, ["country"], None, None)]) == [(1, "a", None)]
    assert upsert(spark, [(1, "a", "PK")], [(1, 1, [], "x", "y")]) == [(1, "a", "PK")]


def test_each_column_takes_its_newest_update(spark):
    updates = [(1, 2, ["name"], "new", None), (1, 1, ["name", "country"], "old", "DE"), (1, 3, ["country"], None, None)]
    assert upsert(spark, [(1, "a", "PK")], updates) == [(1, "new", None)]


def test_unknown_key_is_inserted(spark):
    assert upsert(spark, [], [(5, 1, ["name"], "n", None)]) == [(5, "n", None)]


def test_equals_applying_updates_one_by_one(spark):
    rng = random.Random(3)
    base = {k: {"name": f"n{k}", "country": f"c{k}"} for k in range(20)}
    rows = [(k, v["name"], v["country"]) for k, v in base.items()]
    updates = []
    for version in range(200):
        key = 7 if rng.random() < 0.4 else rng.randrange(30)  # one key gets very many
        sets = [c for c in ("name", "country") if rng.random() < 0.5]
        values = {c: rng.choice([None, f"v{version}"]) for c in sets}
        updates.append((key, version, sets, values.get("name"), values.get("country")))
        base.setdefault(key, {"name": None, "country": None}).update(values)
    rng.shuffle(updates)
    assert upsert(spark, rows, updates) == sorted((k, v["name"], v["country"]) for k, v in base.items())

import pytest

from paytide.functions.clock import typed_time
from paytide.operators import quality
from paytide.sources import sample
from rows import CUSTOMERS, DEVICES, fact, raw, same, txn

SF = "/root/testdata/sf0.01"

BAD = {
    "t1": (txn(1, when="2024-13-01 00:00:00"), "bad_timestamp"),
    "t2": (txn(2, when=None), "bad_timestamp"),
    "t3": (txn(3, device=None), "null_key"),
    "t4": (txn(4, amount=-0.01), "bad_amount"),
    "t5": (txn(5, amount=float("nan")), "bad_amount"),
    "t6": (txn(6, amount=float("inf")), "bad_amount"),
    "t7": (txn(7, status="success"), "unknown_status"),
    "t8": (txn(8, status=None, amount=None, method=None, when="junk"), "bad_timestamp,null_key,bad_amount,unknown_status"),
    "t9": (txn(9, when="2024-01-01T10:00:00"), "bad_timestamp"),
}
GOOD = [txn(20), txn(21, amount=0.0), txn(22, amount=-0.0, status="Fraud")]


def test_reasons(spark):
    facts = raw(spark, [row for row, _codes in BAD.values()] + GOOD)
    got = {r.transaction_id: r.reasons for r in quality.quarantine(facts).collect()}
    assert got == {key: codes for key, (_row, codes) in BAD.items()}


def test_good_and_bad_are_an_exact_split(spark):
    facts = raw(spark, [row for row, _codes in BAD.values()] + GOOD)
    valid = quality.clean_valid(facts)
    assert sorted(r.transaction_id for r in valid.collect()) == ["t20", "t21", "t22"]
    same(valid, fact(spark, GOOD))
    assert valid.count() + quality.quarantine(facts).count() == facts.count()


def test_typed_time_is_null_for_bad_text(spark):
    assert [r.txn_date for r in typed_time(raw(spark, [txn(1, when="junk")])).collect()] == [None]


def test_orphans_and_nulls_are_apart(spark):
    facts = fact(spark, [txn(1, customer=9), txn(2, customer=9), txn(3, customer=None), txn(4, customer=1), txn(5, device=8)])
    dims = {
        "customer_id": spark.createDataFrame([(1, "New"), (1, "New"), (None, "Loyal")], CUSTOMERS),
        "device_id": spark.createDataFrame([(1, "Mobile")], DEVICES),
    }
    got = {r.dim: (r.orphan_keys, r.orphan_rows, r.null_rows) for r in quality.ri_orphans(facts, dims).collect()}
    assert got == {"customer_id": (1, 2, 1), "device_id": (1, 1, 0)}


def test_labels_agree_only_when_all_bands_do(spark):
    facts = fact(spark, [
        txn(1, amount=100.0, took=100.0, score=0.2),
        txn(2, amount=6000.0, took=1000.0, score=0.8, status="Fraud"),
        txn(3, amount=6000.0, took=1000.0, score=0.8),
        txn(4, amount=100.0, took=500.0, score=0.2),
    ])
    got = {(r.status, r.amount_band, r.latency_band, r.score_band): r.agrees for r in quality.label_consistency(facts).collect()}
    assert got == {
        ("Success", "normal", "normal", "normal"): True,
        ("Fraud", "fraud", "fraud", "fraud"): True,
        ("Success", "fraud", "fraud", "fraud"): False,
        ("Success", "normal", "other", "normal"): False,
    }


def test_profile_counts(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", -0.0), (None, 0.0), ("b", None)], "name STRING, x DOUBLE")
    got = {r.column: tuple(r)[1:] for r in quality.column_profile(df).collect()}
    assert got == {"name": (4, 1, 2, None, None), "x": (4, 1, 2, 0.0, 1.5)}
    assert {r.column: tuple(r)[1:] for r in quality.column_profile_approx(df).collect()} == got


def test_approximate_profile_is_within_three_percent(spark):
    facts = sample.faulty_feed(spark, SF)
    exact = {r.column: r for r in quality.column_profile(facts).collect()}
    for row in quality.column_profile_approx(facts).collect():
        want = exact[row.column]
        assert (row.rows, row.nulls, row.min_value, row.max_value) == (want.rows, want.nulls, want.min_value, want.max_value)
        assert row.distinct_values == pytest.approx(want.distinct_values, rel=0.03)

import math

import pytest
from pyspark.sql import functions as F

from paytide.operators import dims, kpis, time_kpis
from paytide.operators.enrich import LABELS
from paytide.operators.latency import BUCKETS, kpi_latency, kpi_latency_approx
from paytide.operators.totals import totals
from paytide.plans import one_pass
from rows import CUSTOMERS, DEVICES, MERCHANTS, METHODS, at, fact, same, txn

ROWS = [
    txn(1, amount=10.0, when="2024-01-01 10:00:00"),
    txn(2, amount=20.5, when="2024-01-01 11:00:00", merchant=2, status="Fraud"),
    txn(3, amount=None, when="2024-01-02 10:00:00", customer=2),
    txn(4, amount=5.25, when="junk", customer=None, merchant=99),
    txn(5, amount=1.0, when=None, merchant=None, customer=77, method=None, device=None),
    txn(6, amount=0.1, when="2024-01-02 10:00:00", customer=2, method=2, device=2),
    txn(7, amount=0.2, when="2024-01-02 10:00:00", customer=2, method=2, device=2, status="Fraud"),
]


@pytest.fixture(scope="module")
def star(spark):
    return {
        "merchant": spark.createDataFrame([(1, "Travel"), (2, "Gaming"), (2, "Fashion"), (5, None)], MERCHANTS),
        "customer": spark.createDataFrame([(1, "New"), (2, "Loyal")], CUSTOMERS),
        "payment": spark.createDataFrame([(1, "Card"), (2, "Wallet")], METHODS),
        "device": spark.createDataFrame([(1, "Mobile"), (2, None)], DEVICES),
    }


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_global_counts_rows_without_amount_but_averages_without_them(spark):
    count, total, average = rows(kpis.kpi_global(fact(spark, ROWS)))[0]
    assert (count, total) == (7, 37.05)
    assert average == 37.05 / 6


def test_global_over_nothing_is_one_row(spark):
    assert rows(kpis.kpi_global(fact(spark, []))) == [(0, None, None)]


def test_daily_has_a_null_day_first(spark):
    daily = rows(kpis.kpi_daily(fact(spark, ROWS)))
    assert [(str(d), n) for d, n, _total, _average in daily] == [("None", 2), ("2024-01-01", 2), ("2024-01-02", 3)]
    assert daily[2][2:] == (0.3, 0.15)


def test_inner_join_drops_unknown_keys_and_fans_out_over_duplicates(spark, star):
    got = rows(kpis.kpi_by_merchant_category(fact(spark, ROWS), star["merchant"]))
    assert got == [("Fashion", 1, 20.5, 20.5), ("Gaming", 1, 20.5, 20.5), ("Travel", 4, 10.3, 10.3 / 3)]


def test_group_without_any_amount_has_null_average(spark, star):
    only = fact(spark, [txn(1, amount=None)])
    assert rows(kpis.kpi_by_customer_segment(only, star["customer"])) == [("New", 1, None, None)]


def brute_force(spark, facts, star):
    """All groupings with plain row-level joins."""
    def agg(df, kpi, label):
        units = F.sum(F.col("transaction_amount").cast("decimal(18,2)"))
        out = df.groupBy(label.cast("string").alias("dim_value")).agg(
            F.count("*").alias("transactions"), units.cast("double").alias("total"),
            (units.cast("double") / F.count("transaction_amount")).alias("average"),
        )
        return out.select(F.lit(kpi).alias("kpi"), "*")
    parts = [agg(facts, "global", F.lit(None)), agg(facts, "daily", F.col("txn_date"))]
    for kpi, dim in star.items():
        key, label = LABELS[kpi]
        parts.append(agg(facts.join(dim, key), kpi, F.col(label)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_one_pass_equals_separate_joins(spark, star, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        facts = fact(spark, ROWS)
        same(one_pass.kpi_all_one_pass(facts, star), brute_force(spark, facts, star))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_pass_through_a_parent_equals_the_joined_fact(spark, star):
    header = spark.createDataFrame(
        [(1, 1, 1), (2, 2, 2), (3, None, 1), (4, 88, None)], "order_id BIGINT, customer_id BIGINT, payment_method_id INT"
    )
    lines = fact(spark, ROWS).drop("customer_id", "payment_method_id").withColumn(
        "order_id", F.substring("transaction_id", 2, 1).cast("bigint") % 6
    )
    joined = lines.join(header, "order_id", "left")
    same(one_pass.kpi_all_one_pass(lines, star, (header, "order_id")), brute_force(spark, joined, star))


def test_one_pass_over_nothing_has_the_global_row(spark, star):
    assert rows(one_pass.kpi_all_one_pass(fact(spark, []), star)) == [("global", None, 0, None, None)]


def test_fraud_rate(spark, star):
    got = {(r.kpi, r.dim_value): r.fraud_rate_pct for r in one_pass.kpi_fraud_rate(fact(spark, ROWS), star).collect()}
    assert got["global", None] == 100.0 * 2 / 7
    assert got["payment", "Wallet"] == 50.0
    assert got["merchant", "Gaming"] == 100.0


def test_shares_add_up(spark, star):
    shares = [r.share for r in kpis.payment_share(fact(spark, ROWS), star["payment"]).collect()]
    assert math.isclose(sum(shares), 1.0)


def test_daily_totals_add_up_to_the_global_total(spark):
    facts = fact(spark, ROWS)
    daily = kpis.kpi_daily(facts).agg(F.sum("transactions"), F.sum("total_volume")).first()
    whole = kpis.kpi_global(facts).first()
    assert daily[0] == whole[0] and math.isclose(daily[1], whole[1])


def test_overview_of_nothing_is_zero(spark):
    card = kpis.overview_cards(fact(spark, [])).first()
    assert (card.total_transactions, card.total_revenue, card.avg_of_daily_avg) == (0, 0.0, 0)


def test_overview_shows_both_averages(spark):
    facts = fact(spark, [txn(1, amount=10.0), txn(2, amount=20.0), txn(3, amount=100.0, when="2024-01-02 00:00:00")])
    card = kpis.overview_cards(facts).first()
    assert card.avg_of_daily_avg == 57  # (15 + 100) / 2, cut
    assert card.avg_value == 130.0 / 3


def test_calendar_has_every_slot_and_marks_weekends(spark):
    slots = dims.calendar(dims.datetime_document(spark)).collect()
    assert len({(s.weekday, s.hour) for s in slots}) == len(slots) == 168
    assert {s.day_of_week for s in slots if s.is_weekend} == {"Sat", "Sun"}
    facts = fact(spark, [txn(1, when="2024-01-06 23:59:59")])  # a Saturday
    got = kpis.kpi_by_calendar(facts, dims.calendar(dims.datetime_document(spark))).first()
    assert (got.day_of_week, got.hour, got.is_weekend, got.transactions) == ("Sat", 23, True, 1)


def test_velocity_compares_with_the_last_hour_that_had_revenue(spark):
    facts = fact(spark, [txn(1, amount=10.0, when="2024-01-01 10:30:00"), txn(2, amount=4.0, when="2024-01-01 15:00:00")])
    got = [(r.revenue, r.revenue_delta) for r in time_kpis.kpi_velocity(facts).orderBy("hour").collect()]
    assert got == [(10.0, None), (4.0, -6.0)]


def test_spike_counts_quiet_hours_as_zero(spark):
    calm = [txn(i, when=f"2024-01-01 {i:02d}:00:00", status="Fraud") for i in (0, 1)]
    burst = [txn(100 + i, when="2024-01-01 10:00:00", status="Fraud") for i in range(2)]
    got = time_kpis.kpi_fraud_spikes(fact(spark, calm + burst)).collect()
    assert [(r.hour, r.fraud_transactions, r.trailing_mean) for r in got] == [(at("2024-01-01 10:00:00"), 2, 0.2)]


def test_minutes(spark):
    facts = fact(spark, [txn(i, when=f"2024-01-01 10:00:{i:02d}") for i in range(3)] + [txn(9, when="2024-01-01 10:01:00")])
    assert sorted(r.transactions for r in time_kpis.kpi_tpm(facts).collect()) == [1, 3]


def latency_fact(spark, values):
    return spark.createDataFrame([(v,) for v in values], "processing_time DOUBLE")


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [float(i) for i in range(997)],
        [7.0] * 500 + [float(i) / 7 for i in range(900)],
        [1e-300 * i for i in range(50)] + [1e12, 3.0, 3.0],
        [-5.5, -1.25, 0.0, None, 3.75, None],
        [4.0] * 300,
    ],
)
def test_narrowing_finds_exact_percentiles(spark, values):
    import numpy as np

    known = [v for v in values if v is not None]
    got = kpi_latency(latency_fact(spark, values)).first()
    assert got.transactions == len(values)
    assert got.max_latency == max(known)
    for at_p, have in ((0.5, got.p50_latency), (0.95, got.p95_latency)):
        assert math.isclose(have, float(np.quantile(known, at_p)), rel_tol=1e-12, abs_tol=1e-300)


def test_narrowing_over_random_values(spark):
    import numpy as np

    values = np.random.default_rng(5).lognormal(3, 2, 60_000)
    got = kpi_latency(spark.createDataFrame([(float(v),) for v in values], "processing_time DOUBLE")).first()
    assert math.isclose(got.p50_latency, float(np.quantile(values, 0.5)), rel_tol=1e-12)
    assert math.isclose(got.p95_latency, float(np.quantile(values, 0.95)), rel_tol=1e-12)
    assert len(values) > BUCKETS


def test_nan_and_infinity_are_no_measurements(spark):
    got = kpi_latency(latency_fact(spark, [1.0, float("nan"), 3.0, float("inf")])).first()
    assert (got.transactions, got.avg_latency, got.max_latency, got.p50_latency) == (4, 2.0, 3.0, 2.0)


def test_latency_of_nothing(spark):
    assert rows(kpi_latency(latency_fact(spark, []))) == [(0, None, None, None, None)]


def amounts(spark, values):
    return fact(spark, [txn(n, amount=v) for n, v in enumerate(values)])


@pytest.mark.parametrize("values, total, average", [
    ([0.004] * 1000, 4.0, 0.004),
    ([0.125, -0.125, 0.0000005, -0.0000005], 0.0, 0.0),
    ([0.0000005], 0.000001, 0.000001),
    ([-0.0], 0.0, 0.0),
    ([float("nan"), float("inf"), float("-inf"), 2.5, 0.5], 3.0, 1.5),
    ([1e17, 0.25], 1e17, 5e16),
    ([1e17] * 40 + [0.5], 4e18, 4e18 / 41),
    ([float("nan")], None, None),
])
def test_sums_keep_the_value_and_survive(spark, star, values, total, average):
    got = kpis.kpi_global(amounts(spark, values)).first()
    assert tuple(got) == (len(values), total, average)
    long = {(r["kpi"], r["dim_value"]): r for r in one_pass.kpi_all_one_pass(amounts(spark, values), star).collect()}
    assert long["global", None][2:] == (len(values), total, average)


def test_odd_amounts_are_counted(spark):
    got = totals(amounts(spark, [float("nan"), float("inf"), None, 1.0, 1e300])).first()
    assert (got.n, got.n_priced, got.n_odd) == (5, 1, 3)


def test_sums_equal_decimal_sums(spark):
    from paytide.functions.money import amount_of, sums

    values = spark.range(300_000).select(((F.col("id") * F.col("id") * 997 + F.col("id")).cast("double") / 1e6).alias("v"))
    one = values.withColumn("exact", F.col("v").cast("decimal(38,6)")).groupBy(F.col("v")).agg(*sums("v"), F.sum("exact").alias("exact"))
    assert one.where(amount_of() != F.col("exact").cast("double")).take(1) == []
    whole = values.agg(*sums("v"), F.sum(F.col("v").cast("decimal(38,6)")).alias("exact"))
    assert whole.where(amount_of() != F.col("exact").cast("double")).take(1) == []


@pytest.mark.parametrize("operator", [kpi_latency, kpi_latency_approx])
def test_latencies_that_are_small_large_or_none(spark, operator):
    got = operator(latency_fact(spark, [0.0004] * 10)).first()
    assert (got.avg_latency, got.max_latency, got.p95_latency) == (0.0004, 0.0004, 0.0004)
    assert operator(latency_fact(spark, [1e17])).first().avg_latency == 1e17
    assert operator(latency_fact(spark, [float("nan"), 3.0])).first().avg_latency == 3.0


def test_approximate_percentile_is_near(spark):
    got = kpi_latency_approx(latency_fact(spark, [float(i) for i in range(10_001)])).first()
    assert abs(got.p50_latency - 5000) <= 2 and abs(got.p95_latency - 9500) <= 2
    assert got.avg_latency == 5000.0

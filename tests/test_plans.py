"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from paytide import session
from paytide.operators import hot_cold, retention
from paytide.operators.totals import totals
from paytide.plans import one_pass
from paytide.plans.queries import REGISTRY
from paytide.sources import sample

SF = "/root/testdata/sf0.001"
STREAMS_AND_JOBS = {n for n in REGISTRY if n.startswith("stream_")} | {
    "archive_snapshot", "archive_expired", "retain_hot", "kpi_refresh", "kpi_refresh_incremental", "serving_json", "serving_roundtrip", "chart_series",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STREAMS_AND_JOBS))
def test_no_python_and_no_nested_loops(spark, no_broadcast, name):
    text = plan(REGISTRY[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert bad not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("kpi_global", {"l_extendedprice"}),
        ("kpi_daily", {"l_shipdate", "l_extendedprice"}),
        ("kpi_by_merchant_category", {"l_suppkey", "l_extendedprice"}),
        ("kpi_by_customer_segment", {"l_orderkey", "l_extendedprice"}),
        ("kpi_latency_approx", {"l_quantity"}),
    ],
)
def test_the_fact_scan_reads_only_what_it_needs(spark, name, columns):
    text = plan(REGISTRY[name](spark, SF))
    (scan,) = set(re.findall(r"ReadSchema: struct<([^>]*l_[^>]*)>", text))
    assert {c.split(":")[0] for c in scan.split(",")} == columns


def test_the_fact_is_reduced_before_any_join(spark, no_broadcast):
    for name in ("kpi_by_merchant_category", "kpi_by_customer_segment", "kpi_by_payment_method", "kpi_all_one_pass"):
        lines = plan(REGISTRY[name](spark, SF)).splitlines()
        for at, line in enumerate(lines):
            if "FileScan" in line and "lineitem" in line:
                above = [l for l in lines[:at] if len(l) - len(l.lstrip(" :+-")) < len(line) - len(line.lstrip(" :+-"))]
                nearest = next(l for l in reversed(above) if "Join" in l or "Exchange" in l)
                assert "Exchange" in nearest
                assert "HashAggregate" in lines[lines.index(nearest) + 1]


def test_one_pass_scans_a_whole_fact_once(spark):
    facts = sample.feed(spark, SF)
    dims = {"merchant": sample.merchants(spark, SF), "customer": sample.customers(spark, SF)}
    assert plan(one_pass.kpi_all_one_pass(facts, dims)).count("events.parquet") == 1


@pytest.mark.parametrize("name", ["kpi_all_one_pass", "kpi_fraud_rate"])
def test_registered_one_pass_queries_scan_the_lines_once(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    scans = [line for line in text.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(scans) == 1


def scanned_rows(df):
    """Rows that came out of the file scans of an executed plan."""
    df.collect()

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStage" in kind:
            return walk(node.plan())
        own = node.metrics().apply("numOutputRows").value() if kind == "FileSourceScanExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_retention_skips_old_row_groups_of_a_stored_fact(spark, tmp_path):
    path = str(tmp_path / "hot")
    stored = sample.feed(spark, SF)
    stored.repartitionByRange(8, "ts").write.parquet(path)
    stored = spark.read.parquet(path)
    cutoff = sample.moment("2024-01-30 20:57:12")
    kept = retention.retain_hot(stored, cutoff)
    assert scanned_rows(kept) < 200 < stored.count() == 1000
    assert scanned_rows(retention.live_count(stored, cutoff)) < 200


def test_subquery_moment_is_a_bare_filter(spark):
    text = plan(REGISTRY["live_count_hot"](spark, SF))
    assert re.search(r"ts#\d+ >= (ReusedSubquery )?Subquery subquery#\d+, \[id=#\d+\]\)", text)


def test_cutoff_dedup_shuffles_nothing(spark):
    assert "Exchange" not in plan(REGISTRY["hot_cold_dedup_cutoff"](spark, SF))
    assert "Exchange" not in plan(REGISTRY["clean_valid"](spark, SF))




def test_hot_keys_are_combined_before_the_shuffle(spark):
    hot = spark.range(100_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("bigint").alias("customer_id"),
        F.lit(1.0).alias("transaction_amount"), F.lit("Success").alias("status"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("transaction_id"), F.col("id").alias("n"),
    )
    assert plan(totals(hot, "customer_id")).count("HashAggregate") == 2
    # Ids are counted by hash; only rows with copies are sorted, below a join that keeps none else.
    copies = plan(hot_cold.dedup_by_id(hot))
    for below in copies.split("SortAggregate(key=")[2:3]:
        assert below.index("Join") < below.index("Range")


def test_skewed_parent_join_is_split(spark, no_broadcast):
    """A row-level join on a hot key, as ``enrich`` has, is split by adaptive execution."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(400_000, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 10_000).alias("order_id"), F.rand(1).alias("x")
        )
        parents = spark.range(10_000).select(F.col("id").alias("order_id"), F.col("id").alias("customer_id"))
        joined = facts.join(parents, "order_id", "left")
        assert joined.count() == 400_000
        counted = joined.agg(F.sum("x"), F.max("customer_id"))
        counted.collect()
        assert "skew=true" in plan(counted)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_rebalanced_archive_splits_a_hot_day(spark, tmp_path):
    """One day holds almost all rows; its files are written by several tasks."""
    from paytide.model import STORED_FACT
    from paytide.sources import HotStore
    from rows import fact, txn

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        one = fact(spark, [txn(1)])
        many = one.select(F.explode(F.sequence(F.lit(1), F.lit(60_000))).alias("i"), "*").repartition(16)
        many = many.withColumn("transaction_id", F.sha2(F.col("i").cast("string"), 256)).drop("i")
        store = HotStore(spark, str(tmp_path))
        stored = store.write_batch(many.select(*STORED_FACT.names), 1)
        assert stored.count() == 60_000
        assert len(list((tmp_path / "archive" / "batch_id=1" / "txn_date=2024-01-01").glob("*.parquet"))) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_work_path_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            @staticmethod
            def get(_name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_path(Cluster, "x")
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.work_path(spark, "x").startswith(f"{root}/paytide/x-")


def test_retention_orders_the_rows_of_one_minute_only(spark):
    """Hours and minutes are sums; below the only window over rows, a filter leaves one minute."""
    text = plan(retention.retain_by_size(sample.feed(spark, SF), 1000))
    assert text.count("Window [") == 1
    below = text[text.index("Window ["):]
    edges = [re.findall(r"ts#\d+ %s (\S+ \d\d:\d\d):00" % sign, below) for sign in (">=", "<")]
    start, end = max(edges[0]), min(edges[1])
    assert int(end[-2:]) - int(start[-2:]) == 1 and start[:-2] == end[:-2]

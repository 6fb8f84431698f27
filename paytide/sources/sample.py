"""The payments model over the sample tables (an order system and an event feed).

``order_lines`` with ``order_headers`` are transactions at day precision, ``feed`` maps events to
transactions with exact times. Columns are built only where they are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import session
from ..functions.clock import moment, text_of
from ..model import schema

EVENTS = schema(
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

FEED_COLUMNS = (
    "transaction_id", "customer_id", "merchant_id", "device_id", "payment_method_id", "transaction_timestamp",
    "transaction_amount", "processing_time", "fraud_score", "status", "ts", "txn_date",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_of(fraud: Column) -> Column:
    return F.when(fraud, "Fraud").otherwise("Success")


def priority_number(priority: str = "o_orderpriority") -> Column:
    return F.substring(priority, 1, 1).cast("int")


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and payment method of each order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        priority_number().alias("payment_method_id"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without the columns that only the order header has.

    Every line is a transaction, so KPIs that need neither customer nor payment method do
    without the header, and the others meet it with totals per order.
    """
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("l_partkey").alias("device_id"),
        F.col("l_shipdate").alias("ts"),
        F.to_date("l_shipdate").alias("txn_date"),
        F.col("l_extendedprice").alias("transaction_amount"),
        (F.col("l_quantity") * F.lit(60.0)).alias("processing_time"),
        (F.col("l_discount") * F.lit(10.0)).alias("fraud_score"),
        status_of(F.col("l_returnflag") == "R").alias("status"),
    )


def taxed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by day with the amount that was paid for them."""
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("txn_date"), paid.alias("transaction_amount"), status_of(F.col("l_returnflag") == "R").alias("status")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_acctbal").alias("total_lifetime_spend"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    located = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return located.select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("r_name").alias("business_category"),
        F.col("n_name").alias("country"),
    )


def registered_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants with a registration day as text, some of it broken, and a dispute rate."""
    key = F.col("s_suppkey")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int")).cast("string")
    return table(spark, sf_dir, "supplier").select(
        key.alias("merchant_id"), F.when(key % 17 == 0, "2021-02-30").when(key % 19 == 0, None).otherwise(day).alias("registration_date"),
        (F.col("s_acctbal") / 7).alias("avg_dispute_rate"),
    )


def text_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with every field as text, some of the numbers broken."""
    event = F.col("transaction_id").cast("bigint")
    columns = {c: F.col(c).cast("string") for c in FEED_COLUMNS[:-2]}
    columns["transaction_amount"] = F.when(event % 61 == 0, "n/a").otherwise(columns["transaction_amount"])
    columns["processing_time"] = F.when(event % 67 == 0, "").otherwise(columns["processing_time"])
    columns["customer_id"] = F.when(event % 59 == 0, "12x").otherwise(columns["customer_id"])
    return feed(spark, sf_dir).select(*[c.alias(name) for name, c in columns.items()])


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("device_id"), F.col("p_type").alias("device_type"), F.col("p_brand").alias("os")
    )


def payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select(priority_number().alias("payment_method_id"), F.expr("substr(o_orderpriority, 3)").alias("method_type"))
        .distinct()
    )


def as_feed(events: DataFrame) -> DataFrame:
    """Events, batch or stream, as transactions. ``ts`` keeps its type.

    ``props`` is a flat JSON object with the number ``k``. A pattern reads it at a tenth of what
    a JSON parser costs, which would otherwise be most of the work of every query on the feed.
    """
    k = F.regexp_extract("props", r'"k"\s*:\s*(-?\d+)', 1).try_cast("int")
    return events.withColumn("k", k).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("k") % 10).cast("bigint").alias("merchant_id"),
        F.col("k").cast("bigint").alias("device_id"),
        (1 + F.col("k") % 5).alias("payment_method_id"),
        text_of("ts").alias("transaction_timestamp"),
        F.col("value").alias("transaction_amount"),
        (50 + 30 * F.col("k").cast("double")).alias("processing_time"),
        (F.col("k").cast("double") / F.lit(100.0)).alias("fraud_score"),
        status_of(F.col("event_type") == "error").alias("status"),
        "ts",
        F.to_date("ts").alias("txn_date"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feed(table(spark, sf_dir, "events"))


def faulty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as raw rows, with faults planted by rule."""
    event = F.col("transaction_id").cast("bigint")
    every = lambda n: event % n == 0
    customer = F.when(every(83), None).when(every(79), F.col("customer_id") + 10_000_000).otherwise(F.col("customer_id"))
    amount = F.col("transaction_amount")
    return feed(spark, sf_dir).drop("ts", "txn_date").withColumns({
        "transaction_timestamp": F.when(every(97), "junk").otherwise(F.col("transaction_timestamp")),
        "transaction_amount": F.when(every(89), -amount).otherwise(amount),
        "customer_id": customer,
        "status": F.when(every(71), "Pending").when(every(73), None).otherwise(F.col("status")),
    })


# Two archive runs. A snapshot ends at its run and the next begins three hours before.
RUNS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
CUTOFFS = ("2024-01-09 21:00:00", "2024-01-19 21:00:00")


def overlapping(fact: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The feed as two overlapping snapshots and the live rows: (first, second, live)."""
    ts = F.col("ts")
    first = fact.where(ts < moment(RUNS[0]))
    second = fact.where((ts >= moment(CUTOFFS[0])) & (ts < moment(RUNS[1])))
    return first, second, fact.where(ts >= moment(CUTOFFS[1]))


def segment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, ts, version, customer_segment): every signup and every error sets the segment from then on."""
    telling = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error"))
    segment = F.when(F.col("event_type") == "signup", "New").otherwise("Risky")
    return telling.select(
        F.col("user_id").alias("customer_id"), "ts", F.col("event_id").alias("version"), segment.alias("customer_segment")
    )


def customer_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial updates of the customers from everything that happened to them.

    Every order sets the spend (to an explicit NULL while it is pending), every signup and error sets the
    segment, and every supplier becomes a new customer under a key of its own.
    """

    def update(rows: DataFrame, key: Column, version: Column, **values: Column) -> DataFrame:
        kinds = {"name": "string", "customer_segment": "string", "total_lifetime_spend": "double"}
        columns = [values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
        sets = F.array(*[F.lit(c) for c in values])
        return rows.select(key.alias("customer_id"), version.alias("version"), sets.alias("sets"), *columns)

    orders, events, suppliers = (table(spark, sf_dir, name) for name in ("orders", "events", "supplier"))
    spend = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    segment = F.when(F.col("event_type") == "signup", "New").otherwise("Risky")
    telling = events.where(F.col("event_type").isin("signup", "error"))
    return (
        update(orders, F.col("o_custkey"), F.col("o_orderkey"), total_lifetime_spend=spend)
        .unionByName(update(telling, F.col("user_id"), F.col("event_id"), customer_segment=segment))
        .unionByName(
            update(
                suppliers,
                -F.col("s_suppkey") - 1,
                F.lit(0).cast("bigint"),
                name=F.col("s_name"),
                customer_segment=F.lit("Occasional"),
                total_lifetime_spend=F.col("s_acctbal"),
            )
        )
    )

"""Serving rows: each KPI table as one JSON array under a cache key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.clock import parse_day
from ..functions.money import amount_of, mean_of
from ..model import KPI_TABLES
from ..sources import Source
from .totals import SUMS, totals

JSON = {"ignoreNullFields": "false"}

# What a payload parses to, per KPI.
PAYLOADS = {
    kpi: "array<struct<"
    + ", ".join(
        ([] if label is None else [f"{label}: {'date' if label == 'txn_date' else 'string'}"])
        + [f"{n}: bigint", f"{total}: double", f"{average}: double"]
    )
    + ">>"
    for kpi, (_table, _key, label, n, total, average) in KPI_TABLES.items()
}


def _entry(kpi: str) -> Column:
    _table, _key, label, n, total, average = KPI_TABLES[kpi]
    fields = [] if label is None else [F.col("dim_value").alias(label)]
    fields += [F.col("transactions").alias(n), F.col("total").alias(total), F.col("average").alias(average)]
    return F.to_json(F.struct(*fields), JSON)


def serving_rows(kpis: DataFrame) -> DataFrame:
    """(key, payload) for the KPIs of a long table (kpi, dim_value, transactions, total, average).

    Days ascend, other KPIs descend by total, as in their tables. NULLs stay in the JSON. An
    array has one element per day or label, which is what makes it fit one cache entry.
    """
    kpi = F.col("kpi")
    entry = F.coalesce(*[F.when(kpi == name, _entry(name)) for name in KPI_TABLES])
    key = F.coalesce(*[F.when(kpi == name, F.lit(KPI_TABLES[name][1])) for name in KPI_TABLES])
    order = F.struct(
        F.when(kpi != "daily", F.coalesce(-F.col("total"), F.lit(float("inf")))).alias("by_total"),
        F.col("dim_value").alias("by_label"),
        entry.alias("entry"),
    )
    rows = kpis.where(kpi.isin(*KPI_TABLES)).select(key.alias("key"), order.alias("row"))
    arrays = rows.groupBy("key").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    entries = F.array_join(F.transform("rows", lambda row: row["entry"]), ",")
    return arrays.select("key", F.concat(F.lit("["), entries, F.lit("]")).alias("payload"))


def load_kpi(serving: DataFrame, kpi: str) -> DataFrame:
    """A KPI table back from its serving row; no rows when the key is missing or the text is broken."""
    found = serving.where((F.col("key") == KPI_TABLES[kpi][1]) & F.col("payload").startswith("["))
    return found.select(F.inline(F.from_json("payload", PAYLOADS[kpi])))


def served_elements(serving: DataFrame) -> DataFrame:
    """(key, position, label, transactions) of every element of the served arrays, in the order they are served."""
    parts = []
    for kpi, (_table, key, label, n, _total, _average) in KPI_TABLES.items():
        found = serving.where(F.col("key") == key).select(F.posexplode(F.from_json("payload", PAYLOADS[kpi])).alias("position", "e"))
        value = F.lit(None) if label is None else F.col(f"e.{label}")
        parts.append(found.select(
            F.lit(key).alias("key"), "position", value.cast("string").alias("label"), F.col(f"e.{n}").alias("transactions")
        ))
    return reduce(DataFrame.unionAll, parts)


def load_kpi_long(serving: DataFrame, kpi: str) -> DataFrame:
    """A KPI from its serving row in the long form (kpi, dim_value, transactions, total, average)."""
    _table, _key, label, n, total, average = KPI_TABLES[kpi]
    value = F.lit(None) if label is None else F.col(label)
    return load_kpi(serving, kpi).select(
        F.lit(kpi).alias("kpi"),
        value.cast("string").alias("dim_value"),
        F.col(n).alias("transactions"),
        F.col(total).alias("total"),
        F.col(average).alias("average"),
    )


def load_kpi_table(spark: SparkSession, source: Source, schema: StructType) -> DataFrame:
    """A stored KPI table; a day that is stored as text becomes a date."""
    table = source.read(spark, schema)
    if dict(table.dtypes).get("txn_date") == "string":
        table = table.withColumn("txn_date", parse_day("txn_date"))
    return table


# Chart title -> (KPI, measure).
CHARTS = {
    "Daily Transaction Volume": ("daily", "transactions"),
    "Daily Revenue Trend": ("daily", "total"),
    "Revenue by Merchant Category": ("merchant", "total"),
    "Spending by Customer Segment": ("customer", "total"),
    "Payment Method Share": ("payment", "total"),
}


def chart_series(kpis: DataFrame) -> DataFrame:
    """The points of every chart as (title, x, y), from a long KPI table."""
    points = [
        F.when(
            F.col("kpi") == kpi,
            F.struct(F.lit(title).alias("title"), F.col("dim_value").alias("x"), F.col(y).cast("double").alias("y")),
        )
        for title, (kpi, y) in CHARTS.items()
    ]
    return kpis.select(F.inline(F.array_compact(F.array(*points))))


def run_cards(run: DataFrame) -> DataFrame:
    """Texts for the cards of one run."""
    return run.select(
        F.format_number("total_transactions", 0).alias("transactions_text"),
        F.format_number("total_volume", 2).alias("revenue_text"),
        F.format_string("%.2f", "avg_transaction_value").alias("average_text"),
    )


def next_run(ts: Column, hours: int = 3) -> Column:
    """The first periodic run after a moment."""
    period = hours * 3600
    return F.timestamp_seconds((F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(period)) + 1) * period).cast("timestamp_ntz")


def as_run(newest: DataFrame) -> DataFrame:
    """A stored refresh under the names of the run history."""
    return newest.select(
        F.col("run_at").alias("run_ts"), F.col("transactions").alias("total_transactions"),
        F.col("total").alias("total_volume"), F.col("average").alias("avg_transaction_value"),
    )


def kpi_run_history(fact: DataFrame, hours: int = 3) -> DataFrame:
    """The global KPI as each periodic refresh saw it: totals of everything before the run.

    The running totals go over one row per refresh, not over transactions.
    """
    period = hours * 3600
    slot = (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(period)) + 1) * period
    per_run = totals(fact.where(F.col("ts").isNotNull()), slot.alias("run_at"))
    so_far = Window.orderBy("run_at").rowsBetween(Window.unboundedPreceding, 0)
    running = per_run.select("run_at", *[F.sum(m).over(so_far).alias(m) for m in ("n", "n_priced", *SUMS)])
    return running.select(
        F.timestamp_seconds("run_at").cast("timestamp_ntz").alias("run_ts"),
        F.col("n").alias("total_transactions"),
        amount_of().alias("total_volume"),
        mean_of("n_priced").alias("avg_transaction_value"),
    )


def latest_kpi_run(runs: DataFrame) -> DataFrame:
    """The newest run: a top-1, not a sort."""
    return runs.orderBy(F.desc("run_ts")).limit(1)

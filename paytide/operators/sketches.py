"""Percentiles that can be merged.

Exact percentiles need all values at once. A KLL sketch holds a few hundred of them, chosen so that the rank of every
answer is off by a known share (about 1.3 % at size 200), and two sketches merge into the sketch of both. So
percentiles can be stored like totals: per key and part of the table, merged when asked for, per day, label or window.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.money import mean_of, measured, sums
from ..model import schema
from .enrich import LABELS

SIZE = 200
SKETCHES = schema("kpi STRING, key BIGINT, n BIGINT, timed BIGINT, units BIGINT, parts BIGINT, sketch BINARY")
HOUR, DAY = "hour", "daily"


def latency_sketches(fact: DataFrame, kpis: Iterable[str] = (), column: str = "processing_time", size: int = SIZE) -> DataFrame:
    """Sketches and sums of the latency per (kpi, key): per hour, per day, and per foreign key of ``kpis``.

    One scan. A key that many rows share is one sketch per task before the shuffle.
    """
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(3600)).alias(HOUR)
    keys = [F.col(LABELS[kpi][0]).cast("bigint").alias(kpi) for kpi in kpis]
    wide = fact.select(hour, F.unix_date("txn_date").cast("bigint").alias(DAY), *keys, measured(column).alias("v"))
    return wide.unpivot(["v"], [HOUR, DAY, *kpis], "kpi", "key").groupBy("kpi", "key").agg(
        F.count("*").alias("n"), F.count("v").alias("timed"), *sums("v"), F.kll_sketch_agg_double("v", size).alias("sketch")
    )


def merge_sketches(partials: DataFrame, *keys: str, size: int = SIZE) -> DataFrame:
    """Sketches of sketches."""
    added = [F.sum(c).alias(c) for c in ("n", "timed", "units", "parts")]
    return partials.groupBy(*(keys or ("kpi", "key"))).agg(*added, F.kll_merge_agg_double("sketch", size).alias("sketch"))


def percentiles(sketched: DataFrame, *keys: str) -> DataFrame:
    """Count, mean, median and 95th percentile per key; NULL where nothing was measured."""
    at = [
        F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(name)
        for p, name in ((0.5, "p50_latency"), (0.95, "p95_latency"))
    ]
    return sketched.select(*keys, F.col("n").alias("transactions"), mean_of("timed").alias("avg_latency"), *at)


def latency_by_day(sketched: DataFrame) -> DataFrame:
    day = F.date_from_unix_date(F.col("key").cast("int")).alias("txn_date")
    return percentiles(sketched.where(F.col("kpi") == DAY).withColumn("txn_date", day), "txn_date")


def latency_by_hour(sketched: DataFrame) -> DataFrame:
    hour = F.timestamp_seconds(F.col("key") * 3600).cast("timestamp_ntz")
    return percentiles(sketched.where((F.col("kpi") == HOUR) & F.col("key").isNotNull()).withColumn("window_start", hour), "window_start")


def latency_by_label(sketched: DataFrame, dim: DataFrame, kpi: str) -> DataFrame:
    """Per label of a dimension, as an inner join has it: unknown keys drop out, duplicated ones fan out."""
    key, label = LABELS[kpi]
    lookup = dim.select(F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"))
    return percentiles(merge_sketches(sketched.where(F.col("kpi") == kpi).join(lookup, "key"), "label"), "label")

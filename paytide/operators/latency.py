"""Processing latency: mean, maximum and percentiles.

Spark's exact ``percentile`` keeps every distinct value of the column in one aggregation
buffer, which a continuous column at scale does not fit. ``quantiles`` gets the same exact values
by narrowing: count the rows per equal-width bucket, keep the buckets that hold the wanted
ranks, repeat inside them. A pass is one scan of one column for all open brackets together, its shuffle
is at most ``BUCKETS`` rows per task and bracket, and it divides a range by ``BUCKETS``, so two or three
passes are enough for any realistic column. The least and the largest value of a bracket are never in one
bucket, so each pass gets on; a value that a third of the rows share ends the search once it is alone.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, floor
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..functions.money import mean_of, measured, sums

BUCKETS = 4096
SCHEMA = "transactions BIGINT, avg_latency DOUBLE, max_latency DOUBLE, p50_latency DOUBLE, p95_latency DOUBLE"


class Bracket(NamedTuple):
    """Values between two, the rows below them, and the 0-based ranks that fall among them."""

    low: float
    high: float
    below: int
    ranks: list[int]


def _histogram(values: DataFrame, brackets: list[Bracket]) -> list:
    """(bracket, rows, smallest, largest) of every non-empty bucket of every bracket, ascending."""
    number = reduce(
        lambda rest, at: F.when(F.col("v").between(brackets[at].low, brackets[at].high), at).otherwise(rest),
        range(len(brackets)), F.lit(None).cast("int"),
    )
    at = F.col("bracket") + 1
    low, high = (F.element_at(F.array(*[F.lit(edge) for edge in edges]), at) for edges in zip(*[b[:2] for b in brackets]))
    bucket = F.least(F.floor((F.col("v") - low) / (high - low) * F.lit(float(BUCKETS))), F.lit(BUCKETS - 1))
    return (
        values.withColumn("bracket", number)
        .where(F.col("bracket").isNotNull())
        .groupBy("bracket", bucket.alias("bucket"))
        .agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        .orderBy("bracket", "bucket")
        .collect()
    )


def _values_at(values: DataFrame, whole: Bracket) -> dict[int, float]:
    """The values at the ranks of a bracket."""
    found: dict[int, float] = {}
    todo = [whole]
    while todo:
        found.update({rank: b.low for b in todo if b.low == b.high for rank in b.ranks})
        todo = [b for b in todo if b.low < b.high]
        if not todo:
            break
        narrower, below = [], {at: b.below for at, b in enumerate(todo)}
        for part in _histogram(values, todo):
            start = below[part.bracket]
            inside = [r for r in todo[part.bracket].ranks if start <= r < start + part.rows]
            if inside:
                narrower.append(Bracket(part.low, part.high, start, inside))
            below[part.bracket] = start + part.rows
        todo = narrower
    return found


def quantiles(values: DataFrame, low: float, high: float, rows: int, probabilities: list[float]) -> list[float]:
    """Exact interpolated quantiles of the column ``v`` whose minimum, maximum and count are known."""
    positions = [(rows - 1) * p for p in probabilities]
    ranks = sorted({edge(at) for at in positions for edge in (floor, ceil)})
    found = _values_at(values, Bracket(low, high, 0, ranks))
    return [
        found[floor(at)] + (found[ceil(at)] - found[floor(at)]) * (at - floor(at)) for at in positions
    ]


def kpi_latency(fact: DataFrame, column: str = "processing_time") -> DataFrame:
    """One row: transactions, mean, maximum, exact median and 95th percentile.

    NaN and infinity are no measurements; such rows count as transactions without one, here as in the
    approximate form.
    """
    values = fact.select(measured(column).alias("v"))
    known = values.agg(
        F.count("*").alias("transactions"),
        F.count("v").alias("rows"),
        *sums("v"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )
    seen = known.withColumn("avg", mean_of("rows")).first()
    if seen.rows == 0:
        middle, tail = None, None
    else:
        middle, tail = quantiles(values, seen.low, seen.high, seen.rows, [0.5, 0.95])
    return fact.sparkSession.createDataFrame([(seen.transactions, seen.avg, seen.high, middle, tail)], SCHEMA)


def kpi_latency_approx(fact: DataFrame, column: str = "processing_time", accuracy: int = 10_000) -> DataFrame:
    """The same row in one pass; each percentile is a value within ``1/accuracy`` of its rank."""
    at = F.percentile_approx("v", [0.5, 0.95], accuracy)
    return fact.select(measured(column).alias("v")).agg(
        F.count("*").alias("transactions"),
        *sums("v"),
        F.count("v").alias("rows"),
        F.max("v").alias("max_latency"),
        at.alias("at"),
    ).select(
        "transactions",
        mean_of("rows").alias("avg_latency"),
        "max_latency",
        F.col("at")[0].alias("p50_latency"),
        F.col("at")[1].alias("p95_latency"),
    )

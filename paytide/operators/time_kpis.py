"""KPIs over time buckets.

Windows here have no partition, and none is needed: they run over one row per hour, so their
input grows with the covered time and not with the number of transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import amount_of
from .totals import SUMS, totals


def bucketed(fact: DataFrame, unit: str) -> DataFrame:
    return totals(fact, F.date_trunc(unit, "ts").cast("timestamp_ntz").alias(unit))


def kpi_tpm(fact: DataFrame) -> DataFrame:
    """Transactions per minute."""
    return bucketed(fact, "minute").select("minute", F.col("n").alias("transactions"))


def kpi_velocity(fact: DataFrame) -> DataFrame:
    """Revenue per hour and its change against the previous hour that had any."""
    in_time = Window.orderBy("hour")
    change = [F.col(s) - F.lag(s).over(in_time) for s in SUMS]
    return bucketed(fact, "hour").select(
        "hour",
        F.col("n").alias("transactions"),
        amount_of().alias("revenue"),
        amount_of(*change).alias("revenue_delta"),
    )


def kpi_fraud_spikes(fact: DataFrame, hours: int = 24, factor: float = 2.0) -> DataFrame:
    """Hours whose fraud count exceeds ``factor`` times the mean of the hours before.

    The mean is over calendar hours, quiet ones included as zero. A RANGE frame over the hour
    number gives their sum without writing the quiet hours out, and the divisor is the number of
    hours since the first, up to ``hours``. Thus one scan is enough.
    """
    return spikes(bucketed(fact, "hour").select("hour", "n_fraud"), hours, factor)


def spikes(hourly: DataFrame, hours: int = 24, factor: float = 2.0) -> DataFrame:
    """The same from counts (hour, n_fraud); hours without a row are quiet."""
    number = F.unix_seconds(F.col("hour").cast("timestamp")) / F.lit(3600)
    hourly = hourly.withColumn("at", number.cast("bigint"))
    before = Window.orderBy("at").rangeBetween(-hours, -1)
    elapsed = F.col("at") - F.min("at").over(Window.orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
    framed = hourly.select(
        "hour",
        F.col("n_fraud").alias("fraud_transactions"),
        F.coalesce(F.sum("n_fraud").over(before), F.lit(0)).alias("earlier"),
        F.least(elapsed, F.lit(hours)).alias("span"),
    )
    mean = F.try_divide(F.col("earlier").cast("double"), F.col("span").cast("double"))
    return (
        framed.withColumn("trailing_mean", mean)
        .where(F.col("fraud_transactions") > F.lit(factor) * F.col("trailing_mean"))
        .select("hour", "fraud_transactions", "trailing_mean")
    )

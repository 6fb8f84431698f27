"""Dimension upserts and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clock import parse_day
from ..functions.money import amount_of
from .totals import totals

# The calendar document.
HOURS = list(range(24))
DAYS_OF_WEEK = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKEND_FLAGS = {"Sat": True, "Sun": True}


def merchant_tenure(merchants: DataFrame, today: Column) -> DataFrame:
    """Typed registration day, days since then, and the dispute rate to two decimals, half away from zero.

    A day that does not parse is NULL, and so is the tenure.
    """
    day = parse_day("registration_date")
    return merchants.select(
        "merchant_id", day.alias("registration_date"), F.date_diff(today, day).alias("tenure_days"),
        F.round("avg_dispute_rate", 2).alias("avg_dispute_rate"),
    )


def dim_upsert(base: DataFrame, updates: DataFrame, key: str, version: str = "version", sets: str = "sets") -> DataFrame:
    """Apply partial updates to a dimension (overwrite in place, no history).

    An update row carries the key, a version, and in ``sets`` the names of the columns it sets.
    Updates apply in version order, so each column takes its value from the newest row that sets
    it; a column no update sets keeps its stored value, and an explicit NULL overwrites. The newest
    value per column is a ``max`` of (version, value), which combines before the shuffle:
    a key with very many updates stays one row per task.

    One full outer join: each side is read once, and both shuffle on the key.
    """
    columns = [c for c in base.columns if c != key]
    newest = [
        F.max(F.when(F.array_contains(sets, c), F.struct(F.col(version).alias("at"), F.col(c).alias("value")))).alias(c)
        for c in columns
    ]
    latest = updates.groupBy(key).agg(*newest)
    old, new = base.alias("old"), latest.alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    merged = [
        F.when(F.col(f"new.{c}").isNotNull(), F.col(f"new.{c}.value")).otherwise(F.col(f"old.{c}")).alias(c)
        for c in columns
    ]
    return joined.select(F.coalesce(f"old.{key}", f"new.{key}").alias(key), *merged).select(*base.columns)


def datetime_document(spark: SparkSession) -> DataFrame:
    """The calendar as one nested row."""
    flags = [F.lit(x) for pair in WEEKEND_FLAGS.items() for x in pair]
    return spark.range(1).select(
        F.array(*map(F.lit, HOURS)).alias("hours"),
        F.array(*map(F.lit, DAYS_OF_WEEK)).alias("days_of_week"),
        F.create_map(*flags).alias("weekend_flags"),
    )


def calendar(document: DataFrame) -> DataFrame:
    """The calendar document as a joinable table of 168 weekday-hour slots."""
    days = document.select(F.posexplode("days_of_week").alias("weekday", "day_of_week"), "hours", "weekend_flags")
    flag = F.coalesce(F.try_element_at("weekend_flags", F.col("day_of_week")), F.lit(False))
    return days.select("weekday", "day_of_week", flag.alias("is_weekend"), F.explode("hours").alias("hour"))


def datetime_dim(fact: DataFrame, document: DataFrame) -> DataFrame:
    """Every hour in which the fact has transactions, with its calendar attributes and activity."""
    hours = totals(fact, F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"))
    keyed = hours.withColumns({"weekday": F.weekday("hour_start"), "hour": F.hour("hour_start")})
    return keyed.join(calendar(document), ["weekday", "hour"]).select(
        "hour_start",
        F.to_date("hour_start").alias("txn_date"),
        "hour",
        "day_of_week",
        "is_weekend",
        F.col("n").alias("transactions"),
        amount_of().alias("total_volume"),
    )

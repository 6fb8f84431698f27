"""Windows that late transactions still correct.

A window of the streaming engine closes when the watermark passes it, and what comes later is left out. Here the counts per
minute and hour of each micro-batch go into a ledger; the stored windows are its totals, so a late transaction changes
the window it belongs to whenever it arrives, and a repeated one changes nothing. Reading costs a row per
minute and level of the ledger, never a transaction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.money import mean_of, measured, sums
from ..model import schema
from ..operators.kpis import percent
from ..operators.sketches import SKETCHES, latency_by_day, latency_by_hour, latency_sketches, merge_sketches
from ..operators.time_kpis import spikes
from ..plans.ledger import Ledger
from ..sources import Part, PartTable

MINUTES = schema(
    "minute TIMESTAMP_NTZ, n BIGINT, n_fraud BIGINT, timed BIGINT, units BIGINT, parts BIGINT"
)


def per_minute(rows: DataFrame) -> DataFrame:
    """Counts and latency sums per minute; combined inside the map tasks."""
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")
    return rows.where(F.col("ts").isNotNull()).groupBy(minute).agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "Fraud").alias("n_fraud"),
        F.count(measured("processing_time")).alias("timed"), *sums("processing_time"),
    )


def added(partials: DataFrame, *keys: str | Column) -> DataFrame:
    return partials.groupBy(*(keys or ("minute",))).agg(*[F.sum(c).alias(c) for c in MINUTES.names[1:]])


class Windows:
    """The stored windows of a stream."""

    def __init__(self, spark: SparkSession, root: str, kpis: tuple[str, ...] = ()):
        """``kpis`` are the dimensions by whose keys latency is kept as well."""
        self.kpis = kpis
        self.minutes = Ledger(spark, f"{root}/minutes", MINUTES, added)
        self.sketches = Ledger(spark, f"{root}/sketches", SKETCHES, merge_sketches)

    def add(self, number: int, table: PartTable, newest: Part) -> None:
        """Enter the part of micro-batch ``number``, unless it is entered already."""
        for ledger, reduce_rows in ((self.minutes, per_minute), (self.sketches, self.sketch)):
            ledger.add(number, lambda r=reduce_rows: r(table.rows([newest])), lambda r=reduce_rows: r(table.rows()))

    def sketch(self, rows: DataFrame) -> DataFrame:
        return latency_sketches(rows, self.kpis)

    def vacuum(self, keep: int) -> None:
        self.minutes.vacuum(keep)
        self.sketches.vacuum(keep)

    def tpm(self) -> DataFrame:
        """Transactions per minute."""
        return _edges(self.minutes.totals(), "minute", 60).select("window_start", "window_end", F.col("n").alias("transactions"))

    def hourly(self) -> DataFrame:
        return added(self.minutes.totals(), F.date_trunc("hour", "minute").cast("timestamp_ntz").alias("hour"))

    def fraud(self) -> DataFrame:
        """Fraud rate and mean latency per hour."""
        return _edges(self.hourly(), "hour", 3600).select(
            "window_start", "window_end", F.col("n").alias("transactions"), F.col("n_fraud").alias("fraud_transactions"),
            percent(F.col("n_fraud"), F.col("n")).alias("fraud_rate_pct"), mean_of("timed").alias("avg_latency"),
        )

    def tables(self) -> dict[str, DataFrame]:
        """All of it, by name."""
        sketched = self.sketches.totals()
        return {
            "windows_tpm": self.tpm(), "windows_fraud": self.fraud(), "fraud_spikes": self.fraud_spikes(),
            "latency_by_day": latency_by_day(sketched), "latency_by_hour": latency_by_hour(sketched),
        }

    def fraud_spikes(self, until: Column | None = None, hours: int = 24, factor: float = 2.0) -> DataFrame:
        """Hours with a spike of fraud; with ``until``, those that have ended by then."""
        found = spikes(self.hourly().select("hour", "n_fraud"), hours, factor)
        ended = F.col("hour") + F.make_dt_interval(hours=F.lit(1))
        return found if until is None else found.where(ended <= until)


def _edges(rows: DataFrame, start: str, seconds: int) -> DataFrame:
    end = F.col(start) + F.make_dt_interval(secs=F.lit(seconds))
    return rows.withColumns({"window_start": F.col(start), "window_end": end})



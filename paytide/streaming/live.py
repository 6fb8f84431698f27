"""Live operators over an unbounded feed of transactions.

A feed has the event time in ``ts`` as TIMESTAMP (a watermark takes no TIMESTAMP_NTZ). Windows
combine inside the map tasks, so a minute that holds a third of the feed is one row per task. A
row later than the watermark is missing from its closed window; ``ingest`` stores it, so the batch KPIs count it
and ``late_rows`` tells how many there were.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.clock import latest, typed_time
from ..functions.money import amount_of, mean_of, measured, sums
from ..operators.enrich import LABELS, enrich
from ..operators.hot_cold import dedup_by_id, nameless
from ..operators.kpis import percent
from ..operators.quality import clean_valid, quarantine
from ..operators.serving import serving_rows
from ..operators.totals import merge, roll_up, totals
from ..model import STORED_FACT
from ..plans.ledger import Ledger
from ..plans.one_pass import reduce_fact
from ..plans.refresh import refresh_ledger, stored_kpis, vacuum
from ..sources import Part, PartTable, Source, read_or_empty
from ..sources.parts import parts_of, replaced
from .run import drain, use_large_state
from .windows import Windows

LATENESS = "10 minutes"

def _edges(grouped: DataFrame) -> DataFrame:
    """A result per window with the window's edges as columns."""
    start, end = (F.col(f"window.{edge}").cast("timestamp_ntz") for edge in ("start", "end"))
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(start.alias("window_start"), end.alias("window_end"), *rest)


def _windowed(feed: DataFrame, length: str, lateness: str, *aggregates: Column) -> DataFrame:
    window = F.window("ts", length).alias("window")
    return _edges(feed.withWatermark("ts", lateness).groupBy(window).agg(*aggregates))


def live_tpm(feed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Transactions per minute."""
    return _windowed(feed, "1 minute", lateness, F.count("*").alias("transactions"))


def live_moving_count(feed: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Transactions in the last 60 seconds, every 10 seconds.

    Each transaction belongs to six windows. Counting per 10 seconds first means that six copies are
    made of a count, not of every transaction.
    """
    slots = feed.withWatermark("ts", lateness).groupBy(F.window("ts", "10 seconds").alias("slot")).agg(F.count("*").alias("n"))
    counted = slots.groupBy(F.window(F.window_time("slot"), "60 seconds", "10 seconds").alias("window"))
    return _edges(counted.agg(F.sum("n").alias("transactions")))


def live_fraud(feed: DataFrame, length: str = "1 hour", lateness: str = LATENESS) -> DataFrame:
    """Fraud rate and mean latency per window."""
    counted = _windowed(
        feed,
        length,
        lateness,
        F.count("*").alias("transactions"),
        F.count_if(F.col("status") == "Fraud").alias("fraud_transactions"),
        *sums("processing_time"),
        F.count(measured("processing_time")).alias("timed"),
    )
    return counted.select(
        "window_start",
        "window_end",
        "transactions",
        "fraud_transactions",
        percent(F.col("fraud_transactions"), F.col("transactions")).alias("fraud_rate_pct"),
        mean_of("timed").alias("avg_latency"),
    )


def identity() -> Column:
    """A transaction's id; without one, the whole row stands for it."""
    return F.coalesce("transaction_id", nameless(STORED_FACT.names))


def stream_table(spark: SparkSession, root: str) -> PartTable:
    """The transactions of a stream: a part per micro-batch, small parts merged, days as folders."""
    return PartTable(spark, root, STORED_FACT, "txn_date")


def ingested(spark: SparkSession, root: str) -> DataFrame:
    """The transactions of all micro-batches so far."""
    return stream_table(spark, root).rows()


def store_batch(table: PartTable, batch: DataFrame, number: int, rejected: str | None = None) -> None:
    """Add to the stored transactions those of a micro-batch that are not there yet.

    Copies within the batch are collapsed with map-side combine; copies of stored transactions are
    found by id among the stored rows of the batch's own days, which are folders. However late a
    transaction is, it is stored, and ``late`` counts come from the table. The new part and the number of the
    micro-batch are one commit, so repeating it after a failure adds nothing. With ``rejected``, only valid rows are
    stored; the others go to that folder with what is wrong with them.
    """
    state = table.log.newest()[1]
    if number <= state.get("upto", -1):
        return
    if rejected is not None:
        quarantine(batch).write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        batch = clean_valid(batch)
    rows = typed_time(batch)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*STORED_FACT.names)
    days = [r[0] for r in rows.select("txn_date").distinct().collect()]
    same_days = F.col("txn_date").isin([d for d in days if d is not None])
    known = table.rows(parts_of(state)).where(same_days | F.col("txn_date").isNull() if None in days else same_days)
    known = known.select(F.col("txn_date").alias("known_day"), identity().alias("known"))
    fresh = dedup_by_id(rows).withColumn("identity", identity()).join(
        known, F.col("txn_date").eqNullSafe(F.col("known_day")) & (F.col("identity") == F.col("known")), "left_anti"
    )
    part = table.write(fresh.drop("identity"))
    table.log.commit(lambda now: replaced(now, [], [part] if part.rows else [], upto=number, newest=asdict(part)))


def newest_part(table: PartTable) -> Part:
    """What the newest micro-batch added."""
    return Part(**table.log.newest()[1]["newest"])


def ingest_writer(root: str, rejected: str | None = None) -> Callable[[DataFrame, int], None]:
    """What each micro-batch adds to the stored transactions (``store_batch``); small parts are merged as they gather."""

    def write(batch: DataFrame, number: int) -> None:
        table = stream_table(batch.sparkSession, root)
        store_batch(table, batch, number, rejected)
        table.compact()
        table.vacuum(KEPT_STATES)

    return write


def ingest(feed: DataFrame, root: str) -> DataFrame:
    """Store all available transactions, each once, and return the table.

    The table can be the origin of a ``HotStore``: the stream goes on while archive runs trim what counts as hot.
    """
    use_large_state(feed.sparkSession)
    drain(feed.writeStream.foreachBatch(ingest_writer(f"{root}/table")), f"{root}/checkpoint")
    return ingested(feed.sparkSession, f"{root}/table")


def late_rows(stored: DataFrame, behind: Column) -> DataFrame:
    """Number of stored transactions before a moment, such as a watermark the windows have passed."""
    return stored.agg(F.count_if(F.col("ts") < behind).alias("late_transactions"))


def ingest_and_refresh(
    root: str, dims: dict[str, DataFrame], out: str, rejected: str | None = None, windows: bool = False
) -> Callable[[DataFrame, int], None]:
    """A micro-batch that stores its transactions and publishes all KPIs over everything stored.

    Its new rows are reduced to totals once and entered into the ledger; the KPIs come from the ledger alone, so a refresh costs
    the same however long the stream has run. Parts are merged only after that, so a micro-batch that died
    between the two commits finds its own part again. What no reader takes any more is removed. With ``windows``, the
    counts, fraud spikes and latency percentiles per window are kept and published as well, corrected by late rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table, ledger = stream_table(spark, f"{root}/table"), Ledger(spark, f"{root}/ledger")
        store_batch(table, batch, number, rejected)
        newest = newest_part(table)
        ledger.add(number, lambda: reduce_fact(table.rows([newest]), LABELS), lambda: reduce_fact(table.rows(), LABELS))
        stored = Windows(spark, f"{root}/windows") if windows else None
        if stored is not None:
            stored.add(number, table, newest)
            stored.vacuum(KEPT_STATES)
        refresh_ledger(ledger.totals(), dims, out, None if stored is None else stored.tables())
        table.compact()
        table.vacuum(KEPT_STATES)
        ledger.vacuum(KEPT_STATES)
        vacuum(spark, out, KEPT_STATES)

    return write


# States, and refreshes, that readers may still be reading.
KEPT_STATES = 10


def live_kpis(feed: DataFrame, root: str, dims: dict[str, DataFrame]) -> DataFrame:
    """Process all available transactions; the long KPI table after the last micro-batch."""
    use_large_state(feed.sparkSession)
    drain(feed.writeStream.foreachBatch(ingest_and_refresh(root, dims, f"{root}/out")), f"{root}/checkpoint")
    return stored_kpis(feed.sparkSession, f"{root}/out")


def live_enriched(feed: DataFrame, dims: dict[str, DataFrame], root: str) -> DataFrame:
    """Process all available transactions into a table with dimension labels; returns the table.

    Each micro-batch joins the dimensions as a batch does, with adaptive execution, which a
    streaming join would not have, and lands in the folder of its number, so that repeating it
    replaces it.
    """
    use_large_state(feed.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        enrich(batch, dims).write.mode("overwrite").parquet(f"{root}/enriched/batch={number}")

    drain(feed.writeStream.foreachBatch(write), f"{root}/checkpoint")
    schema = enrich(feed, dims).schema
    return feed.sparkSession.read.schema(schema).parquet(f"{root}/enriched")


SEGMENTS = "customer_segment STRING, n BIGINT, n_priced BIGINT, n_odd BIGINT, units BIGINT, parts BIGINT, n_fraud BIGINT"


def segments_until(spark: SparkSession, root: str, number: int) -> DataFrame:
    """Totals per segment after micro-batch ``number``; empty before the first, but never missing after it."""
    stored = Source(f"{root}/segments/batch={number}")
    read = stored.read if number >= 0 else partial(read_or_empty, source=stored)
    return read(spark, schema=StructType.fromDDL(SEGMENTS))


def segment_writer(customers: DataFrame, root: str) -> Callable[[DataFrame, int], None]:
    """What each micro-batch does to the KPI per customer segment and its serving row.

    The batch is reduced per customer, enriched with the static dimension (a batch join: a small
    dimension is broadcast, a large one merge-joined with reduced rows), added to the totals of the
    batch before, and written under its own number. Repeating a batch after a failure
    reads the same predecessor and replaces the same folder, so nothing is counted twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = roll_up(totals(batch, "customer_id"), customers, "customer_id", "customer_segment")
        both = fresh.unionByName(segments_until(spark, root, number - 1))
        merge(both, "customer_segment").coalesce(1).write.mode("overwrite").parquet(f"{root}/segments/batch={number}")
        kpi = segments_until(spark, root, number).select(
            F.lit("customer").alias("kpi"),
            F.col("customer_segment").alias("dim_value"),
            F.col("n").alias("transactions"),
            amount_of().alias("total"),
            mean_of("n_priced").alias("average"),
        )
        serving_rows(kpi).write.mode("overwrite").parquet(f"{root}/serving/batch={number}")

    return write


def live_segments(feed: DataFrame, customers: DataFrame, root: str) -> DataFrame:
    """Process all available transactions and return the serving rows after the last micro-batch."""
    spark: SparkSession = feed.sparkSession
    use_large_state(spark)
    writer = feed.writeStream.foreachBatch(segment_writer(customers, root))
    drain(writer, f"{root}/checkpoint")
    served = spark.read.schema("key STRING, payload STRING, batch BIGINT").parquet(f"{root}/serving")
    return served.where(F.col("batch") == latest(served, "batch")).drop("batch")

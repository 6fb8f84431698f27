"""Retention of the hot table and its archive."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.checksum import checksum, difference, total
from ..functions.clock import moment
from ..model import STORED_FACT
from ..sources import ArchiveRun, Conflict, HotStore, LostRows
from .hot_cold import expired, hot_cold_union

HOT_HOURS = 3
HOT_BYTES = 300_000_000

# Bytes of the fixed-width columns of a stored transaction, eight each.
FIXED_BYTES = 8 * 8
TEXT_COLUMNS = ("transaction_id", "transaction_timestamp", "status")


def hot_span(hours: int = HOT_HOURS) -> Column:
    return F.make_dt_interval(hours=F.lit(hours))


def since(fact: DataFrame, start: Column) -> Column:
    """At or after a moment.

    Spark has no Parquet filter for TIMESTAMP_NTZ, so the day is compared as well: on a stored
    fact that skips row groups and folders.
    """
    recent = F.col("ts") >= start
    return recent & (F.col("txn_date") >= start.cast("date")) if "txn_date" in fact.columns else recent


def retain_hot(fact: DataFrame, cutoff: Column) -> DataFrame:
    """Rows at or after the cutoff."""
    return fact.where(since(fact, cutoff))


def archive_expired(fact: DataFrame, cutoff: Column) -> DataFrame:
    """The other rows: with ``retain_hot`` an exact, disjoint split."""
    return fact.where(expired("ts", cutoff))


def live_count(fact: DataFrame, start: Column) -> DataFrame:
    """Number of transactions at or after a moment."""
    return fact.where(since(fact, start)).agg(F.count("*").alias("live_transactions"))


def row_bytes() -> Column:
    size = F.lit(FIXED_BYTES)
    for name in TEXT_COLUMNS:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return size.cast("bigint")


def _edge(rows: DataFrame, budget: int) -> tuple[datetime, int] | None:
    """The newest minute that does not fit whole, and the bytes that are used before it.

    One scan. Only the sums per minute are ordered, and one row reaches the driver.
    """
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")
    sizes = rows.groupBy(minute).agg(F.sum(row_bytes()).alias("bytes"))
    running = F.sum("bytes").over(Window.orderBy(F.desc("minute")).rowsBetween(Window.unboundedPreceding, 0))
    over = sizes.withColumn("running", running).where(F.col("running") > budget)
    first = over.orderBy(F.desc("minute")).first()
    return None if first is None else (first.minute, first.running - first.bytes)


def split_by_size(fact: DataFrame, budget: int = HOT_BYTES) -> tuple[DataFrame, DataFrame, datetime | None]:
    """(kept, the others, time from which all is kept): the newest rows that fit into a byte budget.

    Whole minutes are taken as long as they fit, and in the minute that does not fit rows by time and id, so all that fits
    is kept and a busy hour cannot empty the table. Rows without time are not kept. Without a budget overrun the
    time is None.
    """
    timed = fact.where(F.col("ts").isNotNull())
    untimed = fact.where(F.col("ts").isNull())
    edge = _edge(timed, budget)
    if edge is None:
        return timed, untimed, None
    minute, used = edge
    start, end = moment(minute), moment(minute + timedelta(minutes=1))
    # One minute of rows is ordered, none else.
    newest = Window.orderBy(F.desc("ts"), F.asc_nulls_last("transaction_id")).rowsBetween(Window.unboundedPreceding, 0)
    last = timed.where(since(timed, start) & (F.col("ts") < end))
    fits = last.withColumn("fits", F.sum(row_bytes()).over(newest) + used <= budget)
    newer, older = fact.where(since(fact, end)), timed.where(F.col("ts") < start)
    kept = hot_cold_union(newer, fits.where("fits").drop("fits"))
    return kept, hot_cold_union(older, fits.where("NOT fits").drop("fits"), untimed), minute + timedelta(minutes=1)


def retain_by_size(fact: DataFrame, budget: int = HOT_BYTES) -> DataFrame:
    """The newest rows that fit into a byte budget."""
    return split_by_size(fact, budget)[0]


def archive_manifest(fact: DataFrame, as_of: Column, cutoff: Column) -> DataFrame:
    """What a run at ``as_of`` would find, keep and archive: one pass, one row."""
    found = fact.agg(
        F.min("ts").alias("min_ts"),
        F.max("ts").alias("max_ts"),
        F.count("*").alias("rows"),
        F.count_if(F.col("ts") >= cutoff).alias("kept"),
        F.count_if(expired("ts", cutoff)).alias("expired"),
        checksum(sorted(c for c in fact.columns if c in STORED_FACT.names)).alias("checksum"),
    )
    batch_id = F.unix_seconds(as_of.cast("timestamp"))
    return found.select(batch_id.alias("batch_id"), cutoff.alias("cutoff"), *found.columns)


def facts(where: Column | None = None) -> list[Column]:
    """Aggregates: count, time span and checksum of all rows, or of those that fulfil a condition."""
    here = F.lit(True) if where is None else where
    return [
        F.count_if(here).alias("rows"),
        F.min(F.when(here, F.col("ts"))).alias("min_ts"),
        F.max(F.when(here, F.col("ts"))).alias("max_ts"),
        checksum(sorted(STORED_FACT.names), where).alias("checksum"),
    ]


def stored_facts(df: DataFrame) -> DataFrame:
    """Count, time span and checksum of whole rows, whatever their order."""
    return df.agg(*facts())


# How often a run is made again when another run or a merge was faster.
ATTEMPTS = 5


def archive_run(
    store: HotStore, as_of: datetime, hours: int = HOT_HOURS, snapshot: bool = False, budget: int | None = None
) -> bool:
    """Archive the hot table and trim it; False when there was nothing to do.

    By default only the expired rows go to the archive, so hot and cold stay disjoint. With a byte
    budget, live rows that do not fit go there too. ``snapshot`` archives everything, including what
    stays live. The run reads one unchanging state throughout, compares what it wrote with what
    it read, and commits last; what is ingested meanwhile stays live. A run that another one overtook is made again.
    """
    for attempt in range(ATTEMPTS):
        try:
            return _archive_once(store, as_of, hours, snapshot, budget)
        except Conflict:
            if attempt + 1 == ATTEMPTS:
                raise
    return False


def _archive_once(store: HotStore, as_of: datetime, hours: int, snapshot: bool, budget: int | None) -> bool:
    spark, state = store.spark, store.snapshot()
    until = as_of - timedelta(hours=hours)
    batch_id = int(as_of.replace(tzinfo=timezone.utc).timestamp())
    if store.runs(state).where(F.col("batch_id") == batch_id).count():
        return False
    hot = store.current(state)
    gone = expired("ts", moment(until))
    # One scan tells all there is and all that goes; checksums add up, so what stays is the difference.
    found = hot.agg(F.struct(*facts()).alias("all"), F.struct(*facts(gone)).alias("gone")).first()
    if found["all"].rows == 0:
        return False
    if store.origin is None:
        wanted_parts = sum(p.rows for p in state.parts), total([p.checksum for p in state.parts])
        if (found["all"].rows, found["all"].checksum) != wanted_parts:
            raise LostRows(f"the live parts hold {found['all'].rows} rows, not those committed: {wanted_parts}")
    kept, moved, wanted = retain_hot(hot, moment(until)), archive_expired(hot, moment(until)), found["gone"]
    if budget is not None:
        kept, over, all_from = split_by_size(kept, budget)
        if all_from is not None:
            moved, until = hot_cold_union(moved, over), max(until, all_from)
            wanted = stored_facts(moved).first()
    kept_rows, kept_sum = found["all"].rows - wanted.rows, difference(found["all"].checksum, wanted.checksum)
    batch_rows, wanted = (hot, found["all"]) if snapshot else (moved, wanted)
    folder = store.batch_folder(batch_id)
    stored = store.write_batch(batch_rows, batch_id, folder)
    if stored_facts(stored).first() != wanted:
        raise LostRows(f"batch {batch_id} does not hold the rows of {wanted}; nothing was committed")
    part = None
    if store.origin is None:
        part = store.write_part(kept, state.generation + 1)
        if (part.rows, part.checksum) != (kept_rows, kept_sum):
            raise LostRows(f"{part} does not hold the {kept_rows} rows kept; nothing was committed")
    else:
        # What leaves the live table, told from the batch as it lies on disk.
        store.write_fingerprints(stored.where(expired("ts", moment(until))) if snapshot else stored, folder)
    row = spark.range(1).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(state.generation + 1).cast("bigint").alias("generation"),
        moment(until).alias("cutoff"),
        moment(wanted.min_ts).alias("min_ts"),
        moment(wanted.max_ts).alias("max_ts"),
        F.lit(found["all"].rows).cast("bigint").alias("rows"),
        F.lit(kept_rows).cast("bigint").alias("kept"),
        F.lit(found["all"].rows - kept_rows).cast("bigint").alias("expired"),
        F.lit(wanted.checksum).alias("checksum"),
        F.lit(not snapshot).alias("whole"),
        F.lit(folder).alias("folder"),
        F.lit(wanted.rows).cast("bigint").alias("stored"),
    )
    store.commit(ArchiveRun(state, row, part))
    return True


def archived_rows(store: HotStore, runs: DataFrame) -> DataFrame:
    """What the batches of some runs hold of transactions that left the hot table at their run.

    A snapshot also holds what stayed live; the next batch or the live table has that, so nothing
    is counted twice: its rows are compared with the cutoff of their run, which a join with the manifest's few rows gives.
    Only the folders of these runs are listed and read, and one that is gone raises.
    """
    rows = store.archived(runs)
    snapshots = runs.where("NOT whole").select("batch_id", "cutoff")
    if snapshots.isEmpty():
        return rows.drop("batch_id")
    left = rows.join(snapshots, "batch_id", "left").where(F.col("cutoff").isNull() | expired("ts", F.col("cutoff")))
    return left.select(*STORED_FACT.names)


def archived_once(store: HotStore) -> DataFrame:
    """Hot and cold, of one state of the store, as one fact in which every transaction appears once.

    Going through the manifest, one row per run, leaves out batches that were never committed.
    """
    state = store.snapshot()
    return store.current(state).unionByName(archived_rows(store, store.runs(state)))

"""The KPI refresh: hot and archive in, KPI tables and serving rows out."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.clock import moment
from ..model import DIMENSIONS, KPI_TABLES, SERVING, schema
from ..operators.enrich import LABELS
from ..operators.retention import archived_once, archived_rows
from ..operators.serving import serving_rows
from ..operators.totals import merge
from ..sources import HotStore, Snapshot, Source, load_dimension, read_or_empty, register, remove_folder
from .ledger import TOTALS
from .one_pass import Header, kpi_all_one_pass, label_totals, long_kpis, reduce_fact

LONG = "kpi STRING, dim_value STRING, transactions BIGINT, total DOUBLE, average DOUBLE"
RUNS = schema("run BIGINT, run_at TIMESTAMP_NTZ")


def published_runs(spark: SparkSession, out: str) -> DataFrame:
    """Committed refreshes, one row each."""
    return read_or_empty(spark, Source(f"{out}/log"), RUNS)


def run_path(out: str, run: int) -> str:
    return f"{out}/run={run}"


def latest_run(spark: SparkSession, out: str) -> str:
    """Where the newest committed refresh lies; raises if there is none."""
    newest = published_runs(spark, out).agg(F.max("run")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no refresh was published to {out}")
    return run_path(out, newest)


def stored_kpis(spark: SparkSession, out: str) -> DataFrame:
    """The long KPI table of the newest refresh."""
    return Source(f"{latest_run(spark, out)}/kpis").read(spark, schema(LONG))


def stored_serving(spark: SparkSession, out: str) -> DataFrame:
    """The serving rows of the newest refresh."""
    return Source(f"{latest_run(spark, out)}/serving").read(spark, SERVING)


def publish(
    kpis: DataFrame, out: str, run_at: datetime | None = None, more: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Store a long KPI table, and derive the result tables and the JSON from the stored rows. ``more`` tables are stored with them.

    Each refresh has a folder of its own, and a row in the log, with its time, commits it: readers see the
    tables of one refresh, never of two, and a refresh that dies is not seen. Returns the stored long table and the
    stored serving rows. Everything after the first write reads a few thousand rows, so a lost executor
    costs no second scan of the fact.
    """
    spark = kpis.sparkSession
    run = (published_runs(spark, out).agg(F.max("run")).first()[0] or 0) + 1
    folder = run_path(out, run)
    kpis.write.mode("overwrite").parquet(f"{folder}/kpis")
    stored = Source(f"{folder}/kpis").read(spark, schema(LONG))
    for kpi, (table, *_rest) in KPI_TABLES.items():
        kpi_table(stored, kpi).write.mode("overwrite").parquet(f"{folder}/{table}")
    serving_rows(stored).coalesce(1).write.mode("overwrite").parquet(f"{folder}/serving")
    for table, rows in (more or {}).items():
        rows.write.mode("overwrite").parquet(f"{folder}/{table}")
    at = moment(run_at or datetime.now(timezone.utc).replace(tzinfo=None))
    row = spark.range(1).select(F.lit(run).cast("bigint").alias("run"), at.alias("run_at"))
    row.coalesce(1).write.mode("append").parquet(f"{out}/log")
    return stored, Source(f"{folder}/serving").read(spark, SERVING)


def vacuum(spark: SparkSession, out: str, keep: int = 1) -> list[str]:
    """Remove the folders of all but the newest ``keep`` committed refreshes; returns them.

    What the newest rows name is never removed, and nothing newer than the newest row, which a refresh may be writing.
    """
    runs = [r.run for r in published_runs(spark, out).orderBy(F.desc("run")).collect()]
    old = [run_path(out, run) for run in runs[max(1, keep):]]
    return [path for path in old if remove_folder(spark, path)]


def vacuum_store(store: HotStore, keep: int = 1) -> list[str]:
    """Remove what no reader of the newest ``keep`` states takes: parts of the hot table, and totals of earlier generations."""
    done = read_or_empty(store.spark, Source(f"{store.root}/totals/log"), schema("generation BIGINT"))
    totals_now = done.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
    old = [f"{store.root}/totals/generation={g}" for g in range(totals_now)]
    return store.vacuum(keep) + [path for path in old if remove_folder(store.spark, path)]


def newest_totals(spark: SparkSession, out: str) -> DataFrame:
    """The newest stored refresh and its global KPI: (run, run_at, transactions, total, average)."""
    newest = published_runs(spark, out).orderBy(F.desc("run")).first()
    if newest is None:
        raise FileNotFoundError(f"no refresh was published to {out}")
    return stored_kpis(spark, out).where(F.col("kpi") == "global").select(
        F.lit(newest.run).cast("bigint").alias("run"), moment(newest.run_at).alias("run_at"), "transactions", "total", "average"
    )


def refresh(
    fact: DataFrame, dims: dict[str, DataFrame], out: str, header: Header | None = None, run_at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Compute and publish all KPIs from one scan of a whole fact."""
    return publish(kpi_all_one_pass(fact, dims, header), out, run_at)


def archived_totals(store: HotStore, now: int | Snapshot) -> DataFrame:
    """Totals per (kpi, key) of all batches up to generation ``now``, reading each only once ever.

    On that occasion a batch is compared with its manifest row: lost, doubled and changed rows raise.

    Archived batches do not change and totals add up, so the totals up to the last refresh are stored,
    and only the batches of later runs are scanned and added. As in the hot store, a row in a log
    commits the new totals, and a refresh that dies before it can be repeated.
    """
    spark, root = store.spark, f"{store.root}/totals"
    state = now if isinstance(now, Snapshot) else store.snapshot()
    now = state.generation if isinstance(now, Snapshot) else now
    log = read_or_empty(spark, Source(f"{root}/log"), schema("generation BIGINT"))
    done = log.agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
    stored = Source(f"{root}/generation={done}")
    # Before the first refresh there are no totals; after it they must be there.
    known = stored.read(spark, TOTALS) if done else read_or_empty(spark, stored, TOTALS)
    if now <= done:
        return known
    runs = store.runs(state).where(F.col("generation").between(done + 1, now))
    store.verify_batches(runs)
    fresh = reduce_fact(archived_rows(store, runs), LABELS)
    merge(known.unionByName(fresh), "kpi", "key").write.mode("overwrite").parquet(f"{root}/generation={now}")
    spark.range(1).select(F.lit(now).cast("bigint").alias("generation")).write.mode("append").parquet(f"{root}/log")
    return Source(f"{root}/generation={now}").read(spark, TOTALS)


def refresh_store(store: HotStore, dims: dict[str, DataFrame], out: str) -> tuple[DataFrame, DataFrame]:
    """Publish all KPIs of a hot store; scans the live rows and the batches new since the last time.

    The dimensions are joined anew each time, so a changed label moves the past as well.
    """
    state = store.snapshot()
    live = reduce_fact(store.current(state), LABELS)
    whole = merge(archived_totals(store, state).unionByName(live), "kpi", "key")
    return publish(long_kpis(label_totals(whole, dims)), out)


def refresh_ledger(
    totals: DataFrame, dims: dict[str, DataFrame], out: str, more: dict[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Publish all KPIs from totals per key, and other tables with them; reads no transaction."""
    return publish(long_kpis(label_totals(totals, dims)), out, more=more)


def kpi_table(stored: DataFrame, kpi: str) -> DataFrame:
    """One KPI table, under its own column names and in its own order, from the long form.

    One row per day or label: a single sorted file.
    """
    _table, _key, label, n, total, average = KPI_TABLES[kpi]
    rows = stored.where(F.col("kpi") == kpi)
    columns = [F.col("transactions").alias(n), F.col("total").alias(total), F.col("average").alias(average)]
    if label is None:
        return rows.select(*columns)
    value = F.col("dim_value").cast("date") if label == "txn_date" else F.col("dim_value")
    order = [label] if label == "txn_date" else [F.desc(total), label]
    return rows.select(value.alias(label), *columns).coalesce(1).sortWithinPartitions(*order)


def load_dims(spark: SparkSession, dims_root: str) -> dict[str, DataFrame]:
    """The dimensions of the KPI tables, by KPI."""
    names = {"merchant": "merchants_dim", "customer": "customers_dim", "payment": "payment_methods_dim"}
    return {kpi: load_dimension(spark, name, Source(f"{dims_root}/{name}")) for kpi, name in names.items()}


def load_model(store: HotStore, dims_root: str) -> dict[str, DataFrame]:
    """The fact (hot and cold, each transaction once) and all dimensions, also as views for SQL."""
    tables = {"transactions_fact": archived_once(store)}
    for name in DIMENSIONS:
        tables[name] = load_dimension(store.spark, name, Source(f"{dims_root}/{name}"))
    register(tables)
    return tables

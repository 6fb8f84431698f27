"""One registered query per operator, over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import session
from ..functions.clock import latest, moment
from ..functions.money import measured
from ..model import KPI_TABLES, schema
from ..operators import dims as dim_ops
from ..operators import history, hot_cold, kpis, latency, quality, retention, serving, sketches, time_kpis
from ..operators.totals import roll_up, totals
from ..sources import ArchiveRun, HotStore, Source, has_rows, sample
from ..streaming import live
from ..streaming.run import read_feed, to_table
from ..streaming.windows import Windows
from . import one_pass
from .refresh import archived_totals, load_model, newest_totals, refresh, refresh_store

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

ID_TIME = ("transaction_id", "ts")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def all_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "merchant": sample.merchants(spark, sf_dir),
        "customer": sample.customers(spark, sf_dir),
        "payment": sample.payment_methods(spark, sf_dir),
        "device": sample.devices(spark, sf_dir),
    }


def fact_rows(fact: DataFrame) -> DataFrame:
    return fact.select(*sample.FEED_COLUMNS)


# ---- KPIs of the star schema -------------------------------------------------------------


@query
def kpi_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_global(sample.order_lines(spark, sf_dir))


@query
def kpi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_daily(sample.order_lines(spark, sf_dir))


@query
def kpi_by_merchant_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_by_merchant_category(sample.order_lines(spark, sf_dir), sample.merchants(spark, sf_dir))


@query
def kpi_daily_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals of amounts with six decimals: price less discount plus tax."""
    return kpis.kpi_daily(sample.taxed_lines(spark, sf_dir))


def totals_by_header(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Totals per column of the order header: lines are reduced per order before they meet it."""
    per_order = totals(sample.order_lines(spark, sf_dir), "order_id")
    return roll_up(per_order, sample.order_headers(spark, sf_dir), "order_id", key)


@query
def kpi_by_customer_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = totals_by_header(spark, sf_dir, "customer_id")
    return kpis.kpi_by_label(
        per_customer, sample.customers(spark, sf_dir), "customer_id", "customer_segment",
        "transactions", "total_spend", "avg_spend",
    )


@query
def kpi_by_payment_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_method = totals_by_header(spark, sf_dir, "payment_method_id")
    return kpis.kpi_by_label(
        per_method, sample.payment_methods(spark, sf_dir), "payment_method_id", "method_type",
        "transactions", "total_volume", "avg_value",
    )


@query
def kpi_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_by_device(sample.order_lines(spark, sf_dir), sample.devices(spark, sf_dir))


@query
def kpi_by_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    calendar = dim_ops.calendar(dim_ops.datetime_document(spark))
    return kpis.kpi_by_calendar(sample.feed(spark, sf_dir), calendar)


@query
def kpi_all_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, header = sample.order_lines(spark, sf_dir), sample.order_headers(spark, sf_dir)
    return one_pass.kpi_all_one_pass(lines, all_dims(spark, sf_dir), (header, "order_id"))


@query
def kpi_fraud_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, header = sample.order_lines(spark, sf_dir), sample.order_headers(spark, sf_dir)
    return one_pass.kpi_fraud_rate(lines, all_dims(spark, sf_dir), (header, "order_id"))


@query
def kpi_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.kpi_latency(sample.order_lines(spark, sf_dir))


@query
def kpi_latency_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.kpi_latency_approx(sample.order_lines(spark, sf_dir))


@query
def kpi_latency_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency per day from sketches of three parts of the fact, and whether its percentiles are within 3 % of their ranks."""
    fact = sample.feed(spark, sf_dir)
    parts = [
        sketches.latency_sketches(fact.where(F.pmod(F.col("transaction_id").cast("bigint"), F.lit(3)) == n)) for n in range(3)
    ]
    days = sketches.latency_by_day(sketches.merge_sketches(reduce(DataFrame.unionByName, parts)))
    ranked = fact.select("txn_date", measured("processing_time").alias("v")).join(days, "txn_date")
    within = [
        (F.try_divide(F.count_if(F.col("v") < F.col(name)), F.count("v")) <= p + 0.03)
        & (F.try_divide(F.count_if(F.col("v") <= F.col(name)), F.count("v")) >= p - 0.03)
        for p, name in ((0.5, "p50_latency"), (0.95, "p95_latency"))
    ]
    return ranked.groupBy("txn_date", "transactions", "avg_latency").agg(
        within[0].alias("p50_within"), within[1].alias("p95_within")
    )


@query
def kpi_by_segment_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI by the segment a customer had at the time: a signup makes one New, an error Risky."""
    fact = sample.feed(spark, sf_dir)
    past = history.versions(sample.segment_changes(spark, sf_dir), "customer_id", "ts", ["customer_segment"], "version")
    return kpis.kpi_by_own_label(history.as_of(fact, past, "customer_id", ["customer_segment"]), "customer")


@query
def kpi_tpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_kpis.kpi_tpm(sample.feed(spark, sf_dir))


@query
def kpi_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_kpis.kpi_velocity(sample.feed(spark, sf_dir))


@query
def kpi_fraud_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_kpis.kpi_fraud_spikes(sample.feed(spark, sf_dir))


# ---- hot and cold ------------------------------------------------------------------------


@query
def hot_cold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, live_rows = sample.overlapping(sample.feed(spark, sf_dir))
    return fact_rows(hot_cold.hot_cold_union(live_rows, first, second))


@query
def hot_cold_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, live_rows = sample.overlapping(sample.feed(spark, sf_dir))
    return fact_rows(hot_cold.dedup_by_id(hot_cold.hot_cold_union(live_rows, first, second)))


@query
def hot_cold_dedup_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, live_rows = sample.overlapping(sample.feed(spark, sf_dir))
    cutoffs = [sample.moment(text) for text in sample.CUTOFFS]
    return fact_rows(hot_cold.dedup_by_cutoff(live_rows, list(zip((first, second), cutoffs))))


@query
def kpi_daily_double_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily KPI over overlapping snapshots as they are, copies counted again."""
    first, second, live_rows = sample.overlapping(sample.feed(spark, sf_dir))
    return kpis.kpi_daily(hot_cold.hot_cold_union(live_rows, first, second))


@query
def kpi_daily_hot_cold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily KPI over the same snapshots with each transaction counted once."""
    first, second, live_rows = sample.overlapping(sample.feed(spark, sf_dir))
    cutoffs = [sample.moment(text) for text in sample.CUTOFFS]
    return kpis.kpi_daily(hot_cold.dedup_by_cutoff(live_rows, list(zip((first, second), cutoffs))))


def newest(fact: DataFrame) -> datetime:
    return fact.agg(F.max("ts")).first()[0]


def archived(spark: SparkSession, sf_dir: str, name: str, snapshot: bool) -> DataFrame:
    """Run the archive over the feed as the live table, and read the batch back."""
    fact = sample.feed(spark, sf_dir)
    store = HotStore(spark, session.work_path(spark, name), fact)
    retention.archive_run(store, newest(fact), snapshot=snapshot)
    return fact_rows(store.archive())


@query
def archive_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(spark, sf_dir, "archive_snapshot", snapshot=True)


@query
def archive_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(spark, sf_dir, "archive_expired", snapshot=False)


@query
def retain_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write what stays live as the next generation and read it."""
    fact = sample.feed(spark, sf_dir)
    store = HotStore(spark, session.work_path(spark, "retain_hot"), fact)
    kept = retention.retain_hot(store.current(), latest(fact, back=retention.hot_span()))
    return fact_rows(store.write_generation(kept, 1))


class Busy(HotStore):
    """A store into which rows arrive between an archive run's read and its commit."""

    arriving: DataFrame | None = None

    def commit(self, run: ArchiveRun) -> None:
        if self.arriving is not None:
            arriving, self.arriving = self.arriving, None
            self.ingest(arriving)
        super().commit(run)


@query
def archive_with_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archive runs over a store of its own, during each of which rows arrive, late ones in the first.

    Returns each transaction with the place it ends in.
    """
    store = Busy(spark, session.work_path(spark, "archive_with_ingest"))
    fact = sample.feed(spark, sf_dir)
    first, second = (F.col("ts") < moment(run) for run in sample.RUNS)
    late = F.col("transaction_id").cast("bigint") % 50 == 0
    turns = [(first & ~late, first & late), (~first & second, F.coalesce(~second, F.lit(True)))]
    for run, (before, during) in zip(sample.RUNS, turns):
        store.ingest(fact.where(before))
        store.arriving = fact.where(during)
        retention.archive_run(store, datetime.fromisoformat(run))
    hot = store.current().select(*ID_TIME, F.lit("hot").alias("place"))
    batch = F.from_unixtime("batch_id", "yyyy-MM-dd")
    return hot.unionByName(store.archive().select(*ID_TIME, batch.alias("place")))


@query
def archive_two_runs_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live table kept elsewhere over two archive runs, with new and late rows in between.

    Every fiftieth transaction arrives one run late. Returns each transaction with the place it ends in.
    """
    root = session.work_path(spark, "archive_two_runs_external")
    fact = sample.feed(spark, sf_dir)
    late = F.col("transaction_id").cast("bigint") % 50 == 0
    there = [
        (F.col("ts") < moment(sample.RUNS[0])) & ~late,
        (F.col("ts") < moment(sample.RUNS[0])) | ((F.col("ts") < moment(sample.RUNS[1])) & ~late),
    ]
    for run, arrived in zip(sample.RUNS, there):
        retention.archive_run(HotStore(spark, root, fact.where(arrived)), datetime.fromisoformat(run))
    store = HotStore(spark, root, fact)
    hot = store.current().select(*ID_TIME, F.lit("hot").alias("place"))
    batch = F.from_unixtime("batch_id", "yyyy-MM-dd")
    return hot.unionByName(store.archive().select(*ID_TIME, batch.alias("place")))


@query
def retain_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a seventh of the bytes holds, and of that what a two-thousandth holds: less than the newest hour."""
    fact = sample.feed(spark, sf_dir)
    everything = fact.agg(F.sum(retention.row_bytes())).first()[0] or 0
    kept = retention.retain_by_size(fact, everything // 7)
    tight = retention.retain_by_size(fact, everything // 2000).select(F.col("transaction_id").alias("newest"), F.lit(True).alias("tight"))
    return kept.join(tight, F.col("transaction_id") == F.col("newest"), "left").select(
        *ID_TIME, retention.row_bytes().alias("row_bytes"), F.coalesce("tight", F.lit(False)).alias("tight")
    )


@query
def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = sample.feed(spark, sf_dir)
    return retention.archive_manifest(fact, latest(fact), latest(fact, back=retention.hot_span())).drop("checksum")


# ---- quality -----------------------------------------------------------------------------


@query
def clean_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(quality.clean_valid(sample.faulty_feed(spark, sf_dir)))


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.quarantine(sample.faulty_feed(spark, sf_dir))
    return bad.select("transaction_id", "customer_id", "transaction_timestamp", "transaction_amount", quality.REASONS)


@query
def ri_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {
        "customer_id": sample.customers(spark, sf_dir),
        "merchant_id": sample.merchants(spark, sf_dir),
        "device_id": sample.devices(spark, sf_dir),
        "payment_method_id": sample.payment_methods(spark, sf_dir),
    }
    return quality.ri_orphans(sample.faulty_feed(spark, sf_dir), dims)


@query
def label_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.label_consistency(sample.faulty_feed(spark, sf_dir).withColumn("transaction_amount", F.abs("transaction_amount")))


@query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_profile(sample.faulty_feed(spark, sf_dir))


@query
def column_profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_profile_approx(sample.faulty_feed(spark, sf_dir))


# ---- dimensions --------------------------------------------------------------------------


@query
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_ops.dim_upsert(
        sample.customers(spark, sf_dir), sample.customer_updates(spark, sf_dir), "customer_id"
    )


@query
def datetime_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_ops.datetime_dim(sample.feed(spark, sf_dir), dim_ops.datetime_document(spark))


# ---- sources -----------------------------------------------------------------------------


@query
def tables_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which parts of the model hold anything: read to the first row each, and joined to the number of all rows."""
    parts = {
        "transactions": sample.feed(spark, sf_dir), "customers": sample.customers(spark, sf_dir),
        "merchants": sample.merchants(spark, sf_dir), "refused": sample.feed(spark, sf_dir).where("status = 'Refused'"),
    }
    rows = [
        df.agg(F.lit(name).alias("part"), F.lit(has_rows(df)).alias("has_rows"), F.count("*").alias("rows")) for name, df in parts.items()
    ]
    return reduce(DataFrame.unionAll, rows)


# ---- serving -----------------------------------------------------------------------------


def refreshed(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    dims = all_dims(spark, sf_dir)
    del dims["device"]
    header = (sample.order_headers(spark, sf_dir), "order_id")
    return refresh(sample.order_lines(spark, sf_dir), dims, session.work_path(spark, name), header)


@query
def kpi_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole refresh job; returns the stored long KPI table."""
    stored, _serving = refreshed(spark, sf_dir, "kpi_refresh")
    return stored


@query
def kpi_refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archive runs, each followed by its totals; the refresh adds what is live to the stored totals."""
    store = HotStore(spark, session.work_path(spark, "kpi_refresh_incremental"), sample.feed(spark, sf_dir))
    for run in sample.RUNS:
        retention.archive_run(store, datetime.fromisoformat(run))
        archived_totals(store, store.generation())
    stored, _serving = refresh_store(store, all_dims(spark, sf_dir), f"{store.root}/out")
    return stored


@query
def serving_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    _stored, rows = refreshed(spark, sf_dir, "serving_json")
    return rows


@query
def serving_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All KPIs as the dashboard gets them: written as JSON, stored, read and parsed."""
    _stored, rows = refreshed(spark, sf_dir, "serving_roundtrip")
    return reduce(DataFrame.unionAll, [serving.load_kpi_long(rows, kpi) for kpi in KPI_TABLES])


@query
def serving_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served arrays element by element: days ascend, other KPIs descend by total."""
    _stored, rows = refreshed(spark, sf_dir, "serving_order")
    return serving.served_elements(rows)


@query
def kpi_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over the model of a store, its tables read with their declared schemas."""
    root = session.work_path(spark, "kpi_sql_views")
    tables = {
        "customers_dim": sample.customers(spark, sf_dir), "merchants_dim": sample.merchants(spark, sf_dir),
        "devices_dim": sample.devices(spark, sf_dir), "payment_methods_dim": sample.payment_methods(spark, sf_dir),
    }
    for name, dim in tables.items():
        Source(f"{root}/dims/{name}").write(dim)
    store = HotStore(spark, f"{root}/store", sample.feed(spark, sf_dir))
    retention.archive_run(store, datetime.fromisoformat(sample.RUNS[0]))
    load_model(store, f"{root}/dims")
    return spark.sql(
        """SELECT customer_segment, status, count(*) AS transactions, max(transaction_amount) AS largest,
                  count(DISTINCT merchant_id) AS merchants
           FROM transactions_fact INNER JOIN customers_dim USING (customer_id) GROUP BY customer_segment, status"""
    )


@query
def kpi_table_text_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily KPI from a store that keeps days as text."""
    path = session.work_path(spark, "kpi_table_text_days")
    daily = kpis.kpi_daily(sample.order_lines(spark, sf_dir))
    text = Source(path, "json")
    text.write(daily.withColumn("txn_date", F.col("txn_date").cast("string")))
    columns = schema("txn_date STRING, transactions BIGINT, total_volume DOUBLE, avg_value DOUBLE")
    return serving.load_kpi_table(spark, text, columns)


@query
def merchant_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit("2024-01-01").cast("date")
    return dim_ops.merchant_tenure(sample.registered_merchants(spark, sf_dir), today)


@query
def feed_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = quality.typed_numbers(sample.text_feed(spark, sf_dir))
    return typed.select("transaction_id", "customer_id", "transaction_amount", "processing_time", "fraud_score")


@query
def chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the dashboard's charts draw, from the stored KPIs."""
    stored, _serving = refreshed(spark, sf_dir, "chart_series")
    return serving.chart_series(stored)


@query
def overview_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.overview_cards(sample.order_lines(spark, sf_dir))


@query
def payment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_method = totals_by_header(spark, sf_dir, "payment_method_id")
    return kpis.share(per_method, sample.payment_methods(spark, sf_dir))


@query
def latest_stored_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes at the times of the archive runs; the newest stored one with its totals."""
    out = session.work_path(spark, "latest_stored_run")
    fact, dims = sample.feed(spark, sf_dir), all_dims(spark, sf_dir)
    for run in sample.RUNS:
        refresh(fact.where(F.col("ts") < moment(run)), dims, out, run_at=datetime.fromisoformat(run))
    return newest_totals(spark, out)


def newest_refresh(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Two refreshes, three hours apart, the second over the whole feed; the newest one as it is stored."""
    out = session.work_path(spark, name)
    fact, dims = sample.feed(spark, sf_dir), all_dims(spark, sf_dir)
    last = fact.agg(serving.next_run(F.max("ts"))).first()[0]
    for run in (last - timedelta(hours=3), last):
        refresh(fact.where(F.col("ts") < moment(run)), dims, out, run_at=run)
    return serving.as_run(newest_totals(spark, out))


@query
def latest_kpi_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_refresh(spark, sf_dir, "latest_kpi_run")


@query
def run_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run as the texts on the dashboard's cards."""
    return serving.run_cards(newest_refresh(spark, sf_dir, "run_cards"))


@query
def live_count_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the hot table: what the three-hour retention keeps."""
    fact = sample.feed(spark, sf_dir)
    return retention.live_count(fact, latest(fact, back=retention.hot_span()))


@query
def live_count_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = sample.feed(spark, sf_dir)
    return retention.live_count(fact, latest(fact, back=F.make_dt_interval(secs=F.lit(60))))


# ---- streams -----------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.configure(spark)
    # A stream's path must be a folder or a pattern; this one matches the table as a file or a folder.
    events = read_feed(spark, f"{sf_dir}/events.parque[t]", sample.EVENTS)
    return sample.as_feed(events.withColumn("ts", F.col("ts").cast("timestamp")))


def ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(to_table(ntz(event_stream(spark, sf_dir)), "stream_ingest", "txn_date"))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping snapshots and the live rows as three micro-batches, newest first, each transaction kept once.

    Nearly all rows of the later batches are late, and copies come days after their originals.
    """
    root = session.work_path(spark, "stream_dedup")
    first, second, live_rows = sample.overlapping(ntz(sample.feed(spark, sf_dir)))
    for part in (live_rows, second, first):
        part.write.mode("append").parquet(f"{root}/files")
        stored = live.ingest(read_feed(spark, f"{root}/files", first.schema), root)
    return stored.select("transaction_id", "ts", "transaction_amount", "status")


@query
def stream_kpi_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All KPIs, refreshed after each of three micro-batches, the last of which is late and repeats the first."""
    session.configure(spark)
    root = session.work_path(spark, "stream_kpi_all")
    dims, feed = all_dims(spark, sf_dir), ntz(sample.feed(spark, sf_dir))
    first = F.col("ts") < moment(sample.RUNS[0])
    for part in (feed.where(first), feed.where(F.col("ts") >= moment(sample.RUNS[1])), feed.where(first | (F.col("ts") < moment(sample.RUNS[1])) | F.col("ts").isNull())):
        part.write.mode("append").parquet(f"{root}/files")
        stored = live.live_kpis(read_feed(spark, f"{root}/files", feed.schema), root, dims)
    return stored


def stored_windows(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, Windows]:
    """The windows of a stream of three micro-batches, the second newest of all and the third mostly late or repeated."""
    session.configure(spark)
    root = session.work_path(spark, name)
    table, windows = live.stream_table(spark, f"{root}/table"), Windows(spark, f"{root}/windows")
    for number, part in enumerate(sample.overlapping(sample.feed(spark, sf_dir))[::2] + (sample.feed(spark, sf_dir),)):
        live.store_batch(table, part, number)
        windows.add(number, table, live.newest_part(table))
    return table.rows(), windows


@query
def stream_windows_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions per minute, every window right however late its rows came."""
    return stored_windows(spark, sf_dir, "stream_windows_corrected")[1].tpm()


@query
def stream_fraud_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud spikes of the hours that the watermark has closed."""
    rows, windows = stored_windows(spark, sf_dir, "stream_fraud_spikes")
    return windows.fraud_spikes(latest(rows, back=F.make_dt_interval(mins=F.lit(10))))


@query
def stream_tpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_table(live.live_tpm(event_stream(spark, sf_dir)), "stream_tpm")


@query
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_table(live.live_moving_count(event_stream(spark, sf_dir)), "stream_sliding")


@query
def stream_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_table(live.live_fraud(event_stream(spark, sf_dir)), "stream_fraud")


@query
def stream_kpi_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = session.work_path(spark, "stream_kpi_segment")
    served = live.live_segments(event_stream(spark, sf_dir), sample.customers(spark, sf_dir), root)
    return serving.load_kpi(served, "customer")


@query
def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = session.work_path(spark, "stream_enriched")
    rows = live.live_enriched(ntz(event_stream(spark, sf_dir)), all_dims(spark, sf_dir), root)
    return rows.select(
        "transaction_id", "ts", "transaction_amount", "business_category", "customer_segment", "method_type", "device_type"
    )

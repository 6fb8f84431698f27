"""Command lines of the batch jobs."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .. import session
from ..model import FACT
from ..operators.quality import clean_valid, quarantine
from ..operators.retention import HOT_HOURS, archive_run
from ..sources import HotStore, Source, has_rows, load_hot, read_or_empty
from ..streaming import live
from ..streaming.run import drain, keep_running, read_feed, use_large_state
from .ledger import Ledger
from .refresh import load_dims, load_model, refresh, refresh_store, vacuum, vacuum_store


def _parser(description: str) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--store", required=True, help="root of the hot store")
    parser.add_argument("--hot", help="where the live table is, if not in the store")
    parser.add_argument("--hot-format", help="format of that table (default: parquet); stream: the table of jobs/stream.py")
    parser.add_argument("--hot-option", action="append", default=[], metavar="NAME=VALUE", help="reader option")
    parser.add_argument("--quarantine", help="take valid rows only, and write the others here")
    return parser


def _store(spark: SparkSession, args: argparse.Namespace) -> HotStore:
    """The store of a job. With a quarantine, invalid rows are out of its live table, wherever that is."""
    if args.hot is None and args.hot_format is None:
        store = HotStore(spark, args.store)
        if args.quarantine is not None:
            store.replace_live(clean_valid, quarantine, args.quarantine)
        return store
    if args.hot_format == "stream":
        live_rows = raw = live.ingested(spark, f"{args.hot.rstrip('/')}/table")
    else:
        options = dict(option.split("=", 1) for option in args.hot_option)
        source = Source(args.hot, args.hot_format or "parquet", options)
        live_rows, raw = load_hot(spark, source), read_or_empty(spark, source, FACT)
    if args.quarantine is None:
        return HotStore(spark, args.store, live_rows)
    quarantine(raw).write.mode("overwrite").parquet(args.quarantine)
    return HotStore(spark, args.store, clean_valid(raw))


def archive(argv: list[str] | None = None) -> None:
    """Move expired transactions out of the hot table."""
    parser = _parser("Archive expired transactions and trim the hot table.")
    parser.add_argument("--hours", type=int, default=HOT_HOURS, help="hours that stay hot")
    parser.add_argument("--snapshot", action="store_true", help="archive all rows, not only the expired")
    parser.add_argument("--bytes", type=int, help="size of the hot table beyond which live rows are archived, too")
    parser.add_argument("--as-of", help="UTC time to use instead of now, yyyy-mm-ddThh:mm:ss")
    args = parser.parse_args(argv)
    spark = session.build("archive")
    now = datetime.fromisoformat(args.as_of) if args.as_of else datetime.now(timezone.utc).replace(tzinfo=None)
    archive_run(_store(spark, args), now, args.hours, args.snapshot, args.bytes)


def refresh_kpis(argv: list[str] | None = None) -> None:
    """Hot and archive in, KPI tables and serving rows out."""
    parser = _parser("Refresh the KPI tables and serving rows.")
    parser.add_argument("--dims", required=True, help="folder with one table per dimension")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--full", action="store_true", help="scan the whole archive again")
    args = parser.parse_args(argv)
    spark = session.build("kpi-refresh")
    store = _store(spark, args)
    tables = load_model(store, args.dims)
    if not has_rows(tables["transactions_fact"]):
        return
    dims = load_dims(spark, args.dims)
    if args.full:
        refresh(tables["transactions_fact"], dims, args.out)
    else:
        refresh_store(store, dims, args.out)


def stream(argv: list[str] | None = None) -> None:
    """Take up new transactions at an interval, each once, and refresh all KPIs after each time."""
    parser = argparse.ArgumentParser(description="Ingest a feed of transactions and keep the KPIs fresh.")
    parser.add_argument("--feed", required=True, help="folder new files of transactions arrive in")
    parser.add_argument("--feed-format", default="json", help="format of the files (default: json)")
    parser.add_argument("--root", required=True, help="folder of the table, the archive and the stream's progress")
    parser.add_argument("--dims", required=True, help="folder with one table per dimension")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--quarantine", help="folder for rows that are not valid; without it all rows are taken")
    parser.add_argument("--windows", action="store_true", help="also keep counts, fraud spikes and latency per window")
    parser.add_argument("--every", default="3 hours", help="interval (default: 3 hours)")
    parser.add_argument("--once", action="store_true", help="take up what is there, then stop")
    args = parser.parse_args(argv)
    spark = session.build("stream")
    use_large_state(spark)
    feed = read_feed(spark, args.feed, FACT, args.feed_format)
    dims = load_dims(spark, args.dims)
    writer = feed.writeStream.foreachBatch(live.ingest_and_refresh(args.root, dims, args.out, args.quarantine, args.windows))
    if args.once:
        drain(writer, f"{args.root}/checkpoint")
    else:
        keep_running(writer, f"{args.root}/checkpoint", args.every).awaitTermination()


def maintain(argv: list[str] | None = None) -> None:
    """Merge small folders and remove those that nobody reads any more."""
    parser = argparse.ArgumentParser(description="Merge small parts and remove superseded ones, old totals and old refreshes.")
    parser.add_argument("--store", help="root of a hot store")
    parser.add_argument("--root", help="root of a stream (jobs/stream.py), while the stream is stopped")
    parser.add_argument("--out", help="folder of refreshes")
    parser.add_argument("--keep", type=int, default=10, help="newest states and refreshes that readers may still use (default: 10)")
    args = parser.parse_args(argv)
    spark = session.build("maintain")
    if args.store:
        store = HotStore(spark, args.store)
        store.compact()
        vacuum_store(store, args.keep)
    if args.root:
        table = live.stream_table(spark, f"{args.root}/table")
        table.compact()
        table.vacuum(args.keep)
        Ledger(spark, f"{args.root}/ledger").vacuum(args.keep)
    if args.out:
        vacuum(spark, args.out, args.keep)

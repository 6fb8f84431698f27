"""A stream that keeps its table and its KPIs without reading what it has read before."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paytide.operators.quality import clean_valid, quarantine
from paytide.plans import jobs
from paytide.plans import ledger as ledger_module
from paytide.plans.ledger import Ledger
from paytide.plans.one_pass import kpi_all_one_pass, reduce_fact
from paytide.operators.enrich import LABELS
from paytide.plans.refresh import published_runs, stored_kpis
from paytide.sources import HotStore, LostRows
from paytide.streaming import live
from rows import CUSTOMERS, DEVICES, MERCHANTS, METHODS, at, fact, same, txn
from test_plans import scanned_rows


@pytest.fixture()
def dims(spark):
    return {
        "merchant": spark.createDataFrame([(1, "Travel"), (2, "Gaming")], MERCHANTS),
        "customer": spark.createDataFrame([(1, "New"), (2, "Loyal"), (2, "Risky")], CUSTOMERS),
        "payment": spark.createDataFrame([(1, "Card")], METHODS),
        "device": spark.createDataFrame([(1, "phone")], DEVICES),
    }


def batch(spark, number, size=6):
    """A micro-batch over two days, with a copy of an earlier row in each but the first."""
    rows = [
        txn(number * 100 + i, customer=1 + i % 3, merchant=1 + i % 2, amount=number + i / 4, status="Fraud" if i == 2 else "Success",
            when=f"2024-01-{1 + (number + i) % 5:02d} 10:00:{i:02d}")
        for i in range(size)
    ]
    return rows + ([txn(0, customer=1, merchant=1, amount=0.0, when="2024-01-01 10:00:00")] if number else [])


def test_every_refresh_equals_the_batch_kpis(spark, tmp_path, dims, monkeypatch):
    monkeypatch.setattr(ledger_module, "FAN_IN", 3)
    monkeypatch.setattr(live, "KEPT_STATES", 4)
    root, out = str(tmp_path / "live"), str(tmp_path / "out")
    write, every = live.ingest_and_refresh(root, dims, out), None
    for number in range(5):
        rows = fact(spark, batch(spark, number))
        every = rows if every is None else every.unionAll(rows)
        write(rows, number)
        if number in (0, 2, 4):
            same(stored_kpis(spark, out), kpi_all_one_pass(every.dropDuplicates(["transaction_id"]), dims))
    write(fact(spark, batch(spark, 4)), 4)
    same(stored_kpis(spark, out), kpi_all_one_pass(every.dropDuplicates(["transaction_id"]), dims))
    state = Ledger(spark, f"{root}/ledger").state()
    assert state["upto"] == 4 and sorted(level for _, level in state["entries"]) == [0, 0, 1]
    assert len(live.stream_table(spark, f"{root}/table").parts()) < 8
    assert published_runs(spark, out).count() == 6 and len(list(Path(out).glob("run=*"))) == 4


def test_a_micro_batch_reads_its_own_rows_and_the_ledger(spark, tmp_path, dims, monkeypatch):
    root, out = str(tmp_path / "live"), str(tmp_path / "out")
    seen = []

    def reduced(rows, kpis):
        seen.append(scanned_rows(rows))
        return reduce_fact(rows, kpis)

    monkeypatch.setattr(live, "reduce_fact", reduced)
    write = live.ingest_and_refresh(root, dims, out)
    for number in range(4):
        write(fact(spark, batch(spark, number, 3 + number)), number)
    assert seen == [3, 4, 5, 6]
    ledger = Ledger(spark, f"{root}/ledger")
    before = scanned_rows(ledger.totals())
    # Keys, not transactions, and the same number however many transactions a key has.
    write(fact(spark, batch(spark, 9, 500)), 4)
    assert seen[-1] == 500 and scanned_rows(ledger.totals()) - before < 60


def test_a_batch_that_died_between_its_commits_is_entered_once(spark, tmp_path, dims, monkeypatch):
    root, out = str(tmp_path / "live"), str(tmp_path / "out")
    write = live.ingest_and_refresh(root, dims, out)
    write(fact(spark, batch(spark, 0)), 0)
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "add", lambda *_: (_ for _ in ()).throw(RuntimeError("dead")))
        with pytest.raises(RuntimeError):
            write(fact(spark, batch(spark, 1)), 1)
    for _ in range(2):
        write(fact(spark, batch(spark, 1)), 1)
    every = fact(spark, batch(spark, 0) + batch(spark, 1)).dropDuplicates(["transaction_id"])
    same(stored_kpis(spark, out), kpi_all_one_pass(every, dims))


def test_a_ledger_younger_than_its_stream_starts_with_everything(spark, tmp_path, dims):
    root, out = str(tmp_path / "live"), str(tmp_path / "out")
    add = live.ingest_writer(f"{root}/table")
    for number in range(3):
        add(fact(spark, batch(spark, number)), number)
    live.ingest_and_refresh(root, dims, out)(fact(spark, batch(spark, 3)), 3)
    every = fact(spark, sum((batch(spark, n) for n in range(4)), [])).dropDuplicates(["transaction_id"])
    same(stored_kpis(spark, out), kpi_all_one_pass(every, dims))


def test_many_micro_batches_leave_few_files(spark, tmp_path):
    root, every = str(tmp_path / "table"), []
    write = live.ingest_writer(root)
    for number in range(10):
        rows = [txn(number, when="2024-01-01 10:00:00")]
        every += rows
        write(fact(spark, rows), number)
    table = live.stream_table(spark, root)
    assert len(table.parts()) == 1 + 2 and len(list(Path(root, "parts").iterdir())) <= 11
    same(live.ingested(spark, root), fact(spark, every).select(*live.STORED_FACT.names))
    table.verify()


def test_an_empty_micro_batch(spark, tmp_path, dims):
    write = live.ingest_and_refresh(str(tmp_path / "live"), dims, str(tmp_path / "out"))
    write(fact(spark, []), 0)
    write(fact(spark, batch(spark, 1)), 1)
    write(fact(spark, []), 2)
    same(stored_kpis(spark, str(tmp_path / "out")), kpi_all_one_pass(fact(spark, batch(spark, 1)), dims))


def test_totals_of_a_part_are_those_of_its_rows(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    rows = fact(spark, batch(spark, 1))
    for number in range(9):
        ledger.add(number, lambda: reduce_fact(rows, LABELS), lambda: reduce_fact(rows, LABELS))
    got = {(r.kpi, r.key): (r.n, r.units, r.n_fraud) for r in ledger.totals().collect()}
    want = {(r.kpi, r.key): (9 * r.n, 9 * r.units, 9 * r.n_fraud) for r in reduce_fact(rows, LABELS).collect()}
    assert got == want and len(ledger.vacuum()) > 0 and got == {(r.kpi, r.key): (r.n, r.units, r.n_fraud) for r in ledger.totals().collect()}


# ---- jobs ------------------------------------------------------------------------------------

MIXED = [txn(1), txn(2, when="2024-01-01 01:00:00"), txn(3, status="Pending"), txn(4, when="junk"), txn(5, customer=None)]


def test_quarantine_of_the_stores_own_table(spark, tmp_path):
    store, bad = HotStore(spark, str(tmp_path / "store")), str(tmp_path / "bad")
    store.ingest(fact(spark, MIXED))
    args = ["--store", store.root, "--as-of", "2024-01-01T12:00:00", "--quarantine", bad]
    jobs.archive(args)
    assert [r.transaction_id for r in store.current().collect()] == ["t1"] and store.archive().count() == 1
    left_out = spark.read.option("recursiveFileLookup", "true").parquet(bad)
    assert sorted((r.transaction_id, r.reasons) for r in left_out.collect()) == [
        ("t3", "unknown_status"), ("t4", "bad_timestamp"), ("t5", "null_key")
    ]
    assert store.replace_live(clean_valid, quarantine, bad) == 0


def test_a_split_that_loses_rows_is_refused(spark, tmp_path):
    store = HotStore(spark, str(tmp_path / "store"))
    store.ingest(fact(spark, MIXED))
    with pytest.raises(LostRows):
        store.replace_live(lambda df: clean_valid(df).limit(1), quarantine, str(tmp_path / "bad"))
    assert store.current().count() == 5


def test_archive_over_the_table_of_a_stream_and_maintenance(spark, tmp_path):
    root, store = str(tmp_path / "live"), HotStore(spark, str(tmp_path / "store"))
    add = live.ingest_writer(f"{root}/table")
    for number in range(9):
        add(fact(spark, [txn(number, when=f"2024-01-01 0{number}:00:00")]), number)
    jobs.archive(["--store", store.root, "--hot", root, "--hot-format", "stream", "--as-of", "2024-01-01T08:00:00"])
    assert store.archive().count() == 5
    live_rows = HotStore(spark, store.root, live.ingested(spark, f"{root}/table")).current()
    assert live_rows.agg(F.min("ts")).first()[0] == at("2024-01-01 05:00:00") and live_rows.count() == 4
    jobs.maintain(["--store", store.root, "--root", root, "--out", str(tmp_path / "out"), "--keep", "1"])
    table = live.stream_table(spark, f"{root}/table")
    assert len(list(Path(root, "table", "parts").iterdir())) == len(table.parts()) and table.rows().count() == 9

"""The incremental refresh against a full one."""

import shutil
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from paytide.operators import retention
from paytide.plans import refresh as job
from paytide.plans.one_pass import kpi_all_one_pass
from paytide.sources import HotStore
from rows import CUSTOMERS, DEVICES, MERCHANTS, METHODS, at, fact, same, txn

NOW = at("2024-01-01 12:00:00")


@pytest.fixture()
def dims(spark):
    return {
        "merchant": spark.createDataFrame([(1, "Travel"), (2, "Gaming"), (2, "Fashion")], MERCHANTS),
        "customer": spark.createDataFrame([(1, "New"), (2, "Loyal")], CUSTOMERS),
        "payment": spark.createDataFrame([(1, "Card")], METHODS),
        "device": spark.createDataFrame([(1, None)], DEVICES),
    }


def some(start, hours):
    return [
        txn(
            start + i, customer=(1, 2, None, 9)[i % 4], merchant=1 + i % 3, method=1 + i % 2, device=None if i % 5 == 0 else 1,
            when=None if i % 7 == 0 else f"2024-01-{1 + h // 24:02d} {h % 24:02d}:15:00",
            amount=None if i % 11 == 0 else i + 0.25, status="Fraud" if i % 3 == 0 else "Success",
        )
        for i, h in enumerate(hours)
    ]


@pytest.mark.parametrize("snapshot", [False, True])
def test_incremental_equals_full_after_every_run(spark, tmp_path, dims, snapshot):
    store = HotStore(spark, str(tmp_path / "store"))
    every = None
    for turn in range(4):
        rows = fact(spark, some(turn * 100, range(turn * 8, turn * 8 + 12)))
        every = rows if every is None else every.unionAll(rows)
        store.ingest(rows)
        stored, _serving = job.refresh_store(store, dims, str(tmp_path / "out"))
        same(stored, kpi_all_one_pass(every, dims))
        retention.archive_run(store, NOW + timedelta(hours=8 * turn), snapshot=snapshot)
        stored, _serving = job.refresh_store(store, dims, str(tmp_path / "out"))
        same(stored, kpi_all_one_pass(every, dims))
    same(kpi_all_one_pass(retention.archived_once(store), dims), kpi_all_one_pass(every, dims))


def test_a_refresh_reads_only_new_batches(spark, tmp_path, dims, monkeypatch):
    store = HotStore(spark, str(tmp_path / "store"))
    seen = []
    real = job.archived_rows

    def spy(store, runs):
        seen.append(sorted(r.batch_id for r in runs.collect()))
        return real(store, runs)

    monkeypatch.setattr(job, "archived_rows", spy)
    for turn in range(3):
        store.ingest(fact(spark, some(turn * 100, range(turn * 8, turn * 8 + 12))))
        retention.archive_run(store, NOW + timedelta(hours=8 * turn))
        job.refresh_store(store, dims, str(tmp_path / "out"))
        job.refresh_store(store, dims, str(tmp_path / "out"))
    ids = sorted(r.batch_id for r in store.runs().collect())
    assert seen == [[b] for b in ids]


def test_only_folders_of_the_wanted_runs_are_read(spark, tmp_path):
    from test_plans import scanned_rows

    store = HotStore(spark, str(tmp_path / "store"))
    for turn in range(3):
        store.ingest(fact(spark, [txn(turn * 100 + i, when=f"2024-01-0{1 + turn} 01:00:00") for i in range(50)]))
        retention.archive_run(store, NOW + timedelta(days=turn))
    last = store.runs().where(F.col("generation") == 3)
    assert scanned_rows(retention.archived_rows(store, last)) <= 50 + 3


def test_a_refresh_that_dies_before_its_log_row_can_be_repeated(spark, tmp_path, dims):
    store = HotStore(spark, str(tmp_path / "store"))
    rows = fact(spark, some(0, range(12)))
    store.ingest(rows)
    retention.archive_run(store, NOW)
    # Totals of a dead refresh: written, not logged, and wrong.
    wrong = spark.createDataFrame([("daily", 1, *[99] * (len(job.TOTALS) - 2))], job.TOTALS)
    wrong.write.parquet(f"{store.root}/totals/generation=1")
    stored, _serving = job.refresh_store(store, dims, str(tmp_path / "out"))
    same(stored, kpi_all_one_pass(rows, dims))


def test_a_changed_label_moves_the_past(spark, tmp_path, dims):
    store = HotStore(spark, str(tmp_path / "store"))
    store.ingest(fact(spark, [txn(1, amount=2.0)]))
    retention.archive_run(store, NOW + timedelta(days=9))
    job.refresh_store(store, dims, str(tmp_path / "out"))
    dims["customer"] = spark.createDataFrame([(1, "Risky")], CUSTOMERS)
    stored, _serving = job.refresh_store(store, dims, str(tmp_path / "out"))
    assert [r.dim_value for r in stored.where("kpi = 'customer'").collect()] == ["Risky"]


def test_lost_state_raises(spark, tmp_path):
    store = HotStore(spark, str(tmp_path / "store"))
    store.ingest(fact(spark, [txn(1), txn(2, when="2024-01-01 01:00:00")]))
    retention.archive_run(store, at("2024-01-01 14:00:00"))
    assert job.archived_totals(store, 1).count() > 0
    shutil.rmtree(tmp_path / "store" / "totals" / "generation=1")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.archived_totals(store, 1).count()

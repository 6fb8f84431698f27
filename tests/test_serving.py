import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paytide.model import DIMENSIONS, KPI_TABLES, SERVING, schema
from paytide.functions.clock import parse_day
from paytide.operators import retention, serving
from paytide.plans import jobs, one_pass
from paytide.plans.refresh import latest_run, load_model, load_dims, newest_totals, published_runs, refresh, stored_kpis, stored_serving, vacuum, vacuum_store
from paytide.sources import HotStore, Source, sample
from rows import CUSTOMERS, MERCHANTS, METHODS, at, fact, raw, same, txn

SF = "/root/testdata/sf0.001"
LONG = "kpi STRING, dim_value STRING, transactions BIGINT, total DOUBLE, average DOUBLE"


def payloads(df):
    return {r.key: json.loads(r.payload) for r in df.collect()}


def test_json_keeps_nulls_iso_days_and_order(spark):
    kpis = spark.createDataFrame(
        [
            ("daily", "2024-01-02", 1, 5.0, 5.0), ("daily", None, 2, None, None), ("daily", "2024-01-01", 3, 1.5, 0.5),
            ("merchant", "Gaming", 1, 5.0, 5.0), ("merchant", "Travel", 1, 90000000.25, 7.0), ("merchant", None, 1, None, None),
            ("device", "Mobile", 1, 1.0, 1.0),
        ],
        LONG,
    )
    assert payloads(serving.serving_rows(kpis)) == {
        "kpi:daily": [
            {"txn_date": None, "transactions": 2, "total_volume": None, "avg_value": None},
            {"txn_date": "2024-01-01", "transactions": 3, "total_volume": 1.5, "avg_value": 0.5},
            {"txn_date": "2024-01-02", "transactions": 1, "total_volume": 5.0, "avg_value": 5.0},
        ],
        "kpi:merchant": [
            {"business_category": "Travel", "transactions": 1, "total_revenue": 90000000.25, "avg_ticket_size": 7.0},
            {"business_category": "Gaming", "transactions": 1, "total_revenue": 5.0, "avg_ticket_size": 5.0},
            {"business_category": None, "transactions": 1, "total_revenue": None, "avg_ticket_size": None},
        ],
    }


@pytest.mark.parametrize("payload", ["oops", "", None, "{}", "[]", "[oops"])
def test_broken_or_missing_payload_gives_no_rows(spark, payload):
    cache = spark.createDataFrame([("kpi:daily", payload)], SERVING)
    assert serving.load_kpi(cache, "daily").count() == 0
    assert serving.load_kpi(cache, "merchant").count() == 0


def test_what_is_served_equals_the_kpis(spark, tmp_path):
    lines, header = sample.order_lines(spark, SF), (sample.order_headers(spark, SF), "order_id")
    dims = {
        "merchant": sample.merchants(spark, SF),
        "customer": sample.customers(spark, SF),
        "payment": sample.payment_methods(spark, SF),
    }
    stored, rows = refresh(lines, dims, str(tmp_path), header)
    same(stored, one_pass.kpi_all_one_pass(lines, dims, header))
    served = payloads(rows)
    assert set(served) == {key for _table, key, *_rest in KPI_TABLES.values()}
    for kpi, (table, key, *_rest) in KPI_TABLES.items():
        result = spark.read.parquet(f"{latest_run(spark, str(tmp_path))}/{table}")
        same(result, serving.load_kpi(rows, kpi))
        assert [d[KPI_TABLES[kpi][3]] for d in served[key]] == [r[KPI_TABLES[kpi][3]] for r in result.collect()]


def test_kpi_table_with_text_days(spark, tmp_path):
    Source(str(tmp_path / "t")).write(spark.createDataFrame([("2024-01-02", 1)], "txn_date STRING, transactions BIGINT"))
    table = serving.load_kpi_table(spark, Source(str(tmp_path / "t")), schema("txn_date STRING, transactions BIGINT"))
    assert table.dtypes[0] == ("txn_date", "date") and str(table.first().txn_date) == "2024-01-02"


def test_run_history_ends_with_the_whole(spark):
    facts = fact(spark, [txn(1, amount=1.0, when="2024-01-01 00:10:00"), txn(2, amount=3.0, when="2024-01-01 07:00:00")])
    history = serving.kpi_run_history(facts)
    assert [r.total_volume for r in history.orderBy("run_ts").collect()] == [1.0, 4.0]
    last = serving.latest_kpi_run(history).first()
    assert (str(last.run_ts), last.total_transactions, last.avg_transaction_value) == ("2024-01-01 09:00:00", 2, 2.0)


@pytest.fixture()
def dims_root(spark, tmp_path):
    literal = {
        "customers_dim": spark.createDataFrame([(1, "New")], CUSTOMERS),
        "merchants_dim": spark.createDataFrame([(1, "Travel")], MERCHANTS),
        "payment_methods_dim": spark.createDataFrame([(1, "Card")], METHODS),
    }
    for name, (columns, _key) in DIMENSIONS.items():
        rows = literal.get(name, spark.createDataFrame([], columns))
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in columns if f.name not in rows.columns]
        Source(str(tmp_path / "dims" / name)).write(rows.select("*", *missing).select(*columns.names))
    return str(tmp_path / "dims")


TWO = [txn(1, amount=5.0), txn(2, amount=7.0, when="2024-01-01 01:00:00")]


@pytest.mark.parametrize("full", [[], ["--full"]])
def test_jobs_from_the_command_line(spark, tmp_path, dims_root, full):
    store = HotStore(spark, str(tmp_path / "store"))
    store.ingest(fact(spark, TWO))
    jobs.archive(["--store", store.root, "--as-of", "2024-01-01T12:00:00"])
    assert store.current().count() == 1 and store.archive().count() == 1
    jobs.refresh_kpis(["--store", store.root, "--dims", dims_root, "--out", str(tmp_path / "out"), *full])
    rows = stored_serving(spark, str(tmp_path / "out"))
    assert serving.load_kpi(rows, "customer").first().total_spend == 12.0


def test_jobs_over_a_live_table_in_another_format(spark, tmp_path, dims_root):
    raw(spark, TWO).write.json(str(tmp_path / "live"))
    hot = ["--store", str(tmp_path / "store"), "--hot", str(tmp_path / "live"), "--hot-format", "json"]
    refresh_args = [*hot, "--dims", dims_root, "--out", str(tmp_path / "out")]
    for step in (lambda: None, lambda: jobs.archive([*hot, "--as-of", "2024-01-01T12:00:00"])):
        step()
        jobs.refresh_kpis(refresh_args)
        rows = stored_serving(spark, str(tmp_path / "out"))
        assert serving.load_kpi(rows, "global").first()[:] == (2, 12.0, 6.0)
        assert [str(r.txn_date) for r in serving.load_kpi(rows, "daily").collect()] == ["2024-01-01"]


def test_stored_runs(spark, tmp_path, dims_root):
    store = HotStore(spark, str(tmp_path / "store"))
    out = str(tmp_path / "out")
    store.ingest(fact(spark, TWO))
    dims = load_dims(spark, dims_root)
    with pytest.raises(FileNotFoundError):
        latest_run(spark, out)
    refresh(store.current(), dims, out, run_at=at("2024-01-01 12:00:00"))
    store.ingest(fact(spark, [txn(3, amount=1.0)]))
    refresh(store.current(), dims, out, run_at=at("2024-01-01 15:00:00"))
    assert newest_totals(spark, out).first()[:] == (2, at("2024-01-01 15:00:00"), 3, 13.0, 13.0 / 3)
    # A run that died before its log row is not seen, and its folder is used again.
    spark.range(1).write.parquet(f"{out}/run=3/kpis")
    assert stored_kpis(spark, out).where("kpi = 'global'").first().transactions == 3
    assert vacuum(spark, out) == [f"{out}/run=1"] and vacuum(spark, out) == []
    refresh(store.current(), dims, out)
    assert published_runs(spark, out).count() == 3 and stored_kpis(spark, out).where("kpi = 'global'").first().transactions == 3


def test_vacuum_keeps_what_the_manifest_names(spark, tmp_path):
    store = HotStore(spark, str(tmp_path / "store"))
    rows = fact(spark, TWO)
    store.ingest(rows)
    retention.archive_run(store, at("2024-01-01 12:00:00"))
    before = retention.archived_once(store).count()
    assert vacuum_store(store) == [store.generation_path(0)]
    assert retention.archived_once(store).count() == before == 2


def test_the_stream_job_from_another_folder(spark, tmp_path, dims_root):
    """Started as a user does, in a process of its own: no PYTHONPATH, another working directory."""
    broken = raw(spark, [*TWO, txn(3, status="Pending"), txn(4, when="junk")])
    broken.unionByName(raw(spark, TWO)).write.json(str(tmp_path / "feed"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    job = Path(__file__).resolve().parent.parent / "jobs" / "stream.py"
    args = ["--feed", "feed", "--root", "root", "--dims", dims_root, "--out", "out", "--quarantine", "bad", "--once"]
    subprocess.run([sys.executable, str(job), *args], cwd=tmp_path, env=env, check=True, timeout=300, capture_output=True)
    served = stored_serving(spark, str(tmp_path / "out"))
    assert serving.load_kpi(served, "global").first()[:] == (2, 12.0, 6.0)
    assert sorted(r.transaction_id for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["t3", "t4"]


def test_a_refresh_of_nothing_writes_nothing(spark, tmp_path, dims_root):
    jobs.refresh_kpis(["--store", str(tmp_path / "none"), "--dims", dims_root, "--out", str(tmp_path / "out")])
    assert not (tmp_path / "out").exists()


def test_plain_sql_over_the_model(spark, tmp_path, dims_root):
    store = HotStore(spark, str(tmp_path / "store"))
    store.ingest(fact(spark, TWO))
    retention.archive_run(store, at("2024-01-01 12:00:00"))
    load_model(store, dims_root)
    by_sql = spark.sql(
        """SELECT customer_segment, max(transaction_amount) largest, count_if(hour(ts) < 6) early
           FROM customers_dim INNER JOIN transactions_fact USING (customer_id) WHERE status = 'Success' GROUP BY ALL"""
    )
    assert [tuple(r) for r in by_sql.collect()] == [("New", 7.0, 1)]


def test_days_parse_or_are_null(spark):
    days = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("x",), (None,)], "t STRING")
    assert [str(r[0]) for r in days.select(parse_day("t")).collect()] == ["2024-02-29", "None", "None", "None"]

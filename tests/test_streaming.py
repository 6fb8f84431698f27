import pytest
from pyspark.sql import functions as F

from paytide.functions.clock import moment
from paytide.model import STORED_FACT
from paytide.operators import kpis
from paytide.operators.serving import load_kpi
from paytide.streaming import live
from paytide.streaming.run import drain, keep_running, read_feed, to_table
from rows import CUSTOMERS, at, fact, same, txn


class Feed:
    """A folder that gets one file per call, and the stream over it."""

    def __init__(self, spark, path):
        self.spark, self.path, self.all = spark, str(path / "feed"), None

    def add(self, rows):
        batch = fact(self.spark, rows).select(*STORED_FACT.names)
        batch.coalesce(1).write.mode("append").parquet(self.path)
        self.all = batch if self.all is None else self.all.unionAll(batch)

    def stream(self):
        raw = read_feed(self.spark, self.path, STORED_FACT, maxFilesPerTrigger="1")
        return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture()
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def minutes(*when, start=0):
    return [txn(start + i, when=f"2024-01-01 {w}") for i, w in enumerate(when)]


def drained(writer_of, tmp_path, spark, schema):
    """Drain into a fixed table, so that a later call continues where this one stopped."""
    writer = writer_of.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
    drain(writer, str(tmp_path / "checkpoint"))
    return spark.read.schema(schema).parquet(str(tmp_path / "out"))


def test_minutes_close_when_the_watermark_passes(spark, feed, tmp_path):
    feed.add(minutes("10:00:05", "10:00:50", "10:01:00"))
    tpm = live.live_tpm(feed.stream())
    assert drained(tpm, tmp_path, spark, tpm.schema).count() == 0
    feed.add(minutes("10:11:30", start=10))
    out = drained(live.live_tpm(feed.stream()), tmp_path, spark, tpm.schema)
    assert [(r.window_start, r.transactions) for r in out.collect()] == [(at("2024-01-01 10:00:00"), 2)]


def test_rows_behind_the_watermark_are_left_to_the_batch(spark, feed, tmp_path):
    feed.add(minutes("10:00:05", "10:30:00"))
    tpm = live.live_tpm(feed.stream())
    drained(tpm, tmp_path, spark, tpm.schema)
    feed.add(minutes("10:00:30", "10:25:00", start=10))  # too late, and late but in time
    feed.add(minutes("11:30:00", start=20))
    out = drained(live.live_tpm(feed.stream()), tmp_path, spark, tpm.schema)
    got = {str(r.window_start)[11:16]: r.transactions for r in out.collect()}
    assert got == {"10:00": 1, "10:25": 1, "10:30": 1}
    assert feed.all.where("minute(ts) = 0 AND hour(ts) = 10").count() == 2


def test_sliding_windows_see_each_transaction_six_times(spark, feed, tmp_path):
    feed.add(minutes("10:00:05", "11:00:00"))
    count = live.live_moving_count(feed.stream())
    out = drained(count, tmp_path, spark, count.schema)
    assert out.agg(F.sum("transactions")).first()[0] == 6
    assert out.agg(F.min("window_start"), F.max("window_end")).first()[:] == (at("2024-01-01 09:59:10"), at("2024-01-01 10:01:00"))


def test_live_fraud(spark, feed, tmp_path):
    feed.add([
        txn(1, took=100.0, status="Fraud"), txn(2, took=None), txn(3, took=200.0), txn(4, took=3.0),
        txn(9, when="2024-01-01 12:00:00"),
    ])
    fraud = live.live_fraud(feed.stream())
    row = drained(fraud, tmp_path, spark, fraud.schema).first()
    assert (row.transactions, row.fraud_transactions, row.fraud_rate_pct, row.avg_latency) == (4, 1, 25.0, 101.0)


def test_restarted_stream_appends_each_row_once(spark, feed, tmp_path):
    feed.add(minutes("10:00:00", "10:00:01"))
    drained(feed.stream(), tmp_path, spark, STORED_FACT)
    feed.add(minutes("10:00:02", start=5))
    out = drained(feed.stream().withColumn("ts", F.col("ts").cast("timestamp")), tmp_path, spark, feed.stream().schema)
    assert sorted(r.transaction_id for r in out.collect()) == ["t0", "t1", "t5"]


def test_each_transaction_is_stored_once_however_late(spark, feed, tmp_path):
    feed.add(minutes("10:00:00", "10:10:00") + [txn(0, when="2024-01-01 10:00:00")] * 500 + [txn(7, customer=None)] * 3)
    live.ingest(feed.stream(), str(tmp_path / "in"))
    nameless = [(None, *txn(0, amount=float(n))[1:]) for n in (1, 2, 2)]
    late = [txn(90, when="2024-01-01 00:00:01"), txn(91, when=None)]
    feed.add(minutes("10:00:00", "10:10:00") + minutes("10:20:00", start=50) + nameless + late)
    live.ingest(feed.stream(), str(tmp_path / "in"))
    feed.add(nameless + late)
    stored = live.ingest(feed.stream(), str(tmp_path / "in"))
    got = [tuple(r) for r in stored.select(*feed.all.columns).collect()]
    want = feed.all.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert sorted(map(str, got)) == sorted(set(map(str, map(tuple, want.collect()))))
    assert live.late_rows(stored, moment("2024-01-01 09:00:00")).first()[0] == 1


def test_repeating_an_ingested_batch_replaces_it(spark, feed, tmp_path):
    feed.add(minutes("10:00:00", "10:10:00"))
    root = str(tmp_path / "table")
    write = live.ingest_writer(root)
    for number in (0, 1, 1, 0):
        write(feed.all, number)
    assert live.ingested(spark, root).count() == 2


def test_missing_totals_raise(spark, tmp_path):
    assert live.segments_until(spark, str(tmp_path), -1).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        live.segments_until(spark, str(tmp_path), 0).count()


CUSTOMER_ROWS = [(1, "New"), (2, "Loyal"), (2, "Risky")]


def test_live_segments_follow_the_batch_kpi(spark, feed, tmp_path):
    customers = spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS)
    for start in (0, 10, 20):
        feed.add([txn(start, amount=1.5), txn(start + 1, customer=2, amount=None), txn(start + 2, customer=99)])
        served = live.live_segments(feed.stream(), customers, str(tmp_path / "live"))
        same(load_kpi(served, "customer"), kpis.kpi_by_customer_segment(feed.all, customers))


def test_enriched_feed_equals_the_batch_join(spark, feed, tmp_path):
    customers = spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS)
    feed.add([txn(1), txn(2, customer=2), txn(3, customer=None)])
    live.live_enriched(feed.stream(), {"customer": customers}, str(tmp_path / "live"))
    feed.add([txn(4, customer=77)])
    got = live.live_enriched(feed.stream(), {"customer": customers}, str(tmp_path / "live"))
    assert sorted((r.transaction_id, str(r.customer_segment)) for r in got.collect()) == [
        ("t1", "New"), ("t2", "Loyal"), ("t2", "Risky"), ("t3", "None"), ("t4", "None")
    ]


def test_repeating_a_micro_batch_counts_nothing_twice(spark, tmp_path):
    customers = spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS)
    first, second = fact(spark, [txn(1)]), fact(spark, [txn(2), txn(3, customer=2)])
    write = live.segment_writer(customers, str(tmp_path))
    for batch, number in ((first, 0), (first, 0), (second, 1), (second, 1)):
        write(batch, number)
    got = {r.customer_segment: r.n for r in live.segments_until(spark, str(tmp_path), 1).collect()}
    assert got == {"New": 2, "Loyal": 1, "Risky": 1}


def test_a_running_stream_takes_up_new_files(spark, feed, tmp_path):
    feed.add(minutes("10:00:00"))
    writer = feed.stream().writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
    query = keep_running(writer, str(tmp_path / "checkpoint"), "200 milliseconds")
    try:
        query.processAllAvailable()
        feed.add(minutes("10:00:01", start=3))
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_a_failing_stream_raises(spark, feed, tmp_path):
    feed.add(minutes("10:00:00"))

    def fail(_batch, _number):
        raise ValueError("broken sink")

    with pytest.raises(Exception, match="broken sink"):
        drain(feed.stream().writeStream.foreachBatch(fail), str(tmp_path / "checkpoint"))


@pytest.mark.parametrize("live_op, length, step", [(live.live_tpm, 60, 60), (live.live_moving_count, 60, 10)])
def test_windows_over_many_batches_equal_the_batch_result(spark, feed, tmp_path, live_op, length, step):
    import random

    rng = random.Random(step)
    schema, now = live_op(read_feed(spark, str(tmp_path), STORED_FACT).withColumn("ts", F.col("ts").cast("timestamp"))).schema, 0
    for turn in range(4):
        seconds = [now + rng.randrange(900) for _ in range(60)]
        now += 500  # batches overlap in time, within the lateness
        feed.add([txn(turn * 100 + i, when=f"2024-01-01 {10 + s // 3600}:{s // 60 % 60:02d}:{s % 60:02d}") for i, s in enumerate(seconds)])
        out = drained(live_op(feed.stream()), tmp_path, spark, schema)
    moments = [r.s for r in feed.all.select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("s")).collect()]
    closed = max(moments) - 600
    want = {}
    for s in moments:
        start = s - s % step
        while start > s - length:
            if start + length <= closed:
                want[start] = want.get(start, 0) + 1
            start -= step
    got = out.select(F.unix_seconds(F.col("window_start").cast("timestamp")).alias("s"), "transactions").collect()
    assert sorted((r.s, r.transactions) for r in got) == sorted(want.items())

import time
from glob import glob
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import functions as F

from paytide.llm import tables


def test_long_rows_are_held_a_few_at_a_time(spark):
    sizes = []

    def rows_of(rows):
        for doc_id, text in rows:
            yield doc_id, text + "!"

    long = spark.range(200, numPartitions=1).select("id", F.repeat(F.lit("x"), 2_000_000).alias("text"))
    out = tables.map_rows(long, rows_of, "doc_id long, text string")
    sizes = out.select(F.length("text")).distinct().collect()
    assert out.count() == 200 and [r[0] for r in sizes] == [2_000_001]


def test_slices_follow_the_size_of_rows():
    long = pa.record_batch([pa.array(["x" * (3 << 20)] * 7 + ["y"])], names=["t"])
    assert [s.num_rows for s in tables.slices(long)] == [3, 3, 2]
    assert [s.num_rows for s in tables.slices(pa.record_batch([pa.array(range(600))], names=["t"]))] == [256, 256, 88]
    assert list(tables.slices(pa.record_batch([pa.array([], pa.string())], names=["t"]))) == []


def test_packed_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(tables, "HELD_BYTES", 100)
    assert [tables.bytes_of(v) for v in ("abc", b"abcd", [1, 2], None, 5)] == [3, 4, 64, 0, 0]
    assert tables.map_rows(spark.range(50), lambda rows: ((i, "x" * i) for i, in rows), "n long, t string").where("length(t) = n").count() == 50


def test_map_text_keeps_rows_and_order_of_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 3), (3, "", 4)], "id long, text string, other int")
    out = df.withColumn("text", tables.map_text(df, "text", lambda t: None if t is None else t + "é"))
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "aé", None), (2, None, 3), (3, "é", 4)]
    none = df.limit(0)
    assert none.withColumn("text", tables.map_text(none, "text", str)).count() == 0


def test_a_filter_calls_it_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(text):
        calls.add(1)
        return text

    df = spark.createDataFrame([("a",), ("b",)], "text string")
    df = df.withColumn("new", tables.map_text(df, "text", count))
    assert df.where("new <> 'c'").select("new").count() == 2 and calls.value == 2


def test_batches_to_python_end_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    long = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    tables.map_rows(long, lambda rows: rows, "text string")
    found = [r["n"] for r in long.mapInArrow(sizes, "n long").collect()]
    assert len(found) > 5 and max(found) <= 3 << 20


def test_shuffle_files_of_a_stored_table_go_at_once(spark):
    """Without waiting for the driver to collect its garbage, which may come after the next table's shuffle."""
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for place in places for f in glob(f"{place}/**/shuffle_*", recursive=True)}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    asked = spark.conf.get(setting, None)
    df = spark.range(20_000).groupBy(F.xxhash64("id").alias("k")).count()
    no_gc = SimpleNamespace(System=SimpleNamespace(gc=lambda: None))
    session = SimpleNamespace(conf=spark.conf, read=spark.read, sparkContext=spark.sparkContext, _jvm=no_gc)
    before = files()
    out = tables.written(SimpleNamespace(sparkSession=session, write=df.write, schema=df.schema), "grouped")
    until = time.monotonic() + 10
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 20_000
    assert spark.conf.get(setting, None) == asked

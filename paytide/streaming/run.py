"""Starting streams and waiting for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from .. import session

TIMEOUT = 24 * 3600


def read_feed(
    spark: SparkSession, path: str | None, schema: StructType, format: str = "parquet", **options: str
) -> DataFrame:
    """An unbounded source: a folder files arrive in, or any format Spark can stream from."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def drain(writer: DataStreamWriter, checkpoint: str, timeout: int = TIMEOUT) -> None:
    """Process all that is available, then stop. A stream that fails or hangs raises."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(timeout):
            raise TimeoutError(f"stream {query.id} did not finish in {timeout} s")
    finally:
        query.stop()


def keep_running(writer: DataStreamWriter, checkpoint: str, every: str) -> StreamingQuery:
    """Start a stream that takes up new data at an interval, such as ``3 hours``, until stopped."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def use_large_state(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, beyond the heap, unless the session chose a store itself."""
    if spark.conf.get(session.STATE_STORE, "").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(session.STATE_STORE, session.ROCKSDB)


def to_table(stream: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Drain a stream into a Parquet table in append mode and return the table."""
    spark = stream.sparkSession
    use_large_state(spark)
    root = session.work_path(spark, name)
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", f"{root}/table")
    if partitions:
        writer = writer.partitionBy(*partitions)
    drain(writer, f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/table")

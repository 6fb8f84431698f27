"""Reading the corpus tables, and the one way Python code meets Spark rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import work_path


SENT_IDS = 1_000_000
# Rows and bytes that a worker turns into Python objects, or holds as such, at a time.
SLICE = 256
HELD_BYTES = 8 << 20
# Bytes of a batch from Spark to Python. Larger ones come and go outside the heap, where the allocator keeps their room.
SENT_BYTES = 2 << 20
DROP_SHUFFLED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Store an intermediate table in the shared folder and read it back: lineage ends there.

    What was shuffled for it is of no use any more, and Spark is told to remove it at the end of the write. Files of
    other actions, and those that a Spark before 4.1 leaves, go when the driver's objects for them are collected, which
    may take half an hour while the disks fill, so that is asked for.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLED, None)
    spark.conf.set(DROP_SHUFFLED, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLED)
        else:
            spark.conf.set(DROP_SHUFFLED, before)
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop_ids(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``ids`` (one column); rows with a null key stay.

    Up to SENT_IDS ids (16 bytes each) are sent to every task, so the rows need no shuffle.
    """
    ids = written(ids.toDF(key).distinct(), "dropped")
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_anti").select(*df.columns)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of SLICE rows, fewer where rows are long: HELD_BYTES at a time, or one row."""
    step = max(1, min(SLICE, HELD_BYTES * batch.num_rows // max(1, batch.nbytes)))
    return (batch.slice(start, step) for start in range(0, batch.num_rows, step))


def map_rows(
    df: DataFrame, rows_of: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str, at_once: int = 20_000
) -> DataFrame:
    """Run a Python generator over each partition; Arrow batches travel both ways.

    ``rows_of`` gets an iterator over the partition's rows, as tuples in column order, and
    yields output rows. No more is held than one input batch, and ``at_once`` output rows or those that reach
    HELD_BYTES.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    # Only values of these columns can be large.
    wide = [i for i, field in enumerate(arrow) if not pa.types.is_primitive(field.type)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for batch in batches:
                # A batch is in Arrow already; only a slice of it becomes Python objects at a time.
                for part in slices(batch):
                    yield from zip(*(column.to_pylist() for column in part.columns))

        held: list[tuple] = []
        size = 0
        for row in rows_of(source()):
            held.append(row)
            for i in wide:
                size += bytes_of(row[i])
            if len(held) >= at_once or size >= HELD_BYTES:
                yield pack(held, arrow)
                held, size = [], 0
        if held:
            yield pack(held, arrow)
            held = []
        give_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Let batches from Spark to Python end at SENT_BYTES; both sides hold some of them, and buffers for them."""
    if int(spark.conf.get(BATCH_BYTES).rstrip("b")) > SENT_BYTES:
        spark.conf.set(BATCH_BYTES, str(SENT_BYTES))


def give_back() -> None:
    """Return what a task held to the system: its worker stays for later tasks, beside those that others use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# About what an element of a list takes as a Python object.
ELEMENT_BYTES = 32


def bytes_of(value: object) -> int:
    if isinstance(value, (str, bytes)):
        return len(value)
    if isinstance(value, np.ndarray):
        return value.nbytes
    return len(value) * ELEMENT_BYTES if isinstance(value, list) else 0


def map_text(df: DataFrame, column: str, new: Callable[[str | None], str | None]) -> Column:
    """A text per text of a column: only this one travels to Python and back, the others stay where they are."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = slices(pa.record_batch([batch], names=["text"]))
            yield pa.concat_arrays([
                pa.array([], pa.string()), *(pa.array([new(t) for t in part.column(0).to_pylist()], pa.string()) for part in parts)
            ])
        give_back()

    small_batches(df.sparkSession)
    # Called non-deterministic, because a filter on its result would otherwise be pushed below it as a second call.
    return F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()(df[column])


def pack(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    """Rows as one Arrow batch of the given schema."""
    return pa.record_batch(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), arrow)], schema=arrow
    )

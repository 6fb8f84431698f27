"""Readers of the fact, the archive and the dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.clock import typed_time
from ..model import ARCHIVED_FACT, DIMENSIONS, FACT


@dataclass(frozen=True)
class Source:
    """Where a table lives: any format Spark's reader and writer know, with its options."""

    path: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        return spark.read.format(self.format).schema(schema).options(**self.options).load(self.path)

    def write(self, df: DataFrame, mode: str = "overwrite") -> None:
        df.write.format(self.format).options(**self.options).mode(mode).save(self.path)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_or_empty(spark: SparkSession, source: Source, schema: StructType) -> DataFrame:
    """A table that may not exist yet. Any failure other than a missing path surfaces."""
    try:
        return source.read(spark, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def load_hot(spark: SparkSession, source: Source) -> DataFrame:
    """The live fact as it was inserted, with its text time parsed."""
    return typed_time(read_or_empty(spark, source, FACT))


def load_archive(spark: SparkSession, root: str, batches: DataFrame | None = None) -> DataFrame:
    """All archived batches below ``root``, laid out as ``batch_id=…/txn_date=…``.

    ``batches`` (column ``batch_id``) limits the read to committed batches: the semi join on
    the partition column prunes whole folders.
    """
    stored = read_or_empty(spark, Source(root), ARCHIVED_FACT)
    return stored if batches is None else stored.join(batches, "batch_id", "left_semi")


def load_dimension(spark: SparkSession, name: str, source: Source) -> DataFrame:
    schema, _key = DIMENSIONS[name]
    return source.read(spark, schema)


def register(tables: dict[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def has_rows(df: DataFrame) -> bool:
    """Stops at the first row and stays inside the optimized plan."""
    return not df.isEmpty()


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder from whatever file system it lies in; False if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Cleansing and validation."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import parse_time, typed_time
from ..functions.money import unmeasured
from ..model import FACT, FACT_KEYS, STATUSES

REASONS = "reasons"


def checks() -> dict[str, Column]:
    """What can be wrong with a raw fact row: code -> condition, never NULL."""
    amount, status = F.col("transaction_amount"), F.col("status")
    return {
        "bad_timestamp": parse_time("transaction_timestamp").isNull(),
        "null_key": reduce(or_, [F.col(key).isNull() for key in FACT_KEYS]),
        "bad_amount": amount.isNull() | unmeasured(amount) | (amount < 0),
        "unknown_status": status.isNull() | ~status.isin(*STATUSES),
    }


def faulty() -> Column:
    return reduce(or_, checks().values())


def typed_numbers(raw: DataFrame) -> DataFrame:
    """A raw feed whose fields may all be text, with the fact's types; what is no number becomes NULL."""
    kinds = {f.name: f.dataType for f in FACT}
    return raw.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in raw.columns])


def clean_valid(fact: DataFrame) -> DataFrame:
    """Rows that pass every check, with typed time. A narrow step: no shuffle."""
    return typed_time(fact.where(~faulty()))


def quarantine(fact: DataFrame) -> DataFrame:
    """Rows that fail a check, with the codes of all failed checks joined by commas."""
    codes = [F.when(bad, F.lit(code)) for code, bad in checks().items()]
    return fact.where(faulty()).withColumn(REASONS, F.concat_ws(",", *codes))


def ri_orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows without a dimension row, per foreign key (``dims``: key column -> dimension).

    One scan serves all keys: it is unpivoted and reduced to distinct keys inside the map tasks,
    and only those meet the dimension keys. A NULL key is counted apart.
    """
    keys = list(dims)
    wide = fact.select(*[F.col(k).cast("bigint").alias(k) for k in keys])
    used = wide.unpivot([], keys, "dim", "key").groupBy("dim", "key").agg(F.count("*").alias("n"))
    known = None
    for key, dim in dims.items():
        part = dim.select(F.lit(key).alias("dim"), F.col(key).cast("bigint").alias("key"))
        known = part if known is None else known.unionAll(part)
    known = known.distinct().withColumn("known", F.lit(True))
    orphan = F.col("known").isNull() & F.col("key").isNotNull()
    # Every key has its row, also over an empty fact: each starts with a count of no rows.
    start = reduce(DataFrame.unionAll, [
        fact.sparkSession.range(1).select(
            F.lit(key).alias("dim"), F.lit(None).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("n")
        )
        for key in keys
    ])
    return (
        used.unionByName(start).join(known, ["dim", "key"], "left")
        .groupBy("dim")
        .agg(
            F.count_if(orphan).alias("orphan_keys"),
            F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        )
    )


# The ranges of a normal and of a fraudulent transaction.
BANDS = {
    "amount_band": ("transaction_amount", (10, 500), (5000, 20000)),
    "latency_band": ("processing_time", (50, 200), (1000, 3000)),
    "score_band": ("fraud_score", (0, 0.2), (0.8, 1.0)),
}


def band(column: str, normal: tuple, fraud: tuple) -> Column:
    col = F.col(column)
    inside = lambda edges: col.between(F.lit(float(edges[0])), F.lit(float(edges[1])))
    return F.when(inside(normal), "normal").when(inside(fraud), "fraud").otherwise("other")


def label_consistency(fact: DataFrame) -> DataFrame:
    """How often each status goes with each combination of bands.

    ``agrees`` is true when all three bands say what the status says; nothing agrees with an unknown
    status or none.
    """
    named = fact.select("status", *[band(*spec).alias(name) for name, spec in BANDS.items()])
    expected = F.when(F.col("status") == "Fraud", "fraud").when(F.col("status") == "Success", "normal")
    agrees = F.lit(True)
    for name in BANDS:
        agrees = agrees & F.col(name).eqNullSafe(expected)
    return named.groupBy("status", *BANDS).agg(F.count("*").alias("transactions")).withColumn("agrees", agrees)


NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _plain(name: str, kind: str) -> Column:
    """A column whose floats have no -0.0, which is the same value as 0.0 in another text."""
    col = F.col(name)
    return F.when(col == 0, F.lit(0.0)).otherwise(col) if kind in ("float", "double") else col


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, distinct values, numeric minimum and maximum.

    Counts and edges are one aggregate over the typed columns. For the distinct values the table is unpivoted to (column, 128-bit
    hash): equal values are collapsed inside the map tasks, so a value many rows share is shuffled once per task, and a
    column of unique values shuffles 16 bytes of each, however long its texts are. Two different values of one column
    share a hash with a chance of one in 10^18 at 10^10 values. ``column_profile_approx`` shuffles none.
    """
    if not df.columns:
        raise ValueError("a table without columns has no profile")
    plain = [(name, kind, _plain(name, kind)) for name, kind in df.dtypes]
    hashes = [
        F.when(col.isNotNull(), F.struct(F.xxhash64(F.lit(1), col).alias("a"), F.xxhash64(F.lit(2), col).alias("b"))).alias(name)
        for name, _, col in plain
    ]
    values = df.select(*hashes).unpivot([], df.columns, "column", "value").where("value IS NOT NULL").groupBy("column", "value").agg(F.lit(1).alias("one"))
    distinct = values.groupBy("column").agg(F.count("*").alias("distinct_values"))
    measures, rows = [F.count("*").alias("rows")], []
    for at, (name, kind, col) in enumerate(plain):
        number = (col if kind.startswith(NUMERIC) else F.lit(None)).cast("double")
        measures += [F.count(col).alias(f"known_{at}"), F.min(number).alias(f"min_{at}"), F.max(number).alias(f"max_{at}")]
        rows.append(
            F.struct(
                F.lit(name).alias("column"), "rows", (F.col("rows") - F.col(f"known_{at}")).alias("nulls"),
                F.col(f"min_{at}").alias("min_value"), F.col(f"max_{at}").alias("max_value"),
            )
        )
    edges = df.agg(*measures).select(F.inline(F.array(*rows)))
    counted = edges.join(distinct, "column", "left")
    return counted.select(
        "column", "rows", "nulls", F.coalesce("distinct_values", F.lit(0)).cast("bigint").alias("distinct_values"), "min_value", "max_value"
    )


def column_profile_approx(df: DataFrame, precision: int = 14) -> DataFrame:
    """The same profile with HyperLogLog distinct counts, about one percent off.

    One pass without unpivoting: each task sends one row of sketches.
    """
    measures, rows = [F.count("*").alias("rows")], []
    for at, (name, kind) in enumerate(df.dtypes):
        col = _plain(name, kind)
        number = (col if kind.startswith(NUMERIC) else F.lit(None)).cast("double")
        hashed = col if kind in ("int", "bigint", "string") else col.cast("string")
        measures += [
            F.count(col).alias(f"known_{at}"),
            F.hll_sketch_agg(hashed, precision).alias(f"sketch_{at}"),
            F.min(number).alias(f"min_{at}"),
            F.max(number).alias(f"max_{at}"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("rows").alias("rows"),
                (F.col("rows") - F.col(f"known_{at}")).alias("nulls"),
                F.hll_sketch_estimate(f"sketch_{at}").alias("distinct_values"),
                F.col(f"min_{at}").alias("min_value"),
                F.col(f"max_{at}").alias("max_value"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))

"""Hot and archived transactions as one fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def hot_cold_union(live: DataFrame, *batches: DataFrame) -> DataFrame:
    """UNION ALL by name. A missing column becomes NULL, so an older batch can still be read."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches, live)


def nameless(columns: list[str], key: str = "transaction_id") -> Column:
    """The whole row as text where it has no key, else NULL: such rows are copies only if identical."""
    return F.when(F.col(key).isNull(), F.to_json(F.struct(*columns)))


def dedup_by_id(fact: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per transaction, whatever the copies look like.

    The smallest row wins instead of the first: the result is the same after a lost executor is
    replaced. Ids are counted first, in a hash table with map-side combine; only rows whose id
    occurs again are sorted and shuffled whole, and their copies are combined inside the map
    tasks, so a transaction copied many times is one row per task. The other rows pass by.
    """
    rest = [c for c in fact.columns if c != key]
    named = fact.withColumn(WHOLE, nameless(rest, key))
    repeated = named.groupBy(key, WHOLE).agg(F.count("*").alias("n")).where("n > 1")
    repeated = repeated.select(F.col(key).alias("copied id"), F.col(WHOLE).alias("copied row"))
    same = F.col(key).eqNullSafe(F.col("copied id")) & F.col(WHOLE).eqNullSafe(F.col("copied row"))
    copies = named.join(repeated, same, "left_semi").groupBy(key, WHOLE).agg(F.min(F.struct(*rest)).alias("row"))
    once = named.join(repeated, same, "left_anti").select(*fact.columns)
    return once.unionByName(copies.select(key, "row.*").select(*fact.columns))


# A name no fact has; the text of a row without a key travels under it.
WHOLE = "whole row"


def expired(ts: Column | str, cutoff: Column) -> Column:
    """Not kept by the retention rule. A row without time cannot be kept, so it counts as expired."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return (col < cutoff) | col.isNull()


def dedup_by_cutoff(live: DataFrame, batches: list[tuple[DataFrame, Column]], ts: str = "ts") -> DataFrame:
    """Overlapping snapshots as a disjoint union, without any shuffle.

    Every row a snapshot holds at or after its run's cutoff stayed live and is therefore in the next
    snapshot, or still live. Taking from each batch only what expired at its run counts each
    transaction once. The cutoffs come from the manifest; the filter is pushed into the scan.
    """
    return hot_cold_union(live, *[batch.where(expired(ts, cutoff)) for batch, cutoff in batches])

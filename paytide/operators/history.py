"""Dimensions as they were: validity intervals and as-of joins.

An upsert overwrites, so a KPI by label moves the past when a label changes. A history keeps every state of a key with the
time from which it held, and each transaction is joined to the state of its own time.

A join on ``from <= ts < until`` is no equi-join and would compare every transaction of a key with every state of it; sorting
transactions and states together by key and time would put a busy key into one task. Here time is cut into hours. Only the
hours of a key in which it has transactions, which are few beside the transactions, are sorted together with
its states; each gets the state at its start and the changes within it. The transactions join these by key and hour:
an equi-join whose right side has one row per key and hour, so a busy key is spread over its hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Names no table has.
HOUR, STATES, KEY = "as of hour", "as of states", "as of key"


def versions(updates: DataFrame, key: str, at: str, columns: list[str], order: str | None = None) -> DataFrame:
    """(key, valid_from, valid_to, columns): what held for a key, and when.

    ``updates`` has the key, the time ``at``, the columns, and may have ``sets``, the names of the columns a row sets; others keep
    their value, and an explicit NULL overwrites. Of updates at one time the last by ``order`` wins. ``valid_to`` is the time of
    the next change, NULL for the state that holds now. Updates without a key or time say nothing.
    """
    told = updates.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    by_time = Window.partitionBy(key).orderBy(at, *([order] if order else []))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    set_here = lambda c: F.array_contains("sets", c) if "sets" in updates.columns else F.lit(True)
    state = [
        F.last(F.when(set_here(c), F.struct(F.col(c).alias("value"))), ignorenulls=True).over(so_far)["value"].alias(c) for c in columns
    ]
    following = F.lead(at).over(by_time)
    held = told.select(key, F.col(at).alias("valid_from"), following.alias("valid_to"), *state)
    return held.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


def as_of(fact: DataFrame, history: DataFrame, key: str, columns: list[str], ts: str = "ts") -> DataFrame:
    """``fact`` with the columns of the state that held at ``ts``; NULL before a key's first state, and for unknown keys."""
    hour = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz")
    state = F.struct(F.col("valid_from").alias("since"), *columns).alias("state")
    known = history.select(F.col(key).alias(KEY), F.col("valid_from").alias("at"), state)
    busy = fact.where(F.col(key).isNotNull()).select(F.col(key).alias(KEY), hour(ts).alias("at")).where("at IS NOT NULL").distinct()
    both = known.select(KEY, "at", "state", F.lit(False).alias("asks")).unionByName(
        busy.select(KEY, "at", F.lit(None).cast(known.schema["state"].dataType).alias("state"), F.lit(True).alias("asks"))
    )
    # A state that begins with an hour holds in all of it, so it comes before the hour that asks.
    before = Window.partitionBy(KEY).orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    asked = both.withColumn("state", F.last("state", ignorenulls=True).over(before)).where("asks").select(KEY, F.col("at").alias(HOUR), "state")
    changes = known.groupBy(KEY, hour("at").alias(HOUR)).agg(F.collect_list("state").alias("changes"))
    # Sorted by ``since``; the state at the start comes first, because nothing of the hour is older.
    told = asked.join(changes, [KEY, HOUR], "left").select(
        KEY, HOUR, F.array_compact(F.array_sort(F.concat(F.array("state"), F.coalesce("changes", F.array())))).alias(STATES)
    )
    rows = fact.withColumn(HOUR, hour(ts)).withColumn(KEY, F.col(key))
    joined = rows.join(told, [KEY, HOUR], "left")
    now = F.element_at(F.filter(STATES, lambda s: s["since"] <= F.col(ts)), -1)
    return joined.withColumn(STATES, F.when(F.size(F.filter(STATES, lambda s: s["since"] <= F.col(ts))) > 0, now)).select(
        *fact.columns, *[F.col(STATES)[c].alias(c) for c in columns]
    )

"""All KPI groupings from one scan of the fact.

The fact is unpivoted to (kpi, key) and reduced to one row per distinct key with map-side
combine. Everything after that works on the reduced rows: one join with all dimension labels at
once, then one merge by label. The global KPI is derived from the daily rows and costs no extra
copy of the fact.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import amount_of, mean_of
from ..operators.enrich import LABELS
from ..operators.kpis import percent
from ..operators.totals import MEASURES, SUMS, merge, totals

# A table of the fact's parents, and the key both share. It carries foreign keys the fact lacks.
Header = tuple[DataFrame, str]


def _keys(kpis: Iterable[str]) -> list[Column]:
    return [F.col(LABELS[kpi][0]).cast("bigint").alias(kpi) for kpi in kpis]


def _reduced(fact: DataFrame, kpis: list[str], parent_key: str | None = None) -> DataFrame:
    """Totals per (kpi, key): one scan, and one row per distinct key leaves each map task.

    A parent's key is reduced in the same scan, as if it were a KPI of the name ``PARENT``.
    """
    values = ["transaction_amount", "status"]
    parent = [] if parent_key is None else [F.col(parent_key).cast("bigint").alias(PARENT)]
    wide = fact.select(F.unix_date("txn_date").cast("bigint").alias("daily"), *_keys(kpis), *parent, *values)
    names = ["daily", *kpis, *([PARENT] if parent else [])]
    return totals(wide.unpivot(values, names, "kpi", "key"), "kpi", "key")


PARENT = "parent"


def _through_parents(reduced: DataFrame, kpis: list[str], header: Header) -> DataFrame:
    """Totals per parent turned into totals per key that only the parents have.

    The other rows pass through the same join without a partner, spread by their own keys, so the
    fact needs no second scan. A total without a parent is dropped, as by an inner join.
    """
    parents, parent_key = header
    known = parents.select(
        F.lit(True).alias("of_parent"), F.col(parent_key).cast("bigint").alias("parent_key"), *_keys(kpis)
    )
    is_parent = F.col("kpi") == PARENT
    joined = reduced.join(
        known, (is_parent == F.col("of_parent")) & (F.col("key") == F.col("parent_key")), "left"
    )
    own = F.array(F.struct("kpi", "key"))
    theirs = F.array(*[F.struct(F.lit(k).alias("kpi"), F.col(k).alias("key")) for k in kpis])
    places = F.when(~is_parent, own).when(F.col("of_parent"), theirs)
    spread = joined.select(F.explode(places).alias("to"), *MEASURES).select("to.kpi", "to.key", *MEASURES)
    return merge(spread, "kpi", "key")


def _labels(dims: dict[str, DataFrame]) -> DataFrame:
    """All dimensions as one lookup (kpi, key, label)."""
    parts = [
        dim.select(
            F.lit(kpi).alias("kpi"),
            F.col(LABELS[kpi][0]).cast("bigint").alias("key"),
            F.col(LABELS[kpi][1]).alias("label"),
            F.lit(True).alias("known"),
        )
        for kpi, dim in dims.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def reduce_fact(fact: DataFrame, kpis: Iterable[str], header: Header | None = None) -> DataFrame:
    """Totals per (kpi, key) for ``daily`` and ``kpis``. Keys the fact lacks come from ``header``.

    Reduced facts add up: the union of two, merged, is the reduced union.
    """
    own = [kpi for kpi in kpis if header is None or LABELS[kpi][0] in fact.columns]
    theirs = [kpi for kpi in kpis if kpi not in own]
    if not theirs:
        return _reduced(fact, own)
    return _through_parents(_reduced(fact, own, header[1]), theirs, header)


def label_totals(reduced: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Totals as (kpi, dim_value, measures) for ``global``, ``daily`` and each of ``dims``.

    Each KPI keeps the meaning of its own inner join: rows with an unknown or NULL key are missing
    from that KPI only. The global row exists over an empty fact, too.
    """
    daily = F.col("kpi") == "daily"
    known = reduced.where(daily | F.col("key").isNotNull()).join(_labels(dims), ["kpi", "key"], "left")
    days = F.date_from_unix_date(F.col("key").cast("int")).cast("string")
    value = F.when(daily, days).otherwise(F.col("label"))
    labelled = known.where(daily | F.col("known")).withColumn("dim_value", value)
    own_place = F.struct(F.col("kpi").alias("kpi"), F.col("dim_value").alias("dim_value"))
    whole = F.struct(F.lit("global").alias("kpi"), F.lit(None).cast("string").alias("dim_value"))
    places = F.when(daily, F.array(own_place, whole)).otherwise(F.array(own_place))
    spread = labelled.select(F.explode(places).alias("to"), *MEASURES).select("to.kpi", "to.dim_value", *MEASURES)
    nothing = [F.lit(None if m in SUMS else 0).cast("bigint").alias(m) for m in MEASURES]
    start = reduced.sparkSession.range(1).select(whole.kpi.alias("kpi"), whole.dim_value.alias("dim_value"), *nothing)
    return merge(spread.unionByName(start), "kpi", "dim_value")


def long_kpis(labelled: DataFrame) -> DataFrame:
    """Labelled totals as the long KPI table."""
    return labelled.select(
        "kpi",
        "dim_value",
        F.col("n").alias("transactions"),
        amount_of().alias("total"),
        mean_of("n_priced").alias("average"),
    )


def kpi_all_one_pass(fact: DataFrame, dims: dict[str, DataFrame], header: Header | None = None) -> DataFrame:
    """Every KPI in long form."""
    return long_kpis(label_totals(reduce_fact(fact, dims, header), dims))


def kpi_fraud_rate(fact: DataFrame, dims: dict[str, DataFrame], header: Header | None = None) -> DataFrame:
    """Share of fraudulent transactions, overall, per day and per dimension label."""
    return label_totals(reduce_fact(fact, dims, header), dims).select(
        "kpi",
        "dim_value",
        F.col("n").alias("transactions"),
        F.col("n_fraud").alias("fraud_transactions"),
        percent(F.col("n_fraud"), F.col("n")).alias("fraud_rate_pct"),
    )

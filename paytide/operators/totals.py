"""Totals that can be merged: the base of every KPI.

A KPI over a dimension is computed in two steps. First the fact is reduced to one row per
foreign key, then those rows are looked up in the dimension and merged by its label. The
first step combines inside each map task, so only distinct keys are shuffled: a key that holds a
third of the fact costs one row per task. Joining the reduced rows instead of the fact is exact
because counts and unit sums add up: an unknown key drops out, a duplicated dimension key fans out,
just as in the row-level inner join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import amount_of, mean_of, measured, sums, unmeasured

AMOUNT = "transaction_amount"
MEASURES = ("n", "n_priced", "n_odd", "units", "parts", "n_fraud")
# Sums that are NULL where nothing was measured.
SUMS = ("units", "parts")


def totals(fact: DataFrame, *keys: str | Column) -> DataFrame:
    """Row count, count and sum of amounts, odd amounts, and fraud count per key. Unused ones are pruned."""
    return fact.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count(measured(AMOUNT)).alias("n_priced"),
        F.count_if(unmeasured(AMOUNT)).alias("n_odd"),
        *sums(AMOUNT),
        F.count_if(F.col("status") == "Fraud").alias("n_fraud"),
    )


def merge(partials: DataFrame, *keys: str | Column) -> DataFrame:
    """Totals of totals."""
    return partials.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES if m in partials.columns])


def roll_up(partials: DataFrame, lookup: DataFrame, on: str, to: str) -> DataFrame:
    """Carry totals per ``on`` over to totals per ``to`` through a lookup table.

    No broadcast hint: Spark broadcasts the lookup when its size is below the threshold and
    otherwise sort-merge joins the already reduced, skew-free rows.
    """
    return merge(partials.join(lookup.select(on, to), on), to)


def report(partials: DataFrame, transactions: str, total: str, average: str, label: str | None = None) -> DataFrame:
    """Totals under the column names of a KPI table."""
    columns = [] if label is None else [F.col(label)]
    return partials.select(
        *columns,
        F.coalesce("n", F.lit(0)).cast("bigint").alias(transactions),
        amount_of().alias(total),
        mean_of("n_priced").alias(average),
    )

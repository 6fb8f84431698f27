"""The KPIs of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import amount_of, mean_of
from ..model import KPI_TABLES
from .totals import SUMS, report, roll_up, totals


def kpi_global(fact: DataFrame) -> DataFrame:
    """One row, also over an empty fact."""
    return report(totals(fact), *KPI_TABLES["global"][3:])


def kpi_daily(fact: DataFrame) -> DataFrame:
    _, _, label, *names = KPI_TABLES["daily"]
    return report(totals(fact, label), *names, label=label).orderBy(label)


def kpi_by_label(
    partials: DataFrame, dim: DataFrame, key: str, label: str, transactions: str, total: str, average: str
) -> DataFrame:
    """KPI of a dimension label from totals per foreign key, largest total first."""
    rolled = roll_up(partials, dim, key, label)
    return report(rolled, transactions, total, average, label=label).orderBy(F.desc(total), label)


def kpi_by_own_label(fact: DataFrame, kpi: str) -> DataFrame:
    """KPI of a label that the fact itself carries."""
    _, _, label, *names = KPI_TABLES[kpi]
    return report(totals(fact, label), *names, label=label).orderBy(F.desc(names[1]), label)


def kpi_by_merchant_category(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    _, _, label, *names = KPI_TABLES["merchant"]
    return kpi_by_label(totals(fact, "merchant_id"), merchants, "merchant_id", label, *names)


def kpi_by_customer_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    _, _, label, *names = KPI_TABLES["customer"]
    return kpi_by_label(totals(fact, "customer_id"), customers, "customer_id", label, *names)


def kpi_by_payment_method(fact: DataFrame, methods: DataFrame) -> DataFrame:
    _, _, label, *names = KPI_TABLES["payment"]
    return kpi_by_label(totals(fact, "payment_method_id"), methods, "payment_method_id", label, *names)


def kpi_by_device(fact: DataFrame, devices: DataFrame) -> DataFrame:
    return kpi_by_label(
        totals(fact, "device_id"), devices, "device_id", "device_type", "transactions", "total_volume", "avg_value"
    )


def kpi_by_calendar(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Totals per weekday and hour; the fact is down to 168 rows before it meets the calendar."""
    slots = totals(fact, F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour"))
    named = slots.join(calendar, ["weekday", "hour"])
    return named.select(
        "day_of_week",
        "hour",
        "is_weekend",
        F.col("n").alias("transactions"),
        amount_of().alias("total_volume"),
        mean_of("n_priced").alias("avg_value"),
    )


def percent(part: Column, whole: Column) -> Column:
    """Percentage in DOUBLE; NULL for an empty whole."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def share(partials: DataFrame, methods: DataFrame) -> DataFrame:
    """Each payment method's part of the whole volume, from totals per method.

    The window has no partition, but its input is one row per method.
    """
    rolled = roll_up(partials, methods, "payment_method_id", "method_type")
    everything = Window.partitionBy()
    whole = amount_of(F.sum("units").over(everything), F.sum("parts").over(everything))
    return rolled.select(
        "method_type",
        amount_of().alias("total_volume"),
        F.try_divide(amount_of(), whole).alias("share"),
    )


def payment_share(fact: DataFrame, methods: DataFrame) -> DataFrame:
    return share(totals(fact, "payment_method_id"), methods)


def overview_cards(fact: DataFrame) -> DataFrame:
    """The dashboard's cards from the daily KPI.

    ``avg_of_daily_avg`` is the unweighted mean of the daily means cut to an integer, as the
    dashboard shows it; ``avg_value`` is the mean over transactions.
    """
    daily = totals(fact, "txn_date").withColumn("daily_avg", mean_of("n_priced"))
    cards = daily.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in SUMS],
        F.sum("n_priced").alias("n_priced"),
        F.coalesce(F.avg("daily_avg").cast("int"), F.lit(0)).alias("avg_of_daily_avg"),
    )
    revenue = amount_of()
    return cards.select(
        "total_transactions",
        revenue.alias("total_revenue"),
        "avg_of_daily_avg",
        mean_of("n_priced").alias("avg_value"),
        F.format_number("total_transactions", 0).alias("transactions_text"),
        F.format_string("%.2f B", revenue / F.lit(1e9)).alias("revenue_text"),
    )

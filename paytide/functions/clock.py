"""Time columns: text to typed, typed to text, and "now" as a value of the data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def moment(value: datetime | str | None) -> Column:
    """A fixed UTC time. It travels as text: a Python datetime would pass through the time zone of the process."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def parse_time(text: Column | str) -> Column:
    """Timestamp of a text, NULL where it does not parse (a raise would end the whole job)."""
    return F.try_to_timestamp(text, F.lit(TEXT_FORMAT)).cast("timestamp_ntz")


def parse_day(text: Column | str) -> Column:
    """Date of an ISO text, NULL where it does not parse."""
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def text_of(ts: Column | str) -> Column:
    return F.date_format(ts, TEXT_FORMAT)


def typed_time(df: DataFrame) -> DataFrame:
    """Give the fact its ``ts`` and ``txn_date`` columns, parsing the text only if it must."""
    if "ts" not in df.columns:
        df = df.withColumn("ts", parse_time("transaction_timestamp"))
    return df.withColumn("txn_date", F.to_date("ts"))


def latest(df: DataFrame, column: str = "ts", back: Column | None = None) -> Column:
    """The newest value of a column, less ``back``, as a scalar subquery.

    It runs before the query that uses it and arrives there as a literal; no join is involved. The
    subtraction belongs inside: the scan takes a filter on a bare subquery, not on an expression
    over it.
    """
    newest = F.max(column)
    return df.agg(newest if back is None else newest - back).scalar()

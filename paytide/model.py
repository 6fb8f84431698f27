"""Declared schemas of the payments model.

Every source is read with one of these schemas, so an empty table still has its
columns, a file scan needs no inference job, and a stream can start before data exists.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

KINDS = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "ARRAY<INT>": T.ArrayType(T.IntegerType()),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
    "MAP<STRING,BOOLEAN>": T.MapType(T.StringType(), T.BooleanType()),
}


def schema(columns: str) -> T.StructType:
    """A schema from ``name TYPE, …``; needs no running session."""
    pairs = (column.split() for column in re.split(r",\s+", columns))
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


FACT = schema(
    """transaction_id STRING, customer_id BIGINT, merchant_id BIGINT, device_id BIGINT,
       payment_method_id INT, transaction_timestamp STRING, transaction_amount DOUBLE,
       processing_time DOUBLE, fraud_score DOUBLE, status STRING"""
)

# The fact as it is stored after ingest: the text is parsed once, on the way in.
STORED_FACT = schema(
    """transaction_id STRING, customer_id BIGINT, merchant_id BIGINT, device_id BIGINT,
       payment_method_id INT, transaction_timestamp STRING, transaction_amount DOUBLE,
       processing_time DOUBLE, fraud_score DOUBLE, status STRING,
       ts TIMESTAMP_NTZ, txn_date DATE"""
)

# In the archive each batch is a folder, so its id is a partition column.
ARCHIVED_FACT = T.StructType([*STORED_FACT.fields, *schema("batch_id BIGINT").fields])

# One row per archive run; a run counts only once its row is here. ``whole`` tells that all rows of the batch left the
# hot table; a snapshot also holds rows that stayed. ``folder`` is where the batch lies, ``checksum`` that of all its rows.
MANIFEST = schema(
    """batch_id BIGINT, generation BIGINT, cutoff TIMESTAMP_NTZ, min_ts TIMESTAMP_NTZ, max_ts TIMESTAMP_NTZ,
       rows BIGINT, kept BIGINT, expired BIGINT, checksum STRING, whole BOOLEAN, folder STRING, stored BIGINT"""
)

CUSTOMERS = schema(
    """customer_id BIGINT, name STRING, email STRING, phone STRING, customer_segment STRING,
       account_age_days INT, total_lifetime_spend DOUBLE, country STRING"""
)

MERCHANTS = schema(
    """merchant_id BIGINT, merchant_name STRING, business_category STRING, risk_category STRING,
       registration_date STRING, country STRING, avg_daily_transactions INT, avg_dispute_rate DOUBLE"""
)

DEVICES = schema(
    """device_id BIGINT, device_type STRING, os STRING, browser STRING,
       is_rooted_jailbroken BOOLEAN"""
)

PAYMENT_METHODS = schema(
    "payment_method_id INT, method_type STRING, issuer_bank STRING, risk_weight DOUBLE"
)

DATETIME = schema(
    "hours ARRAY<INT>, days_of_week ARRAY<STRING>, weekend_flags MAP<STRING,BOOLEAN>"
)

SERVING = schema("key STRING, payload STRING")

# Dimension table -> (schema, key column).
DIMENSIONS = {
    "customers_dim": (CUSTOMERS, "customer_id"),
    "merchants_dim": (MERCHANTS, "merchant_id"),
    "devices_dim": (DEVICES, "device_id"),
    "payment_methods_dim": (PAYMENT_METHODS, "payment_method_id"),
}

FACT_KEYS = ("transaction_id", "customer_id", "merchant_id", "device_id", "payment_method_id")
STATUSES = ("Success", "Fraud")

# What was archived, per hour: two such tables are equal exactly if the rows of the hours are.
FINGERPRINTS = schema("hour TIMESTAMP_NTZ, rows BIGINT, checksum STRING")

# KPI name -> (result table, cache key, name of the label, count, total and average columns).
KPI_TABLES = {
    "global": ("kpis_global", "kpi:global", None, "total_transactions", "total_volume", "avg_transaction_value"),
    "daily": ("kpis_daily", "kpi:daily", "txn_date", "transactions", "total_volume", "avg_value"),
    "merchant": ("kpis_by_merchant_category", "kpi:merchant", "business_category", "transactions", "total_revenue", "avg_ticket_size"),
    "customer": ("kpis_by_customer_segment", "kpi:customer", "customer_segment", "transactions", "total_spend", "avg_spend"),
    "payment": ("kpis_by_payment_method", "kpi:payment", "method_type", "transactions", "total_volume", "avg_value"),
}

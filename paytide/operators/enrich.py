"""Transactions with the labels of their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Dimension of a KPI -> (foreign key of the fact, label column of the dimension).
LABELS = {
    "merchant": ("merchant_id", "business_category"),
    "customer": ("customer_id", "customer_segment"),
    "payment": ("payment_method_id", "method_type"),
    "device": ("device_id", "device_type"),
}


def enrich(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Each transaction with a label per dimension, NULL for an unknown or NULL key.

    These joins carry whole rows. Small dimensions are broadcast by Spark; against a large one a key
    that holds much of the fact is split by adaptive execution.
    """
    for kpi, dim in dims.items():
        key, label = LABELS[kpi]
        fact = fact.join(dim.select(key, label), key, "left")
    return fact

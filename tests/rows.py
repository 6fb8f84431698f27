"""Small literal facts and dimensions."""

from datetime import datetime

from paytide.functions.clock import typed_time
from paytide.model import FACT, schema

CUSTOMERS = schema("customer_id BIGINT, customer_segment STRING")
MERCHANTS = schema("merchant_id BIGINT, business_category STRING")
METHODS = schema("payment_method_id INT, method_type STRING")
DEVICES = schema("device_id BIGINT, device_type STRING")


def at(text):
    return datetime.fromisoformat(text)


def txn(number, customer=1, merchant=1, device=1, method=1, when="2024-01-01 10:00:00", amount=10.0, took=100.0,
        score=0.1, status="Success"):
    return (f"t{number}", customer, merchant, device, method, when, amount, took, score, status)


def raw(spark, rows):
    return spark.createDataFrame(rows, FACT)


def fact(spark, rows):
    return typed_time(raw(spark, rows))


def same(left, right):
    """Same columns, same rows, any order, copies counted."""
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    assert left.exceptAll(right).take(3) == []
    assert right.exceptAll(left).take(3) == []

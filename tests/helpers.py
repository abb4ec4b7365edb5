"""Tiny hand-made logical tables for boundary tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from kpiforge import schemas

ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
              "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]


def ts(s: str | None):
    if s is None:
        return None
    return dt.datetime.fromisoformat(s)


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def _schema(full: T.StructType, cols: list[str]) -> T.StructType:
    by = {f.name: f for f in full.fields}
    return T.StructType([by[c] for c in cols])


def tables(spark, orders=(), customers=(), items=(), reviews=(), payments=(), products=(),
           translation=()):
    """Logical raw tables from row tuples (columns as in the KPI contract)."""
    return {
        "orders": spark.createDataFrame(list(orders), _schema(schemas.ORDERS, ORDER_COLS)),
        "customers": spark.createDataFrame(list(customers),
                                           _schema(schemas.CUSTOMERS, ["customer_id", "customer_state"])),
        "order_items": spark.createDataFrame(
            [(o, p, money(pr), money(f)) for o, p, pr, f in items],
            _schema(schemas.ORDER_ITEMS, ["order_id", "product_id", "price", "freight_value"])),
        "order_reviews": spark.createDataFrame(
            list(reviews), _schema(schemas.ORDER_REVIEWS, ["order_id", "review_score"])),
        "order_payments": spark.createDataFrame(
            [(t, i, money(v)) for t, i, v in payments],
            _schema(schemas.ORDER_PAYMENTS, ["payment_type", "payment_installments", "payment_value"])),
        "products": spark.createDataFrame(
            list(products), _schema(schemas.PRODUCTS, ["product_id", "product_category_name"])),
        "product_category_name_translation": spark.createDataFrame(
            list(translation), schemas.CATEGORY_TRANSLATION),
    }


def order(oid, est, delivered, status="delivered", customer="c1", purchase="2018-01-01 00:00:00",
          approved="2018-01-01 01:00:00", carrier="2018-01-03 00:00:00"):
    return (oid, customer, status, ts(purchase), ts(approved), ts(carrier), ts(delivered), ts(est))


def as_dicts(df, key):
    return {r[key]: r.asDict() for r in df.collect()}

"""Logical schemas of the raw marketplace tables and of the KPI outputs.

Identifier and code columns are STRING on purpose: inferring them as numbers
would drop leading zeros (a zip prefix ``01409`` becoming 1409). Timestamps are
TIMESTAMP_NTZ: the source stamps carry no zone, and durations must be plain
wall-clock differences (no daylight-saving hour appears or disappears).
Money is DECIMAL(12,2) so that sums are exact and independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, INT, MONEY, DBL = (T.StringType(), T.TimestampNTZType(), T.IntegerType(),
                          T.DecimalType(12, 2), T.DoubleType())


def _struct(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


ORDERS = _struct(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS))

CUSTOMERS = _struct(
    ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S))

ORDER_ITEMS = _struct(
    ("order_id", S), ("order_item_id", INT), ("product_id", S), ("seller_id", S),
    ("shipping_limit_date", TS), ("price", MONEY), ("freight_value", MONEY))

ORDER_REVIEWS = _struct(
    ("review_id", S), ("order_id", S), ("review_score", INT),
    ("review_comment_title", S), ("review_comment_message", S),
    ("review_creation_date", TS), ("review_answer_timestamp", TS))

ORDER_PAYMENTS = _struct(
    ("order_id", S), ("payment_sequential", INT), ("payment_type", S),
    ("payment_installments", INT), ("payment_value", MONEY))

PRODUCTS = _struct(
    ("product_id", S), ("product_category_name", S), ("product_name_lenght", INT),
    ("product_description_lenght", INT), ("product_photos_qty", INT),
    ("product_weight_g", INT), ("product_length_cm", INT), ("product_height_cm", INT),
    ("product_width_cm", INT))

SELLERS = _struct(
    ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S))

GEOLOCATION = _struct(
    ("geolocation_zip_code_prefix", S), ("geolocation_lat", DBL), ("geolocation_lng", DBL),
    ("geolocation_city", S), ("geolocation_state", S))

CATEGORY_TRANSLATION = _struct(
    ("product_category_name", S), ("product_category_name_english", S))

# Raw table name -> schema. Columns that are not listed here take the type that
# all of their values have (``sources.columns``), without loss.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "order_items": ORDER_ITEMS,
    "order_reviews": ORDER_REVIEWS,
    "order_payments": ORDER_PAYMENTS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "product_category_name_translation": CATEGORY_TRANSLATION,
}

# The tokens a default pandas CSV read turns into missing values.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

"""Order-level building blocks shared by several KPIs.

Derived columns (on-time flag, delay, band, durations) are computed here, on
the scan side, so that only a handful of narrow columns cross each shuffle.
Reviews are pre-aggregated per order before they meet the orders: an order
with many reviews becomes one row, and the order x review grain the KPIs count
is recovered from the per-order counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import DELIVERED, delay_band, is_late, is_on_time, micros_between

DELIVERED_AT = "order_delivered_customer_date"
ESTIMATED_AT = "order_estimated_delivery_date"
ORDER_FACT = "delivered_order_fact"
REVIEW_FOLD = "delivered_order_reviews"

# duration name -> (end stamp, start stamp)
STAGES = {
    "total": (DELIVERED_AT, "order_purchase_timestamp"),
    "approval": ("order_approved_at", "order_purchase_timestamp"),
    "dispatch": ("order_delivered_carrier_date", "order_approved_at"),
    "transit": (DELIVERED_AT, "order_delivered_carrier_date"),
}


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Orders with status delivered and a customer delivery stamp."""
    return orders.where((F.col("order_status") == DELIVERED) & F.col(DELIVERED_AT).isNotNull())


def state_of_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("customer_state").alias("estado"))


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """One row per order_id: review rows, score sum/count and per-score counts."""
    s = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rev"),
        F.sum(s).alias("s_score"),
        F.count(s).alias("c_score"),
        F.count_if(s >= 4).alias("n_pos"),
        F.count_if(s == 3).alias("n_neu"),
        F.count_if(s <= 2).alias("n_neg"),
        *[F.count_if(s == v).alias(f"n_{v}") for v in (5, 4, 3, 2, 1)],
    )


def build_order_fact(t) -> DataFrame:
    """Delivered orders (with or without a delivery stamp) joined with the
    buyer's state, carrying every derived flag and duration the state-level
    KPIs need. Grain: one row per order row and matching customer row - the
    grain the state KPIs join at."""
    o = t["orders"].where(F.col("order_status") == DELIVERED).select(
        "order_id", "customer_id",
        F.col(DELIVERED_AT).isNotNull().alias("has_delivery"),
        (F.col("order_approved_at").isNotNull()
         & F.col("order_delivered_carrier_date").isNotNull()).alias("has_stamps"),
        is_on_time().alias("on_time"),
        F.when(is_late(), micros_between(DELIVERED_AT, ESTIMATED_AT)).alias("late_us"),
        *[micros_between(a, b).alias(f"{k}_us") for k, (a, b) in STAGES.items()])
    return o.join(state_of_customer(t["customers"]), "customer_id").drop("customer_id")


def order_fact(t) -> DataFrame:
    """The shared order fact when the caller materialised one, else built inline."""
    return t[ORDER_FACT] if ORDER_FACT in t else build_order_fact(t)


def with_order_fact(t, materialize) -> dict:
    """``t`` plus the order fact, materialised once (``materialize`` is a lineage
    cut) so that every state KPI of a run reads it instead of joining orders
    with customers again."""
    out = dict(t)
    out[ORDER_FACT] = materialize(build_order_fact(t))
    return out


def build_review_fold(t) -> DataFrame:
    """Delivered orders with the fold of their reviews: buyer, on-time flag,
    delay band and the per-order review counts."""
    o = delivered_orders(t["orders"]).select("order_id", "customer_id", is_on_time().alias("on_time"),
                                             delay_band().alias("faixa_atraso"))
    return o.join(reviews_per_order(t["order_reviews"]), "order_id")


def review_fold(t) -> DataFrame:
    """The shared review fold when the caller materialised one, else built inline."""
    return t[REVIEW_FOLD] if REVIEW_FOLD in t else build_review_fold(t)


def with_review_fold(t, materialize) -> dict:
    """``t`` plus the review fold, materialised once for the KPIs that count
    order x review rows."""
    out = dict(t)
    out[REVIEW_FOLD] = materialize(build_review_fold(t))
    return out


def sum0(c) -> F.Column:
    """SUM that yields 0 instead of null (count-like measures)."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")

"""K1 - on-time delivery by state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import days, is_late, is_on_time, micros_between, pct, rnd, safe_div
from kpiforge.operators.facts import (DELIVERED_AT, ORDER_FACT, delivered_orders,
                                      state_of_customer)

NAME = "otd"


def build(t: dict[str, DataFrame]) -> DataFrame:
    """Delivered orders per customer state: orders, on time (delivered <= estimate),
    late (>), on-time %, mean and worst lateness in days over late orders.

    Orders are first folded per customer (map-side combine; a customer with a
    huge share of orders becomes one row per map task), so the join with the
    customers sees one row per customer instead of one per order.
    """
    if ORDER_FACT in t:
        per_state = (t[ORDER_FACT].where(F.col("has_delivery")).groupBy("estado")
                     .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("on_time")).alias("n_on"),
                          F.count_if(~F.col("on_time")).alias("n_late"),
                          F.sum(F.col("late_us").cast("decimal(38,0)")).alias("late_sum"),
                          F.max("late_us").alias("late_max")))
        return _finish(per_state)
    o = delivered_orders(t["orders"]).select(
        "customer_id",
        is_on_time().alias("on_time"),
        F.when(is_late(), micros_between(DELIVERED_AT, "order_estimated_delivery_date"))
         .alias("late_us"))
    per_customer = o.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("on_time")).alias("n_on"),
        F.count_if(~F.col("on_time")).alias("n_late"),
        F.sum(F.col("late_us").cast("decimal(38,0)")).alias("late_sum"),
        F.max("late_us").alias("late_max"))
    per_state = (per_customer.join(state_of_customer(t["customers"]), "customer_id")
                 .groupBy("estado")
                 .agg(F.sum("n").alias("n"), F.sum("n_on").alias("n_on"),
                      F.sum("n_late").alias("n_late"), F.sum("late_sum").alias("late_sum"),
                      F.max("late_max").alias("late_max")))
    return _finish(per_state)


def _finish(per_state: DataFrame) -> DataFrame:
    return (per_state.select(
        "estado",
        F.col("n").alias("total_pedidos"),
        F.col("n_on").alias("pedidos_no_prazo"),
        F.col("n_late").alias("pedidos_atrasados"),
        pct("n_on", "n", 2).alias("otd_pct"),
        rnd(safe_div("late_sum", "n_late") / 86_400_000_000.0, 1).alias("atraso_medio_dias"),
        rnd(days("late_max"), 1).alias("pior_atraso_dias"))
        .orderBy(F.desc_nulls_first("otd_pct"), F.asc_nulls_first("estado")))

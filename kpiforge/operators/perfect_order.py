"""K3 - perfect order rate by state (order x review grain)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import pct, rnd, safe_div
from kpiforge.operators.facts import (ORDER_FACT, REVIEW_FOLD, review_fold, reviews_per_order,
                                      state_of_customer, sum0)

NAME = "perfect_order"


def build(t: dict[str, DataFrame]) -> DataFrame:
    """Delivered orders joined with their reviews; every review row counts, so an
    order with two reviews counts twice. Perfect = on time and score >= 4.

    Reviews are folded per order and orders per customer before the customer
    join; the per-order counts reproduce the order x review grain exactly.
    In a pipeline run the shared review fold is read, or the order fact (already
    joined with the state) where only that is shared.
    """
    if REVIEW_FOLD not in t and ORDER_FACT in t:
        grain, joined = "estado", (t[ORDER_FACT].where(F.col("has_delivery"))
                                   .select("order_id", "estado", "on_time")
                                   .join(reviews_per_order(t["order_reviews"]), "order_id"))
    else:
        grain, joined = "customer_id", review_fold(t)
    on, late = F.col("on_time"), ~F.col("on_time")
    folded = joined.groupBy(grain).agg(
        sum0("n_rev").alias("n"),
        sum0(F.when(on, F.col("n_pos"))).alias("perfect"),
        F.sum("s_score").alias("s_all"), sum0("c_score").alias("c_all"),
        F.sum(F.when(on, F.col("s_score"))).alias("s_on"),
        sum0(F.when(on, F.col("c_score"))).alias("c_on"),
        F.sum(F.when(late, F.col("s_score"))).alias("s_late"),
        sum0(F.when(late, F.col("c_score"))).alias("c_late"),
        sum0("n_pos").alias("pos"), sum0("n_neu").alias("neu"), sum0("n_neg").alias("neg"))
    if grain == "estado":
        per_state = folded
    else:
        measures = [c for c in folded.columns if c != "customer_id"]
        per_state = (folded.join(state_of_customer(t["customers"]), "customer_id")
                     .groupBy("estado").agg(*[F.sum(c).alias(c) for c in measures]))
    return (per_state.select(
        "estado",
        F.col("n").alias("total_pedidos"),
        F.col("perfect").alias("pedidos_perfeitos"),
        pct("perfect", "n", 2).alias("perfect_order_pct"),
        rnd(safe_div("s_all", "c_all"), 2).alias("nota_media"),
        rnd(safe_div("s_on", "c_on"), 2).alias("nota_media_no_prazo"),
        rnd(safe_div("s_late", "c_late"), 2).alias("nota_media_atrasado"),
        F.col("pos").alias("avaliacoes_positivas"),
        F.col("neu").alias("avaliacoes_neutras"),
        F.col("neg").alias("avaliacoes_negativas"))
        .orderBy(F.desc_nulls_first("perfect_order_pct"), F.asc_nulls_first("estado")))

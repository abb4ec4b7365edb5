"""K4 - freight cost by state (item grain)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.functions.exprs import rnd, safe_div
from kpiforge.operators.facts import order_fact
from kpiforge.operators.percentile import percentile_from_histogram
from kpiforge.session import cut_lineage_counted

NAME = "freight_cost"


def _items(t: dict[str, DataFrame]) -> DataFrame:
    return t["order_items"].select("order_id", "price", "freight_value")


def build(t: dict[str, DataFrame]) -> DataFrame:
    """Per state: distinct delivered orders; mean and exact median freight per
    item; mean item price; mean of the per-item freight/price ratios in % (zero
    prices drop out of that mean); freight and revenue totals.

    Items meet their orders once. While the rows still lie by order they are
    folded per (order, state, freight), which shrinks an order of very many items
    before anything looks at it as a whole; then the row of the least freight of
    each (order, state) is marked, so that the distinct orders of a state are a
    sum like the others. All is folded on into a (state, freight) histogram,
    materialised once, which gives the means, the totals and the distributed
    exact median. Building the plan runs the job that writes the histogram.
    """
    fact = order_fact(t).select("order_id", "estado")
    # after the join, so that it is neither shuffled nor sorted
    ratio = F.col("freight_value").cast("double") / F.nullif(F.col("price").cast("double"), F.lit(0.0))
    per_order = _items(t).join(fact, "order_id").groupBy("order_id", "estado", "freight_value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("p_sum"), F.count("price").alias("p_cnt"),
        F.sum(ratio).alias("r_sum"), F.count(ratio).alias("r_cnt"))
    least = F.min("freight_value").over(Window.partitionBy("order_id", "estado"))
    marked = per_order.withColumn("first", F.col("freight_value").eqNullSafe(least).cast("int"))
    hist, hist_rows = cut_lineage_counted(
        marked.groupBy("estado", "freight_value").agg(
            F.sum("first").alias("orders"), *[F.sum(c).alias(c) for c in ("n", "p_sum", "p_cnt", "r_sum", "r_cnt")]))
    f = F.col("freight_value")
    per_state = percentile_from_histogram(
        hist.withColumn("v", f.cast("double")), ["estado"], "v", "n", 0.5, "f_median",
        hist_rows=hist_rows,
        extra=[F.sum("orders").alias("total_pedidos"), F.sum(f * F.col("n")).alias("f_sum"),
               F.sum(F.when(f.isNotNull(), F.col("n"))).alias("f_cnt"),
               *[F.sum(c).alias(c) for c in ("p_sum", "p_cnt", "r_sum", "r_cnt")]])
    out = per_state.select(
        "estado",
        "total_pedidos",
        rnd(safe_div("f_sum", "f_cnt"), 2).alias("frete_medio"),
        rnd(F.col("f_median"), 2).alias("frete_mediano"),
        rnd(safe_div("p_sum", "p_cnt"), 2).alias("ticket_medio"),
        rnd(safe_div("r_sum", "r_cnt") * 100.0, 1).alias("proporcao_frete_pct"),
        rnd(F.col("f_sum"), 2).alias("frete_total"),
        rnd(F.col("p_sum"), 2).alias("receita_total"))
    return out.orderBy(F.desc_nulls_first("frete_medio"), F.asc_nulls_first("estado"))

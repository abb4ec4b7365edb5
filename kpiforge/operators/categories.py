"""K7 - top product categories by revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import DELIVERED, OTHER_CATEGORY, rnd, safe_div

NAME = "categorias"


def product_category(t: dict[str, DataFrame]) -> DataFrame:
    """product_id -> English category, else the original name, else 'other'."""
    tr = t["product_category_name_translation"]
    return (t["products"].select("product_id", "product_category_name")
            .join(tr.select("product_category_name", "product_category_name_english"),
                  "product_category_name", "left")
            .select("product_id",
                    F.coalesce("product_category_name_english", "product_category_name",
                               F.lit(OTHER_CATEGORY)).alias("categoria")))


def build(t: dict[str, DataFrame], top: int = 20) -> DataFrame:
    """Items of delivered orders per category: distinct orders, revenue, revenue
    per order, mean freight, and mean freight over mean price in %; the ``top``
    categories by revenue (ties by name)."""
    items = (t["order_items"].select("order_id", "product_id", "price", "freight_value")
             .join(product_category(t), "product_id"))
    delivered = t["orders"].where(F.col("order_status") == DELIVERED).select("order_id")
    per_order = items.join(delivered, "order_id").groupBy("categoria", "order_id").agg(
        F.sum("price").alias("p_sum"), F.count("price").alias("p_cnt"),
        F.sum("freight_value").alias("f_sum"), F.count("freight_value").alias("f_cnt"))
    per_cat = per_order.groupBy("categoria").agg(
        F.count("order_id").alias("total_pedidos"),
        *[F.sum(c).alias(c) for c in ("p_sum", "p_cnt", "f_sum", "f_cnt")])
    out = per_cat.select(
        "categoria", "total_pedidos",
        rnd(F.col("p_sum"), 2).alias("receita_total"),
        rnd(safe_div("p_sum", "total_pedidos"), 2).alias("ticket_medio"),
        rnd(safe_div("f_sum", "f_cnt"), 2).alias("frete_medio"),
        rnd(safe_div(safe_div("f_sum", "f_cnt"), safe_div("p_sum", "p_cnt")) * 100.0, 1)
        .alias("proporcao_frete_pct"))
    return out.orderBy(F.desc_nulls_first("receita_total"), F.asc_nulls_first("categoria")).limit(top)

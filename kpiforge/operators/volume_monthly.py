"""K6 - monthly order volume and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import rnd, safe_div

NAME = "volume_temporal"
MONTH = "purchase_month"  # a column that the stored layout may add, yyyy-MM
DEFAULT_BOUNDS = ("2017-01-01", "2018-09-01")


def build(t: dict[str, DataFrame], start: str = DEFAULT_BOUNDS[0],
          end: str = DEFAULT_BOUNDS[1]) -> DataFrame:
    """Orders of any status purchased in [start, end), left-joined with their
    items: distinct orders, item revenue and revenue per order, per month.
    Orders without items count, with no revenue.

    Items are folded per order before the join (a huge order is one row), and
    the join keeps the order_id partitioning for the distinct-order fold.
    """
    ts = F.col("order_purchase_timestamp")
    orders = t["orders"]
    if MONTH in orders.columns:  # stored by month: other months' files are not read
        orders = orders.where(F.col(MONTH).between(start[:7], end[:7]))
    orders = (orders
              .where((ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz")))
              # month start as a wall-clock timestamp; no session time zone involved
              .select("order_id", F.trunc(F.to_date(ts), "month").cast("timestamp_ntz").alias("mes")))
    items = t["order_items"].groupBy("order_id").agg(F.sum("price").alias("rev"))
    per_order = (orders.join(items, "order_id", "left")
                 .groupBy("mes", "order_id").agg(F.sum("rev").alias("rev")))
    per_month = per_order.groupBy("mes").agg(F.count("order_id").alias("total_pedidos"),
                                             F.sum("rev").alias("rev"))
    return (per_month.select(
        "mes", "total_pedidos",
        rnd(F.col("rev"), 2).alias("receita_total"),
        rnd(safe_div("rev", "total_pedidos"), 2).alias("ticket_medio"))
        .orderBy(F.asc_nulls_last("mes")))

"""K2 - lead time by state, split into approval, dispatch and transit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import days, rnd, safe_div
from kpiforge.operators.facts import STAGES, order_fact
from kpiforge.operators.percentile import percentile_from_histogram
from kpiforge.session import cut_lineage_counted

NAME = "lead_time"


def build(t: dict[str, DataFrame]) -> DataFrame:
    """Delivered orders with all process stamps: mean and exact median of total
    days, mean approval hours, dispatch and transit days, and the dispatch share
    of the total (ratio of the two means, in %).

    The orders' states and durations are materialised once (no shuffle beyond
    the join); means come from a plain per-state aggregate with map-side
    combine, and the exact median searches the same rows by bucket counts, so
    no near-unique duration is ever a shuffle key. Building the plan runs the
    job that writes those rows.
    """
    rows, n = cut_lineage_counted(
        order_fact(t).where(F.col("has_delivery") & F.col("has_stamps"))
        .select("estado", *[f"{k}_us" for k in STAGES], days("total_us").alias("v"), F.lit(1).alias("n")))
    per_state = percentile_from_histogram(
        rows, ["estado"], "v", "n", 0.5, "median_days", hist_rows=n,
        extra=[F.count(F.lit(1)).alias("total_pedidos"),
               *[F.sum(F.col(f"{k}_us").cast("decimal(38,0)")).alias(f"{k}_sum") for k in STAGES],
               *[F.count(f"{k}_us").alias(f"{k}_cnt") for k in STAGES]])

    def mean_of(k, unit):
        return safe_div(f"{k}_sum", f"{k}_cnt") / unit

    day, hour = 86_400_000_000.0, 3_600_000_000.0
    out = per_state.select(
        "estado",
        "total_pedidos",
        rnd(mean_of("total", day), 1).alias("lead_time_total_dias"),
        rnd(F.col("median_days"), 1).alias("lead_time_mediana_dias"),
        rnd(mean_of("approval", hour), 1).alias("tempo_aprovacao_horas"),
        rnd(mean_of("dispatch", day), 1).alias("tempo_despacho_dias"),
        rnd(mean_of("transit", day), 1).alias("tempo_transito_dias"),
        rnd(safe_div(mean_of("dispatch", 1.0), mean_of("total", 1.0)) * 100.0, 1)
        .alias("pct_tempo_despacho"))
    return out.orderBy(F.desc_nulls_first("lead_time_total_dias"), F.asc_nulls_first("estado"))

"""The dashboard's data layer: every page's second-level metrics, computed as
DataFrames from the KPI tables in the catalog (rendering is left to any BI
tool). A page whose KPI table is missing is skipped, like the optional
monthly trend of the overview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiforge.operators import summaries as S
from kpiforge.sources.catalog import ANALYTICS_DB, try_load

# metric name -> (function, KPI tables it reads)
PAGE_METRICS = {
    "sum_overview": (S.sum_overview, ("otd", "lead_time", "perfect_order", "freight_cost")),
    "volume_trend": (S.volume_trend, ("volume_temporal",)),
    "otd_best_worst": (S.otd_best_worst, ("otd",)),
    "otd_mean_delay": (S.otd_mean_delay, ("otd",)),
    "otd_min": (S.otd_min, ("otd",)),
    "otd_named": (S.with_state_name, ("otd",)),
    "top_delay15": (S.top_delay15, ("otd",)),
    "lead_stage_means": (S.lead_stage_means, ("lead_time",)),
    "lead_stage_stack": (S.lead_stage_stack, ("lead_time",)),
    "lead_mean_median": (S.lead_mean_median, ("lead_time",)),
    "top_lead_time15": (S.top_lead_time15, ("lead_time",)),
    "perfect_means": (S.perfect_means, ("perfect_order",)),
    "positive_share": (S.positive_share, ("perfect_order",)),
    "perfect_named": (S.with_state_name, ("perfect_order",)),
    "top_score15": (S.top_score15, ("perfect_order",)),
    "top_volume10": (S.top_volume10, ("perfect_order",)),
    "score_bands_top10": (S.score_bands_top10, ("perfect_order",)),
    "freight_cards": (S.freight_cards, ("freight_cost",)),
    "freight_named": (S.with_state_name, ("freight_cost",)),
    "freight_scatter": (S.freight_scatter, ("freight_cost",)),
    "delay_bands_ordered": (S.delay_bands_ordered, ("delay_vs_satisfaction",)),
    "delay_drop": (S.delay_drop, ("delay_vs_satisfaction",)),
    "scores_long": (S.scores_long, ("delay_vs_satisfaction",)),
    "volume_period": (S.volume_period, ("volume_temporal",)),
    "month_label": (S.month_labels, ("volume_temporal",)),
    "category_cards": (S.category_cards, ("categorias",)),
    "category_labels": (S.category_labels, ("categorias",)),
    "category_share": (S.category_share, ("categorias",)),
    "payment_cards": (S.payment_cards, ("pagamentos",)),
    "payment_share": (S.payment_share, ("pagamentos",)),
    "payment_pct_labels": (S.payment_pct_labels, ("pagamentos",)),
    # whole KPI tables in the order a chart or table of the page shows them
    "otd_sorted": (lambda d: S.sorted_view(d, "otd_pct"), ("otd",)),
    "otd_table": (lambda d: S.named_view(d, "otd_pct"), ("otd",)),
    "lead_table": (lambda d: S.sorted_view(d, "lead_time_total_dias", ascending=False), ("lead_time",)),
    "perfect_table": (lambda d: S.named_view(d, "perfect_order_pct"), ("perfect_order",)),
    "freight_table": (lambda d: S.named_view(d, "frete_medio"), ("freight_cost",)),
    "lead_by_dispatch_share": (lambda d: S.sorted_view(d, "pct_tempo_despacho", ascending=False),
                               ("lead_time",)),
    "perfect_sorted": (lambda d: S.sorted_view(d, "perfect_order_pct"), ("perfect_order",)),
    "freight_by_ratio": (lambda d: S.sorted_view(d, "proporcao_frete_pct", ascending=False),
                         ("freight_cost",)),
    "categories_by_ticket": (lambda d: S.sorted_view(d, "ticket_medio", key="categoria"),
                             ("categorias",)),
    "categories_by_freight_ratio": (lambda d: S.sorted_view(d, "proporcao_frete_pct", ascending=False,
                                                            key="categoria"), ("categorias",)),
    "payments_by_ticket": (lambda d: S.sorted_view(d, "ticket_medio", key="tipo_pagamento"),
                           ("pagamentos",)),
    # the figures on each page's cards, as text
    "overview_labels": (S.overview_labels, ("otd", "lead_time", "perfect_order", "freight_cost")),
    "lead_labels": (S.lead_labels, ("lead_time",)),
    "perfect_labels": (S.perfect_labels, ("perfect_order",)),
    "freight_labels": (S.freight_labels, ("freight_cost",)),
    "delay_labels": (S.delay_labels, ("delay_vs_satisfaction",)),
    "volume_labels": (S.volume_labels, ("volume_temporal",)),
    "payment_labels": (S.payment_labels, ("pagamentos",)),
}


def page_metrics(spark: SparkSession, db: str = ANALYTICS_DB,
                 names: list[str] | None = None) -> dict[str, DataFrame]:
    """name -> metric DataFrame over ``db``'s KPI tables (lazy; nothing is
    collected). Metrics whose KPI tables do not exist are left out."""
    tables: dict[str, DataFrame | None] = {}
    out = {}
    for name in names or list(PAGE_METRICS):
        fn, deps = PAGE_METRICS[name]
        for d in deps:
            if d not in tables:
                tables[d] = try_load(spark, d, db)
        if all(tables[d] is not None for d in deps):
            out[name] = fn(*[tables[d] for d in deps])
    return out

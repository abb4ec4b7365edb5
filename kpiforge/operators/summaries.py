"""Second-level metrics: what the dashboard derives from the KPI tables.

Every function takes KPI DataFrames and returns a DataFrame; nothing is
collected. National figures are unweighted means over the rows of a KPI table
(one row per state), as the dashboard computes them. Card labels keep the
dashboard's formatting (one decimal, half-even, like Python's format spec).

KPI tables are small (one row per state, band, month, method, or top-20
category), so the few whole-table windows below stay bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.functions.display import category_label, count_label, month_label, number_label, pct_label
from kpiforge.functions.exprs import BAND_LABELS, BAND_ON_TIME, BAND_SEVERE, PAYMENT_LABELS, rnd, safe_div
from kpiforge.sources.dimensions import state_names

CARD_DIGITS = 4
CREDIT_CARD = PAYMENT_LABELS["credit_card"]


def _mean(c: str) -> Column:
    return rnd(F.avg(c), CARD_DIGITS)


def money_label(x) -> Column:
    """``f"R${x/1e6:.1f}M"``."""
    return number_label(x / 1e6, 1, "R$", "M")


# ---------------------------------------------------------------- overview
def sum_overview(otd: DataFrame, lt: DataFrame, po: DataFrame, fc: DataFrame) -> DataFrame:
    """Overview cards in one aggregate over the four tables stacked with a tag
    (no join between one-row results)."""
    def part(df, tag, n=None, m=None, v=None):
        return df.select(F.lit(tag).alias("src"),
                         (F.col(n) if n else F.lit(None)).cast("long").alias("n"),
                         (F.col(m) if m else F.lit(None)).cast("double").alias("m"),
                         (F.col(v) if v else F.lit(None)).cast("double").alias("v"))
    stacked = (part(otd, "otd", n="total_pedidos", v="otd_pct")
               .unionByName(part(lt, "lt", v="lead_time_total_dias"))
               .unionByName(part(po, "po", v="perfect_order_pct"))
               .unionByName(part(fc, "fc", m="receita_total", v="frete_medio")))
    src = F.col("src")
    g = stacked.agg(
        F.sum(F.when(src == "otd", F.col("n"))).alias("total_pedidos"),
        rnd(F.sum(F.when(src == "fc", F.col("m"))), 2).alias("receita_total"),
        *[rnd(F.avg(F.when(src == s, F.col("v"))), CARD_DIGITS).alias(a) for s, a in
          (("otd", "otd_medio"), ("lt", "lead_time_medio"), ("po", "perfect_order_medio"),
           ("fc", "frete_medio"))])
    return g.withColumn("receita_label", money_label(F.col("receita_total")))


def volume_trend(vt: DataFrame) -> DataFrame:
    return vt.select("mes", "total_pedidos").orderBy("mes")


# ---------------------------------------------------------------- on-time delivery
def otd_best_worst(otd: DataFrame) -> DataFrame:
    """Best and worst state by OTD %; ties go to the first state by code."""
    d = otd.where(F.col("otd_pct").isNotNull())
    best = F.min(F.struct((-F.col("otd_pct")).alias("k"), F.col("estado").alias("e")))
    worst = F.min(F.struct(F.col("otd_pct").alias("k"), F.col("estado").alias("e")))
    g = d.agg(best.alias("b"), worst.alias("w"))
    return g.select(F.col("b.e").alias("melhor_estado"), (-F.col("b.k")).alias("melhor_otd_pct"),
                    F.col("w.e").alias("pior_estado"), F.col("w.k").alias("pior_otd_pct"))


def otd_mean_delay(otd: DataFrame) -> DataFrame:
    return otd.agg(_mean("atraso_medio_dias").alias("atraso_medio_nacional"))


def otd_min(otd: DataFrame) -> DataFrame:
    """Lower bound of the map colour scale."""
    return otd.agg(F.min("otd_pct").alias("otd_min"))


# ---------------------------------------------------------------- lead time
def lead_stage_means(lt: DataFrame) -> DataFrame:
    return lt.agg(_mean("tempo_aprovacao_horas").alias("aprovacao_media_horas"),
                  _mean("tempo_despacho_dias").alias("despacho_medio_dias"),
                  _mean("tempo_transito_dias").alias("transito_medio_dias"))


def lead_stage_stack(lt: DataFrame) -> DataFrame:
    return (lt.select("estado", "lead_time_total_dias", "tempo_despacho_dias", "tempo_transito_dias")
            .orderBy(F.desc_nulls_last("lead_time_total_dias"), "estado"))


def lead_mean_median(lt: DataFrame) -> DataFrame:
    return (lt.select("estado", "lead_time_total_dias", "lead_time_mediana_dias")
            .orderBy(F.desc_nulls_last("lead_time_total_dias"), "estado"))


# ---------------------------------------------------------------- perfect order
def perfect_means(po: DataFrame) -> DataFrame:
    return po.agg(_mean("perfect_order_pct").alias("perfect_order_medio"),
                  _mean("nota_media").alias("nota_media_nacional"))


def positive_share(po: DataFrame) -> DataFrame:
    """Positive reviews over all banded reviews, in %."""
    allb = F.col("avaliacoes_positivas") + F.col("avaliacoes_neutras") + F.col("avaliacoes_negativas")
    g = po.agg(F.sum("avaliacoes_positivas").alias("positivas"), F.sum(allb).alias("avaliadas"))
    return g.select("positivas", "avaliadas",
                    rnd(safe_div("positivas", "avaliadas") * 100.0, CARD_DIGITS).alias("positivas_pct"))


BAND_COLUMNS = ("avaliacoes_positivas", "avaliacoes_neutras", "avaliacoes_negativas")


def top_volume10(po: DataFrame, k: int = 10) -> DataFrame:
    return (po.select("estado", "total_pedidos", *BAND_COLUMNS)
            .orderBy(F.desc_nulls_last("total_pedidos"), "estado").limit(k))


def score_bands_top10(po: DataFrame) -> DataFrame:
    """Band counts of the ten busiest states, long form (one row per band)."""
    return top_volume10(po).unpivot("estado", list(BAND_COLUMNS), "avaliacao", "quantidade")


# ---------------------------------------------------------------- freight
def freight_cards(fc: DataFrame) -> DataFrame:
    f = F.col("frete_medio")
    top = F.min(F.when(f.isNotNull(), F.struct((-f).alias("k"), F.col("estado").alias("e"))))
    g = fc.agg(_mean("frete_medio").alias("frete_medio_nacional"),
               _mean("proporcao_frete_pct").alias("proporcao_frete_media"), top.alias("t"))
    return g.select("frete_medio_nacional", "proporcao_frete_media",
                    F.col("t.e").alias("estado_maior_frete"), (-F.col("t.k")).alias("maior_frete"))


def freight_scatter(fc: DataFrame) -> DataFrame:
    return fc.select("estado", "ticket_medio", "frete_medio", "proporcao_frete_pct", "total_pedidos")


# ---------------------------------------------------------------- delay x satisfaction
def delay_bands_ordered(ds: DataFrame) -> DataFrame:
    """Bands sorted by their categorical position (unknown labels last)."""
    order = F.array(*[F.lit(b) for b in BAND_LABELS])
    pos = F.array_position(order, F.col("faixa_atraso"))
    return (ds.select("faixa_atraso", F.when(pos == 0, None).otherwise(pos).cast("int").alias("ordem"),
                      "total_pedidos", "nota_media", "pct_negativas")
            .orderBy(F.asc_nulls_last("ordem"), "faixa_atraso"))


def delay_drop(ds: DataFrame) -> DataFrame:
    """Mean score on time, mean score severely late, and the drop between them
    (null when a band is absent)."""
    b = F.col("faixa_atraso")
    g = ds.agg(F.max(F.when(b == BAND_ON_TIME, F.col("nota_media"))).alias("nota_no_prazo"),
               F.max(F.when(b == BAND_SEVERE, F.col("nota_media"))).alias("nota_atraso_grave"))
    return g.withColumn("queda", rnd(F.col("nota_no_prazo") - F.col("nota_atraso_grave"), 2))


def scores_long(ds: DataFrame) -> DataFrame:
    cols = [f"nota_{v}" for v in (5, 4, 3, 2, 1)]
    return ds.unpivot("faixa_atraso", cols, "nota", "quantidade")


# ---------------------------------------------------------------- monthly volume
def volume_period(vt: DataFrame) -> DataFrame:
    g = vt.agg(F.sum("total_pedidos").alias("total_pedidos_periodo"),
               rnd(F.sum("receita_total"), 2).alias("receita_periodo"),
               _mean("ticket_medio").alias("ticket_medio_periodo"))
    return g.withColumn("receita_label", money_label(F.col("receita_periodo")))


def month_labels(vt: DataFrame) -> DataFrame:
    return (vt.select("mes", month_label("mes").alias("mes_label"), "total_pedidos",
                      "receita_total", "ticket_medio").orderBy("mes"))


# ---------------------------------------------------------------- categories
def category_cards(cat: DataFrame) -> DataFrame:
    """Top category (first by revenue, as stored), top-20 revenue, mean ticket."""
    top = F.min(F.struct(F.when(F.col("receita_total").isNull(), 0).otherwise(1).alias("nn"),
                         (-F.col("receita_total")).alias("k"), F.col("categoria").alias("c")))
    g = cat.agg(top.alias("t"),
                rnd(F.sum("receita_total"), 2).alias("receita_top20"),
                _mean("ticket_medio").alias("ticket_medio_geral"))
    return g.select(F.col("t.c").alias("top_categoria"),
                    category_label(F.col("t.c")).alias("top_categoria_label"),
                    "receita_top20", money_label(F.col("receita_top20")).alias("receita_top20_label"),
                    "ticket_medio_geral")


def category_labels(cat: DataFrame) -> DataFrame:
    return cat.select("categoria", category_label("categoria").alias("categoria_label"))


def _share(df: DataFrame, key: str, measure: str) -> DataFrame:
    whole = Window.partitionBy()  # KPI tables are bounded (methods / top-20)
    return df.select(key, measure,
                     rnd(safe_div(F.col(measure), F.sum(measure).over(whole)) * 100.0, CARD_DIGITS)
                     .alias("share_pct"))


def category_share(cat: DataFrame) -> DataFrame:
    return _share(cat, "categoria", "receita_total")


# ---------------------------------------------------------------- payments
def payment_cards(pay: DataFrame) -> DataFrame:
    card = F.col("tipo_pagamento") == CREDIT_CARD
    g = pay.agg(F.sum(F.when(card, F.col("total_transacoes"))).alias("_card"),
                F.sum("total_transacoes").alias("_all"),
                F.max(F.when(card, F.col("parcelas_medias"))).alias("parcelas_medias_credito"),
                _mean("ticket_medio").alias("ticket_medio_geral"))
    return g.select(rnd(safe_div("_card", "_all") * 100.0, CARD_DIGITS).alias("pct_transacoes_cartao"),
                    "parcelas_medias_credito", "ticket_medio_geral")


def payment_share(pay: DataFrame) -> DataFrame:
    return _share(pay, "tipo_pagamento", "total_transacoes")


def payment_pct_labels(pay: DataFrame) -> DataFrame:
    return (pay.select("tipo_pagamento", "pct_parcelado",
                       pct_label(F.col("pct_parcelado")).alias("pct_parcelado_label"))
            .orderBy(F.desc_nulls_last("pct_parcelado"), "tipo_pagamento"))


# ---------------------------------------------------------------- rankings & sorts
def top_lead_time15(lt: DataFrame, k: int = 15) -> DataFrame:
    """``sort ascending, tail(15)``: the 15 largest (missing values sort last, so
    they would be kept), shown ascending."""
    top = (lt.select("estado", "lead_time_total_dias")
           .orderBy(F.desc_nulls_first("lead_time_total_dias"), F.desc("estado")).limit(k))
    return top.orderBy(F.asc_nulls_last("lead_time_total_dias"), "estado")


def top_delay15(otd: DataFrame, k: int = 15) -> DataFrame:
    return (otd.select("estado", "atraso_medio_dias")
            .orderBy(F.desc_nulls_last("atraso_medio_dias"), "estado").limit(k))


def top_score15(po: DataFrame, k: int = 15) -> DataFrame:
    return (po.select("estado", "nota_media_no_prazo", "nota_media_atrasado")
            .orderBy(F.desc_nulls_last("nota_media_no_prazo"), "estado").limit(k))


def sorted_view(df: DataFrame, column: str, ascending: bool = True, key: str = "estado") -> DataFrame:
    """Presentation sort of a whole KPI table (missing values last, key tie-break)."""
    c = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return df.orderBy(c, key)


def with_state_name(df: DataFrame) -> DataFrame:
    """KPI rows with the state's name (unknown codes get null). The 27-row
    dimension has a fixed size, so it is broadcast explicitly."""
    return df.join(F.broadcast(state_names(df.sparkSession)), "estado", "left")


def named_view(df: DataFrame, column: str) -> DataFrame:
    """A page's full table: the KPI rows with the state's name, largest first."""
    return sorted_view(with_state_name(df), column, ascending=False)


# ---------------------------------------------------------------- card labels
def _labels(values: DataFrame, **labels: Column) -> DataFrame:
    return values.select(*[c.alias(name) for name, c in labels.items()])


def overview_labels(otd: DataFrame, lt: DataFrame, po: DataFrame, fc: DataFrame) -> DataFrame:
    return _labels(
        sum_overview(otd, lt, po, fc), pedidos=count_label("total_pedidos"), receita=F.col("receita_label"),
        otd=pct_label("otd_medio"), lead_time=number_label("lead_time_medio", 1, suffix="d"),
        perfect_order=pct_label("perfect_order_medio"), frete=number_label("frete_medio", 0, "R$"))


def lead_labels(lt: DataFrame) -> DataFrame:
    return _labels(lead_stage_means(lt), aprovacao=number_label("aprovacao_media_horas", 1, suffix="h"),
                   despacho=number_label("despacho_medio_dias", 1, suffix="d"),
                   transito=number_label("transito_medio_dias", 1, suffix="d"))


def perfect_labels(po: DataFrame) -> DataFrame:
    rated = F.col("avaliacoes_positivas") + F.col("avaliacoes_neutras") + F.col("avaliacoes_negativas")
    g = po.agg(_mean("perfect_order_pct").alias("p"), _mean("nota_media").alias("n"),
               rnd(safe_div(F.sum("avaliacoes_positivas"), F.sum(rated)) * 100.0, CARD_DIGITS).alias("s"))
    return _labels(g, perfect_order=pct_label("p"), nota=number_label("n", 2), positivas=pct_label("s"))


def freight_labels(fc: DataFrame) -> DataFrame:
    return _labels(freight_cards(fc), frete=number_label("frete_medio_nacional", 2, "R$"),
                   proporcao=pct_label("proporcao_frete_media"), maior_frete=number_label("maior_frete", 2, "R$"))


def delay_labels(dv: DataFrame) -> DataFrame:
    return _labels(delay_drop(dv), no_prazo=number_label("nota_no_prazo", 2),
                   atraso_grave=number_label("nota_atraso_grave", 2), queda=number_label("queda", 2, "-"))


def volume_labels(vt: DataFrame) -> DataFrame:
    return _labels(volume_period(vt), pedidos=count_label("total_pedidos_periodo"), receita=F.col("receita_label"),
                   ticket=number_label("ticket_medio_periodo", 0, "R$"))


def payment_labels(pay: DataFrame) -> DataFrame:
    return _labels(payment_cards(pay), cartao=pct_label("pct_transacoes_cartao"),
                   parcelas=number_label("parcelas_medias_credito", 1, suffix="x"),
                   ticket=number_label("ticket_medio_geral", 0, "R$"))

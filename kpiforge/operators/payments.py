"""K8 - payment methods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import EXCLUDED_PAYMENT_TYPE, payment_label, pct, rnd, safe_div

NAME = "pagamentos"


def build(t: dict[str, DataFrame]) -> DataFrame:
    """Payments except type 'not_defined' (null types drop too), grouped by the
    display label: transactions, total and mean value, mean instalments over
    instalment plans (> 1), number and % of instalment plans."""
    p = t["order_payments"].where(F.col("payment_type") != EXCLUDED_PAYMENT_TYPE).select(
        payment_label().alias("tipo_pagamento"), "payment_installments", "payment_value")
    inst = F.col("payment_installments")
    g = p.groupBy("tipo_pagamento").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("payment_value").alias("v_sum"), F.count("payment_value").alias("v_cnt"),
        F.sum(F.when(inst > 1, inst)).alias("i_sum"), F.count_if(inst > 1).alias("i_cnt"))
    return (g.select(
        "tipo_pagamento",
        F.col("n").alias("total_transacoes"),
        rnd(F.col("v_sum"), 2).alias("valor_total"),
        rnd(safe_div("v_sum", "v_cnt"), 2).alias("ticket_medio"),
        rnd(safe_div("i_sum", "i_cnt"), 1).alias("parcelas_medias"),
        F.col("i_cnt").alias("transacoes_parceladas"),
        pct("i_cnt", "n", 1).alias("pct_parcelado"))
        .orderBy(F.desc_nulls_first("total_transacoes"), F.asc_nulls_first("tipo_pagamento")))

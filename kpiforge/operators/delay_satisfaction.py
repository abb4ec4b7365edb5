"""K5 - review scores by delivery-delay band (order x review grain)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.exprs import band_rank, pct, rnd, safe_div
from kpiforge.operators.facts import review_fold

NAME = "delay_vs_satisfaction"


def build(t: dict[str, DataFrame]) -> DataFrame:
    """Each delivered order x review row is banded by lateness (on time; up to
    3 days; up to 7 days; more, or unknown estimate); per band: rows, mean
    score, count per score and % of scores <= 2. Bands in their fixed order."""
    per_band = review_fold(t).groupBy("faixa_atraso").agg(
        F.sum("n_rev").alias("n"), F.sum("s_score").alias("s"), F.sum("c_score").alias("c"),
        F.sum("n_neg").alias("neg"), *[F.sum(f"n_{v}").alias(f"nota_{v}") for v in (5, 4, 3, 2, 1)])
    return (per_band.select(
        "faixa_atraso",
        F.col("n").alias("total_pedidos"),
        rnd(safe_div("s", "c"), 2).alias("nota_media"),
        *[F.col(f"nota_{v}") for v in (5, 4, 3, 2, 1)],
        pct("neg", "n", 1).alias("pct_negativas"))
        .orderBy(band_rank("faixa_atraso")))

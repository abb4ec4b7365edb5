"""Second-level metrics on hand-made KPI tables: ties, absent rows, ordering."""

import datetime as dt

import pytest

from kpiforge.operators import summaries as S

OTD = "estado string, total_pedidos long, otd_pct double, atraso_medio_dias double"


def test_best_worst_ties_go_to_first_state(spark):
    otd = spark.createDataFrame([("RJ", 10, 90.0, 2.0), ("AC", 5, 90.0, None), ("SP", 20, 80.0, 1.0),
                                 ("BA", 3, 80.0, 3.0)], OTD)
    r = S.otd_best_worst(otd).first()
    assert (r.melhor_estado, r.melhor_otd_pct, r.pior_estado, r.pior_otd_pct) == ("AC", 90.0, "BA", 80.0)
    assert S.otd_mean_delay(otd).first()[0] == 2.0          # unweighted, nulls skipped
    assert S.otd_min(otd).first()[0] == 80.0
    top = [r.estado for r in S.top_delay15(otd).collect()]
    assert top == ["BA", "RJ", "SP", "AC"]                  # missing values last


def test_delay_drop_with_absent_band(spark):
    ds = spark.createDataFrame([("No prazo", 4.25), ("Atraso leve (1-3 dias)", 3.5)],
                               "faixa_atraso string, nota_media double")
    r = S.delay_drop(ds).first()
    assert (r.nota_no_prazo, r.nota_atraso_grave, r.queda) == (4.25, None, None)


def test_payment_cards_without_credit_card(spark):
    pay = spark.createDataFrame([("Boleto", 3, 1.0, 100.0), ("pix", 1, None, 50.0)],
                                "tipo_pagamento string, total_transacoes long, parcelas_medias double, "
                                "ticket_medio double")
    r = S.payment_cards(pay).first()
    assert r.pct_transacoes_cartao is None and r.parcelas_medias_credito is None  # no card row
    assert r.ticket_medio_geral == 75.0
    shares = {x.tipo_pagamento: x.share_pct for x in S.payment_share(pay).collect()}
    assert shares == {"Boleto": 75.0, "pix": 25.0}


def test_category_cards_first_as_stored(spark):
    cat = spark.createDataFrame([("cama_mesa_banho", 1_250_000.0, 100.0), ("2nd_hand", 1_250_000.0, 50.0),
                                 ("beleza", None, 10.0)],
                                "categoria string, receita_total double, ticket_medio double")
    r = S.category_cards(cat).first()
    # a null revenue sorts first in the stored (descending) order
    assert r.top_categoria == "beleza" and r.top_categoria_label == "Beleza"
    assert r.receita_top20 == 2_500_000.0 and r.receita_top20_label == "R$2.5M"
    labels = {x.categoria: x.categoria_label for x in S.category_labels(cat).collect()}
    assert labels["2nd_hand"] == "2Nd Hand" == "2nd_hand".replace("_", " ").title()


def test_month_labels_and_period(spark):
    vt = spark.createDataFrame([(dt.datetime(2017, 1, 1), 10, 100.0, 10.0),
                                (dt.datetime(2017, 2, 1), 30, None, None)],
                               "mes timestamp_ntz, total_pedidos long, receita_total double, ticket_medio double")
    assert [r.mes_label for r in S.month_labels(vt).collect()] == ["Jan/2017", "Feb/2017"]
    r = S.volume_period(vt).first()
    assert (r.total_pedidos_periodo, r.receita_periodo, r.ticket_medio_periodo) == (40, 100.0, 10.0)
    assert r.receita_label == "R$0.0M"


def test_top_lead_time_keeps_the_largest(spark):
    lt = spark.createDataFrame([(f"S{i:02d}", float(i % 7)) for i in range(20)],
                               "estado string, lead_time_total_dias double")
    got = [(r.estado, r.lead_time_total_dias) for r in S.top_lead_time15(lt).collect()]
    assert len(got) == 15 and got == sorted(got, key=lambda x: (x[1], x[0]))
    assert min(v for _, v in got) >= 1.0


@pytest.mark.parametrize("fn", [S.score_bands_top10, S.top_volume10])
def test_band_long_form(spark, fn):
    po = spark.createDataFrame([(f"S{i}", 100 - i, 5, 3, 2) for i in range(12)],
                               "estado string, total_pedidos long, avaliacoes_positivas long, "
                               "avaliacoes_neutras long, avaliacoes_negativas long")
    rows = fn(po).collect()
    assert len(rows) == (30 if fn is S.score_bands_top10 else 10)

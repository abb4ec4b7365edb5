"""Hand-computed expectations at the boundaries of every KPI rule."""

import pytest

from kpiforge.operators import (categories, delay_satisfaction, freight_cost, lead_time, otd,
                                payments, perfect_order, volume_monthly)
from tests.helpers import as_dicts, order, tables

EST = "2018-01-10 00:00:00"
CASES = [
    # oid, delivered, score, status, estimate
    ("equal", "2018-01-10 00:00:00", 4, "delivered", EST),
    ("late1s", "2018-01-10 00:00:01", 5, "delivered", EST),
    ("late3d", "2018-01-13 00:00:00", 3, "delivered", EST),
    ("late3d12h", "2018-01-13 12:00:00", 2, "delivered", EST),
    ("late7d", "2018-01-17 00:00:00", 2, "delivered", EST),
    ("late7d1s", "2018-01-17 00:00:01", 1, "delivered", EST),
    ("noest", "2018-01-10 00:00:00", 5, "delivered", None),
    ("nodelivery", None, 5, "delivered", EST),
    ("shipped", "2018-01-09 00:00:00", 5, "shipped", EST),
]


@pytest.fixture(scope="module")
def t(spark):
    orders = [order(o, est, d, status=s) for o, d, _, s, est in CASES]
    orders.append(order("tworev", EST, "2018-01-09 00:00:00"))
    orders.append(order("nullscore", EST, "2018-01-09 00:00:00"))
    orders.append(order("other_state", EST, "2018-01-09 00:00:00", customer="c2"))
    reviews = [(o, sc) for o, _, sc, _, _ in CASES]
    reviews += [("tworev", 5), ("tworev", 1), ("nullscore", None), ("other_state", 4)]
    return tables(spark, orders=orders, customers=[("c1", "SP"), ("c2", "RJ")], reviews=reviews)


def test_otd_boundaries(t):
    r = as_dicts(otd.build(t), "estado")
    sp = r["SP"]
    # delivered with a delivery stamp: equal, 5 late, noest, tworev, nullscore
    assert sp["total_pedidos"] == 9
    assert sp["pedidos_no_prazo"] == 3          # equal, tworev, nullscore
    assert sp["pedidos_atrasados"] == 5         # noest is neither
    assert sp["otd_pct"] == pytest.approx(33.33)
    # mean of 1s, 3d, 3.5d, 7d, 7d+1s in days
    assert sp["atraso_medio_dias"] == 4.1
    assert sp["pior_atraso_dias"] == 7.0
    rj = r["RJ"]
    assert rj["otd_pct"] == 100.0
    assert rj["atraso_medio_dias"] is None and rj["pior_atraso_dias"] is None


def test_delay_bands(t):
    r = as_dicts(delay_satisfaction.build(t), "faixa_atraso")
    assert r["No prazo"]["total_pedidos"] == 5       # equal, tworev x2, nullscore, other_state
    assert r["Atraso leve (1-3 dias)"]["total_pedidos"] == 2   # 1 s and exactly 3 d
    assert r["Atraso moderado (4-7 dias)"]["total_pedidos"] == 2  # 3.5 d and exactly 7 d
    assert r["Atraso grave (8+ dias)"]["total_pedidos"] == 2   # 7 d + 1 s and no estimate
    on = r["No prazo"]
    assert (on["nota_5"], on["nota_4"], on["nota_1"]) == (1, 2, 1)
    assert on["nota_media"] == pytest.approx((4 + 5 + 1 + 4) / 4)
    assert on["pct_negativas"] == 20.0
    ordered = [row["faixa_atraso"] for row in delay_satisfaction.build(t).collect()]
    assert ordered == ["No prazo", "Atraso leve (1-3 dias)", "Atraso moderado (4-7 dias)",
                       "Atraso grave (8+ dias)"]


def test_perfect_order_grain(t):
    sp = as_dicts(perfect_order.build(t), "estado")["SP"]
    # review rows of delivered orders with delivery stamp (SP): 7 + tworev x2 + nullscore
    assert sp["total_pedidos"] == 10
    assert sp["pedidos_perfeitos"] == 2        # equal (4) and tworev's 5
    assert sp["avaliacoes_positivas"] + sp["avaliacoes_neutras"] + sp["avaliacoes_negativas"] == 9
    assert sp["nota_media_no_prazo"] == pytest.approx(round((4 + 5 + 1) / 3, 2))
    assert sp["nota_media_atrasado"] == pytest.approx(round((5 + 3 + 2 + 2 + 1) / 5, 2))


def test_lead_time_excludes_missing_stamps(spark):
    orders = [order("a", EST, "2018-01-05 00:00:00"), order("b", EST, "2018-01-07 00:00:00"),
              order("c", EST, "2018-01-09 00:00:00", approved=None)]
    t = tables(spark, orders=orders, customers=[("c1", "SP")])
    sp = as_dicts(lead_time.build(t), "estado")["SP"]
    assert sp["total_pedidos"] == 2
    assert sp["lead_time_total_dias"] == 5.0 and sp["lead_time_mediana_dias"] == 5.0
    assert sp["tempo_aprovacao_horas"] == 1.0
    # dispatch = 2 d - 1 h; share of total = mean dispatch / mean total
    assert sp["pct_tempo_despacho"] == round((2 - 1 / 24) / 5 * 100, 1)


def test_freight_mean_median_ratios(spark):
    orders = [order("o1", EST, "2018-01-05 00:00:00"), order("o2", EST, "2018-01-05 00:00:00")]
    items = [("o1", "p1", 10, 1), ("o1", "p2", 20, 4), ("o2", "p3", 0, 5)]
    t = tables(spark, orders=orders, customers=[("c1", "SP")], items=items)
    sp = as_dicts(freight_cost.build(t), "estado")["SP"]
    assert sp["total_pedidos"] == 2
    assert sp["frete_medio"] == 3.33 and sp["frete_mediano"] == 4.0
    assert sp["ticket_medio"] == 10.0
    assert sp["proporcao_frete_pct"] == 15.0        # mean of 10 % and 20 %; zero price drops out
    assert sp["frete_total"] == 10.0 and sp["receita_total"] == 30.0


def test_freight_median_rounds_half_up(spark):
    orders = [order("o1", EST, "2018-01-05 00:00:00")]
    t = tables(spark, orders=orders, customers=[("c1", "SP")],
               items=[("o1", "p1", 10, 1.01), ("o1", "p2", 10, 1.02)])
    assert as_dicts(freight_cost.build(t), "estado")["SP"]["frete_mediano"] == 1.02


def test_categories_labels_and_ratio_of_means(spark):
    orders = [order("o1", EST, "2018-01-05 00:00:00"), order("o2", EST, None, status="shipped")]
    items = [("o1", "p1", 10, 1), ("o1", "p2", 20, 4), ("o1", "p3", 0, 5), ("o2", "p1", 99, 9)]
    products = [("p1", "beleza"), ("p2", None), ("p3", "desconhecida")]
    t = tables(spark, orders=orders, customers=[("c1", "SP")], items=items, products=products,
               translation=[("beleza", "health_beauty")])
    r = as_dicts(categories.build(t), "categoria")
    assert set(r) == {"health_beauty", "other", "desconhecida"}
    assert r["health_beauty"]["receita_total"] == 10.0   # shipped order excluded
    assert r["desconhecida"]["proporcao_frete_pct"] is None  # mean price 0 -> no ratio


def test_category_ratio_of_means(spark):
    orders = [order("o1", EST, "2018-01-05 00:00:00")]
    items = [("o1", "p1", 10, 1), ("o1", "p2", 20, 4), ("o1", "p3", 0, 5)]
    products = [("p1", "x"), ("p2", "x"), ("p3", "x")]
    t = tables(spark, orders=orders, customers=[("c1", "SP")], items=items, products=products)
    x = as_dicts(categories.build(t), "categoria")["x"]
    assert x["total_pedidos"] == 1 and x["ticket_medio"] == 30.0
    assert x["frete_medio"] == 3.33 and x["proporcao_frete_pct"] == 33.3


def test_payments_rules(spark):
    pays = [("boleto", 1, 10), ("boleto", 1, 20), ("credit_card", 3, 30), ("credit_card", 1, 10),
            (None, 2, 5), ("not_defined", 1, 5), ("pix", 1, 7)]
    r = as_dicts(payments.build(tables(spark, payments=pays)), "tipo_pagamento")
    assert set(r) == {"Boleto", "Cartão de Crédito", "pix"}
    assert r["Boleto"]["parcelas_medias"] is None and r["Boleto"]["pct_parcelado"] == 0.0
    cc = r["Cartão de Crédito"]
    assert (cc["total_transacoes"], cc["valor_total"], cc["ticket_medio"]) == (2, 40.0, 20.0)
    assert (cc["parcelas_medias"], cc["transacoes_parceladas"], cc["pct_parcelado"]) == (3.0, 1, 50.0)


def test_monthly_bounds_and_itemless_orders(spark):
    orders = [order("in", EST, None, status="shipped", purchase="2018-08-31 23:59:59"),
              order("out", EST, None, status="shipped", purchase="2018-09-01 00:00:00"),
              order("jan", EST, None, status="canceled", purchase="2018-01-15 10:00:00")]
    items = [("jan", "p1", 10, 1), ("jan", "p2", 5, 1)]
    r = volume_monthly.build(tables(spark, orders=orders, items=items)).collect()
    assert [(x["mes"].month, x["total_pedidos"], x["receita_total"], x["ticket_medio"]) for x in r] == [
        (1, 1, 15.0, 15.0), (8, 1, None, None)]

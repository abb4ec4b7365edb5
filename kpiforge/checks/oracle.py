"""Independent DuckDB formulation of every registered query.

The state KPIs are aggregates over one order-level relation with flags and
durations (``order_facts``), its item and review grains and plain SQL
aggregates, unlike the pre-folded Spark plans. Labels, bands and state names
are written out here, so that the comparison sees a wrong one. Tables: the
driver's parquet views (orders, customer, nation, lineitem, part) mapped by
the same adapter rules as ``kpiforge.sources.driver_tables``.
"""

from __future__ import annotations

def RND(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def US(a: str, b: str) -> str:
    return f"CAST(date_diff('microsecond', {b}, {a}) AS DOUBLE)"


def DAYS(a: str, b: str) -> str:
    return f"({US(a, b)} / CAST(86400000000 AS DOUBLE))"


def HOURS(a: str, b: str) -> str:
    return f"({US(a, b)} / CAST(3600000000 AS DOUBLE))"


def PCT(num: str, den: str, n: int) -> str:
    return RND(f"CAST({num} AS DOUBLE) / {den} * 100", n)


def _h(expr: str) -> str:
    return f"o_orderdate + to_hours(CAST({expr} AS INTEGER))"


ADAPTERS = {
    "r_orders": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
       ELSE 'processing' END AS order_status,
  {_h('(o_orderkey * 7) % 24')} AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL
       ELSE {_h('(o_orderkey * 7) % 24 + (o_orderkey * 13) % 72')} END AS order_approved_at,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL
       ELSE {_h('(o_orderkey * 7) % 24 + 72 + (o_orderkey * 17) % 240')} END AS order_delivered_carrier_date,
  CASE WHEN o_orderkey % 61 = 0 THEN NULL
       ELSE {_h('(o_orderkey * 7) % 24 + 312 + (o_orderkey * 31) % 500')} END AS order_delivered_customer_date,
  CASE WHEN o_orderkey % 67 = 0 THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(576) END AS order_estimated_delivery_date
FROM orders""",
    "r_customers": """
SELECT c.c_custkey AS customer_id, n.n_name AS customer_state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "r_items": """
SELECT l_orderkey AS order_id, l_partkey AS product_id,
  CAST(CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN CAST(0 AS DOUBLE)
            ELSE l_extendedprice END AS DECIMAL(12,2)) AS price,
  CAST(ROUND(CAST(l_extendedprice * l_tax AS DECIMAL(38,10)), 2) AS DECIMAL(12,2)) AS freight_value
FROM lineitem""",
    "r_reviews": """
SELECT o_orderkey AS order_id,
  CAST(CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE (o_orderkey * 11) % 5 + 1 END AS INTEGER) AS review_score
FROM orders WHERE o_orderkey % 13 <> 0
UNION ALL
SELECT o_orderkey AS order_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS review_score
FROM orders WHERE o_orderkey % 20 = 0""",
    "r_payments": """
SELECT order_id, payment_type,
  CAST(CASE WHEN payment_type IN ('credit_card', 'voucher') THEN order_id % 12 + 1 ELSE 1 END AS INTEGER)
    AS payment_installments,
  payment_value
FROM (SELECT o_orderkey AS order_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
          WHEN '3-MEDIUM' THEN 'voucher' WHEN '4-NOT SPECIFIED' THEN 'not_defined'
          WHEN '5-LOW' THEN 'debit_card' END AS payment_type,
        CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
      FROM orders) p""",
    "r_products": """
SELECT p_partkey AS product_id,
  CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END AS product_category_name
FROM part""",
    "r_translation": """
SELECT product_category_name, 'en_' || product_category_name AS product_category_name_english
FROM (SELECT DISTINCT p_brand AS product_category_name FROM part
      WHERE p_size % 2 = 1 AND p_brand LIKE '%3') b""",
}

# Order grain: what the KPIs ask of a delivered order, with durations in days.
FACTS = {
    "order_facts": f"""
SELECT o.order_id, o.customer_id, c.customer_state AS estado,
  o.order_delivered_customer_date IS NOT NULL AS arrived,
  o.order_approved_at IS NOT NULL AND o.order_carrier IS NOT NULL AS stamped,
  o.order_delivered_customer_date <= o.order_estimated_delivery_date AS on_time,
  o.order_delivered_customer_date > o.order_estimated_delivery_date AS late,
  {DAYS('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS overdue,
  {DAYS('o.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS total_days,
  {HOURS('o.order_approved_at', 'o.order_purchase_timestamp')} AS approval_hours,
  {DAYS('o.order_carrier', 'o.order_approved_at')} AS dispatch_days,
  {DAYS('o.order_delivered_customer_date', 'o.order_carrier')} AS transit_days
FROM (SELECT *, order_delivered_carrier_date AS order_carrier FROM r_orders) o
JOIN r_customers c USING (customer_id)
WHERE o.order_status = 'delivered'""",
}

KPI = {
    "k_otd": f"""
WITH per_state AS (
  SELECT estado, count(*) AS n, sum(CASE WHEN on_time THEN 1 ELSE 0 END) AS good,
    sum(CASE WHEN late THEN 1 ELSE 0 END) AS bad,
    avg(CASE WHEN late THEN overdue END) AS mean_late, max(CASE WHEN late THEN overdue END) AS worst
  FROM order_facts WHERE arrived GROUP BY estado)
SELECT estado, n AS total_pedidos, CAST(good AS BIGINT) AS pedidos_no_prazo, CAST(bad AS BIGINT) AS pedidos_atrasados,
  {PCT("good", "n", 2)} AS otd_pct, {RND("mean_late", 1)} AS atraso_medio_dias, {RND("worst", 1)} AS pior_atraso_dias
FROM per_state ORDER BY otd_pct DESC NULLS FIRST, estado""",
    "k_lead_time": f"""
WITH per_state AS (
  SELECT estado, count(*) AS n, avg(total_days) AS total, quantile_cont(total_days, 0.5) AS middle,
    avg(approval_hours) AS approval, avg(dispatch_days) AS dispatch, avg(transit_days) AS transit
  FROM order_facts WHERE arrived AND stamped GROUP BY estado)
SELECT estado, n AS total_pedidos, {RND("total", 1)} AS lead_time_total_dias,
  {RND("middle", 1)} AS lead_time_mediana_dias, {RND("approval", 1)} AS tempo_aprovacao_horas,
  {RND("dispatch", 1)} AS tempo_despacho_dias, {RND("transit", 1)} AS tempo_transito_dias,
  {RND("CASE WHEN total <> 0 THEN dispatch / total * 100 END", 1)} AS pct_tempo_despacho
FROM per_state ORDER BY lead_time_total_dias DESC NULLS FIRST, estado""",
    "k_perfect_order": f"""
WITH rated AS (
  SELECT f.estado, f.on_time, f.late, r.review_score AS score
  FROM r_reviews r JOIN order_facts f USING (order_id) WHERE f.arrived),
per_state AS (
  SELECT estado, count(*) AS n, sum(CASE WHEN on_time AND score >= 4 THEN 1 ELSE 0 END) AS perfect,
    avg(score) AS every, avg(CASE WHEN on_time THEN score END) AS good, avg(CASE WHEN late THEN score END) AS bad,
    sum(CASE WHEN score >= 4 THEN 1 ELSE 0 END) AS high, sum(CASE WHEN score = 3 THEN 1 ELSE 0 END) AS middle,
    sum(CASE WHEN score <= 2 THEN 1 ELSE 0 END) AS low
  FROM rated GROUP BY estado)
SELECT estado, n AS total_pedidos, CAST(perfect AS BIGINT) AS pedidos_perfeitos,
  {PCT("perfect", "n", 2)} AS perfect_order_pct, {RND("every", 2)} AS nota_media,
  {RND("good", 2)} AS nota_media_no_prazo, {RND("bad", 2)} AS nota_media_atrasado,
  CAST(high AS BIGINT) AS avaliacoes_positivas, CAST(middle AS BIGINT) AS avaliacoes_neutras,
  CAST(low AS BIGINT) AS avaliacoes_negativas
FROM per_state ORDER BY perfect_order_pct DESC NULLS FIRST, estado""",
    "k_freight_cost": f"""
WITH sold AS (
  SELECT f.estado, f.order_id, CAST(i.freight_value AS DOUBLE) AS freight, CAST(i.price AS DOUBLE) AS price,
    i.freight_value AS exact_freight, i.price AS exact_price
  FROM r_items i JOIN order_facts f USING (order_id)),
per_state AS (
  SELECT estado, count(DISTINCT order_id) AS n, avg(freight) AS mean_freight, quantile_cont(freight, 0.5) AS middle,
    avg(price) AS ticket, avg(CASE WHEN price <> 0 THEN freight / price END) AS ratio,
    sum(exact_freight) AS all_freight, sum(exact_price) AS revenue
  FROM sold GROUP BY estado)
SELECT estado, n AS total_pedidos, {RND("mean_freight", 2)} AS frete_medio, {RND("middle", 2)} AS frete_mediano,
  {RND("ticket", 2)} AS ticket_medio, {RND("ratio * 100", 1)} AS proporcao_frete_pct,
  {RND("all_freight", 2)} AS frete_total, {RND("revenue", 2)} AS receita_total
FROM per_state ORDER BY frete_medio DESC NULLS FIRST, estado""",
    "k_delay_vs_satisfaction": f"""
WITH arrivals AS (
  SELECT order_id, order_delivered_customer_date <= order_estimated_delivery_date AS on_time,
    {DAYS('order_delivered_customer_date', 'order_estimated_delivery_date')} AS overdue
  FROM r_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL),
bands(rank, faixa_atraso) AS (VALUES (1, 'No prazo'), (2, 'Atraso leve (1-3 dias)'),
  (3, 'Atraso moderado (4-7 dias)'), (4, 'Atraso grave (8+ dias)')),
rated AS (
  SELECT r.review_score AS score,
    CASE WHEN on_time THEN 1 WHEN overdue <= 3 THEN 2 WHEN overdue <= 7 THEN 3 ELSE 4 END AS rank
  FROM arrivals JOIN r_reviews r USING (order_id)),
per_band AS (
  SELECT rank, count(*) AS n, avg(score) AS mean_score, sum(CASE WHEN score <= 2 THEN 1 ELSE 0 END) AS low,
    {", ".join(f"CAST(sum(CASE WHEN score = {v} THEN 1 ELSE 0 END) AS BIGINT) AS nota_{v}" for v in (5, 4, 3, 2, 1))}
  FROM rated GROUP BY rank)
SELECT faixa_atraso, n AS total_pedidos, {RND("mean_score", 2)} AS nota_media,
  nota_5, nota_4, nota_3, nota_2, nota_1, {PCT("low", "n", 1)} AS pct_negativas
FROM per_band JOIN bands USING (rank) ORDER BY rank""",
    "k_volume_monthly": f"""
WITH months AS (
  SELECT order_id, CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS mes FROM r_orders
  WHERE order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND order_purchase_timestamp < TIMESTAMP '1998-09-01'),
revenue AS (SELECT order_id, sum(price) AS paid FROM r_items GROUP BY order_id),
per_month AS (
  SELECT mes, count(DISTINCT m.order_id) AS n, sum(paid) AS paid
  FROM months m LEFT JOIN revenue USING (order_id) GROUP BY mes)
SELECT mes, n AS total_pedidos, {RND("paid", 2)} AS receita_total,
  {RND("CAST(paid AS DOUBLE) / n", 2)} AS ticket_medio
FROM per_month ORDER BY mes""",
    "k_category_top20": f"""
WITH named AS (
  SELECT p.product_id, coalesce(t.product_category_name_english, p.product_category_name, 'other') AS categoria
  FROM r_products p LEFT JOIN r_translation t USING (product_category_name)),
sold AS (
  SELECT categoria, o.order_id, i.price, CAST(i.price AS DOUBLE) AS p, CAST(i.freight_value AS DOUBLE) AS f
  FROM named JOIN r_items i USING (product_id)
  JOIN r_orders o ON o.order_id = i.order_id AND o.order_status = 'delivered'),
per_category AS (
  SELECT categoria, count(DISTINCT order_id) AS n, sum(price) AS paid, avg(f) AS freight, avg(p) AS ticket
  FROM sold GROUP BY categoria)
SELECT categoria, n AS total_pedidos, {RND("paid", 2)} AS receita_total, {RND("CAST(paid AS DOUBLE) / n", 2)} AS ticket_medio,
  {RND("freight", 2)} AS frete_medio, {RND("CASE WHEN ticket <> 0 THEN freight / ticket * 100 END", 1)} AS proporcao_frete_pct
FROM per_category ORDER BY receita_total DESC NULLS FIRST, categoria LIMIT 20""",
    "k_payments": f"""
WITH methods(code, label) AS (VALUES ('credit_card', 'Cartão de Crédito'), ('boleto', 'Boleto'),
  ('voucher', 'Voucher'), ('debit_card', 'Cartão de Débito')),
paid AS (
  SELECT coalesce(label, payment_type) AS tipo_pagamento, payment_value, payment_installments AS k
  FROM r_payments LEFT JOIN methods ON code = payment_type
  WHERE payment_type IS NOT NULL AND payment_type <> 'not_defined'),
per_method AS (
  SELECT tipo_pagamento, count(*) AS n, sum(payment_value) AS total, avg(CAST(payment_value AS DOUBLE)) AS ticket,
    avg(CASE WHEN k > 1 THEN k END) AS mean_k, sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) AS split
  FROM paid GROUP BY tipo_pagamento)
SELECT tipo_pagamento, n AS total_transacoes, {RND("total", 2)} AS valor_total, {RND("ticket", 2)} AS ticket_medio,
  {RND("mean_k", 1)} AS parcelas_medias, CAST(split AS BIGINT) AS transacoes_parceladas,
  {PCT("split", "n", 1)} AS pct_parcelado
FROM per_method ORDER BY total_transacoes DESC NULLS FIRST, tipo_pagamento""",
}

# -------------------------------------------------------------- second level
M = 4  # CARD_DIGITS


def _label_money(x: str) -> str:
    return f"('R$' || format('{{:.1f}}', {x} / 1e6) || 'M')"


def _title(x: str) -> str:
    """Python str.title(): upper after a non-cased character, else lower."""
    chars = f"string_split({x}, '')"
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform({chars}, lambda ch, i: "
            f"CASE WHEN i = 1 OR NOT regexp_matches({chars}[i - 1], '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]') "
            f"THEN upper(ch) ELSE lower(ch) END), '') END")


SECOND = {
    "sum_overview": (["k_otd", "k_lead_time", "k_perfect_order", "k_freight_cost"], f"""
SELECT total_pedidos, receita_total, otd_medio, lead_time_medio, perfect_order_medio, frete_medio,
  {_label_money('receita_total')} AS receita_label
FROM (SELECT
  (SELECT CAST(SUM(total_pedidos) AS BIGINT) FROM k_otd) AS total_pedidos,
  {RND("(SELECT SUM(receita_total) FROM k_freight_cost)", 2)} AS receita_total,
  {RND("(SELECT AVG(otd_pct) FROM k_otd)", M)} AS otd_medio,
  {RND("(SELECT AVG(lead_time_total_dias) FROM k_lead_time)", M)} AS lead_time_medio,
  {RND("(SELECT AVG(perfect_order_pct) FROM k_perfect_order)", M)} AS perfect_order_medio,
  {RND("(SELECT AVG(frete_medio) FROM k_freight_cost)", M)} AS frete_medio) s"""),
    "volume_trend": (["k_volume_monthly"], "SELECT mes, total_pedidos FROM k_volume_monthly ORDER BY mes"),
    "otd_best_worst": (["k_otd"], """
SELECT (SELECT estado FROM k_otd WHERE otd_pct IS NOT NULL ORDER BY otd_pct DESC, estado LIMIT 1) AS melhor_estado,
  (SELECT MAX(otd_pct) FROM k_otd) AS melhor_otd_pct,
  (SELECT estado FROM k_otd WHERE otd_pct IS NOT NULL ORDER BY otd_pct ASC, estado LIMIT 1) AS pior_estado,
  (SELECT MIN(otd_pct) FROM k_otd) AS pior_otd_pct"""),
    "otd_mean_delay": (["k_otd"], f"SELECT {RND('AVG(atraso_medio_dias)', M)} AS atraso_medio_nacional FROM k_otd"),
    "otd_min": (["k_otd"], "SELECT MIN(otd_pct) AS otd_min FROM k_otd"),
    "lead_stage_means": (["k_lead_time"], f"""
SELECT {RND('AVG(tempo_aprovacao_horas)', M)} AS aprovacao_media_horas,
  {RND('AVG(tempo_despacho_dias)', M)} AS despacho_medio_dias,
  {RND('AVG(tempo_transito_dias)', M)} AS transito_medio_dias FROM k_lead_time"""),
    "lead_stage_stack": (["k_lead_time"], """
SELECT estado, lead_time_total_dias, tempo_despacho_dias, tempo_transito_dias FROM k_lead_time
ORDER BY lead_time_total_dias DESC NULLS LAST, estado"""),
    "lead_mean_median": (["k_lead_time"], """
SELECT estado, lead_time_total_dias, lead_time_mediana_dias FROM k_lead_time
ORDER BY lead_time_total_dias DESC NULLS LAST, estado"""),
    "perfect_means": (["k_perfect_order"], f"""
SELECT {RND('AVG(perfect_order_pct)', M)} AS perfect_order_medio,
  {RND('AVG(nota_media)', M)} AS nota_media_nacional FROM k_perfect_order"""),
    "positive_share": (["k_perfect_order"], f"""
SELECT positivas, avaliadas, {RND('CAST(positivas AS DOUBLE) / NULLIF(CAST(avaliadas AS DOUBLE), 0) * 100', M)} AS positivas_pct
FROM (SELECT CAST(SUM(avaliacoes_positivas) AS BIGINT) AS positivas,
        CAST(SUM(avaliacoes_positivas + avaliacoes_neutras + avaliacoes_negativas) AS BIGINT) AS avaliadas
      FROM k_perfect_order) s"""),
    "top_volume10": (["k_perfect_order"], """
SELECT estado, total_pedidos, avaliacoes_positivas, avaliacoes_neutras, avaliacoes_negativas
FROM k_perfect_order ORDER BY total_pedidos DESC NULLS LAST, estado LIMIT 10"""),
    "score_bands_top10": (["k_perfect_order", ("top10", """
SELECT * FROM k_perfect_order ORDER BY total_pedidos DESC NULLS LAST, estado LIMIT 10""")], """
SELECT estado, 'avaliacoes_positivas' AS avaliacao, avaliacoes_positivas AS quantidade FROM top10
UNION ALL SELECT estado, 'avaliacoes_neutras', avaliacoes_neutras FROM top10
UNION ALL SELECT estado, 'avaliacoes_negativas', avaliacoes_negativas FROM top10"""),
    "freight_cards": (["k_freight_cost"], f"""
SELECT {RND('AVG(frete_medio)', M)} AS frete_medio_nacional,
  {RND('AVG(proporcao_frete_pct)', M)} AS proporcao_frete_media,
  (SELECT estado FROM k_freight_cost WHERE frete_medio IS NOT NULL ORDER BY frete_medio DESC, estado LIMIT 1)
    AS estado_maior_frete,
  MAX(frete_medio) AS maior_frete
FROM k_freight_cost"""),
    "freight_scatter": (["k_freight_cost"],
                        "SELECT estado, ticket_medio, frete_medio, proporcao_frete_pct, total_pedidos FROM k_freight_cost"),
    "delay_bands_ordered": (["k_delay_vs_satisfaction"], f"""
SELECT faixa_atraso,
  CAST(CASE faixa_atraso WHEN 'No prazo' THEN 1 WHEN 'Atraso leve (1-3 dias)' THEN 2
    WHEN 'Atraso moderado (4-7 dias)' THEN 3 WHEN 'Atraso grave (8+ dias)' THEN 4 END AS INTEGER) AS ordem,
  total_pedidos, nota_media, pct_negativas
FROM k_delay_vs_satisfaction ORDER BY ordem NULLS LAST, faixa_atraso"""),
    "delay_drop": (["k_delay_vs_satisfaction"], f"""
SELECT nota_no_prazo, nota_atraso_grave, {RND('nota_no_prazo - nota_atraso_grave', 2)} AS queda
FROM (SELECT MAX(nota_media) FILTER (WHERE faixa_atraso = 'No prazo') AS nota_no_prazo,
        MAX(nota_media) FILTER (WHERE faixa_atraso = 'Atraso grave (8+ dias)') AS nota_atraso_grave
      FROM k_delay_vs_satisfaction) s"""),
    "scores_long": (["k_delay_vs_satisfaction"], " UNION ALL ".join(
        f"SELECT faixa_atraso, 'nota_{v}' AS nota, nota_{v} AS quantidade FROM k_delay_vs_satisfaction"
        for v in (5, 4, 3, 2, 1))),
    "volume_period": (["k_volume_monthly"], f"""
SELECT total_pedidos_periodo, receita_periodo, ticket_medio_periodo,
  {_label_money('receita_periodo')} AS receita_label
FROM (SELECT CAST(SUM(total_pedidos) AS BIGINT) AS total_pedidos_periodo,
        {RND('SUM(receita_total)', 2)} AS receita_periodo,
        {RND('AVG(ticket_medio)', M)} AS ticket_medio_periodo FROM k_volume_monthly) s"""),
    "month_label": (["k_volume_monthly"], """
SELECT mes, strftime(mes, '%b/%Y') AS mes_label, total_pedidos, receita_total, ticket_medio
FROM k_volume_monthly ORDER BY mes"""),
    "category_cards": (["k_category_top20"], f"""
SELECT top_categoria, {_title("replace(top_categoria, '_', ' ')")} AS top_categoria_label,
  receita_top20, {_label_money('receita_top20')} AS receita_top20_label, ticket_medio_geral
FROM (SELECT
  (SELECT categoria FROM k_category_top20 ORDER BY receita_total DESC NULLS FIRST, categoria LIMIT 1) AS top_categoria,
  {RND('(SELECT SUM(receita_total) FROM k_category_top20)', 2)} AS receita_top20,
  {RND('(SELECT AVG(ticket_medio) FROM k_category_top20)', M)} AS ticket_medio_geral) s"""),
    "category_labels": (["k_category_top20"], f"""
SELECT categoria, {_title("replace(categoria, '_', ' ')")} AS categoria_label FROM k_category_top20"""),
    "category_share": (["k_category_top20"], f"""
SELECT categoria, receita_total, {RND('receita_total / SUM(receita_total) OVER () * 100', M)} AS share_pct
FROM k_category_top20"""),
    "payment_cards": (["k_payments"], f"""
SELECT {RND(f"CAST(SUM(total_transacoes) FILTER (WHERE tipo_pagamento = 'Cartão de Crédito') AS DOUBLE) / NULLIF(CAST(SUM(total_transacoes) AS DOUBLE), 0) * 100", M)} AS pct_transacoes_cartao,
  MAX(parcelas_medias) FILTER (WHERE tipo_pagamento = 'Cartão de Crédito') AS parcelas_medias_credito,
  {RND('AVG(ticket_medio)', M)} AS ticket_medio_geral
FROM k_payments"""),
    "payment_share": (["k_payments"], f"""
SELECT tipo_pagamento, total_transacoes,
  {RND('CAST(total_transacoes AS DOUBLE) / SUM(total_transacoes) OVER () * 100', M)} AS share_pct
FROM k_payments"""),
    "payment_pct_labels": (["k_payments"], """
SELECT tipo_pagamento, pct_parcelado, format('{:.1f}', pct_parcelado) || '%' AS pct_parcelado_label
FROM k_payments ORDER BY pct_parcelado DESC NULLS LAST, tipo_pagamento"""),
    "top_lead_time15": (["k_lead_time"], """
SELECT estado, lead_time_total_dias FROM k_lead_time
ORDER BY lead_time_total_dias DESC NULLS FIRST, estado DESC LIMIT 15"""),
    "top_delay15": (["k_otd"], """
SELECT estado, atraso_medio_dias FROM k_otd ORDER BY atraso_medio_dias DESC NULLS LAST, estado LIMIT 15"""),
    "top_score15": (["k_perfect_order"], """
SELECT estado, nota_media_no_prazo, nota_media_atrasado FROM k_perfect_order
ORDER BY nota_media_no_prazo DESC NULLS LAST, estado LIMIT 15"""),
    "otd_sorted": (["k_otd"], "SELECT * FROM k_otd ORDER BY otd_pct ASC NULLS LAST, estado"),
    "otd_table": (["k_otd", "dim_state"], "SELECT * FROM k_otd LEFT JOIN dim_state USING (estado) "
                  "ORDER BY otd_pct DESC NULLS LAST, estado"),
    "lead_table": (["k_lead_time"], "SELECT * FROM k_lead_time ORDER BY lead_time_total_dias DESC NULLS LAST, estado"),
    "perfect_table": (["k_perfect_order", "dim_state"], "SELECT * FROM k_perfect_order LEFT JOIN dim_state "
                      "USING (estado) ORDER BY perfect_order_pct DESC NULLS LAST, estado"),
    "freight_table": (["k_freight_cost", "dim_state"], "SELECT * FROM k_freight_cost LEFT JOIN dim_state "
                      "USING (estado) ORDER BY frete_medio DESC NULLS LAST, estado"),
    "lead_by_dispatch_share": (["k_lead_time"],
                               "SELECT * FROM k_lead_time ORDER BY pct_tempo_despacho DESC NULLS LAST, estado"),
    "perfect_sorted": (["k_perfect_order"],
                       "SELECT * FROM k_perfect_order ORDER BY perfect_order_pct ASC NULLS LAST, estado"),
    "freight_by_ratio": (["k_freight_cost"],
                         "SELECT * FROM k_freight_cost ORDER BY proporcao_frete_pct DESC NULLS LAST, estado"),
    "categories_by_ticket": (["k_category_top20"],
                             "SELECT * FROM k_category_top20 ORDER BY ticket_medio ASC NULLS LAST, categoria"),
    "categories_by_freight_ratio": (["k_category_top20"], "SELECT * FROM k_category_top20 "
                                    "ORDER BY proporcao_frete_pct DESC NULLS LAST, categoria"),
    "payments_by_ticket": (["k_payments"],
                           "SELECT * FROM k_payments ORDER BY ticket_medio ASC NULLS LAST, tipo_pagamento"),
    "overview_labels": (["k_otd", "k_lead_time", "k_perfect_order", "k_freight_cost"], f"""
SELECT format('{{:,}}', (SELECT CAST(SUM(total_pedidos) AS BIGINT) FROM k_otd)) AS pedidos,
  {_label_money(RND("(SELECT SUM(receita_total) FROM k_freight_cost)", 2))} AS receita,
  format('{{:.1f}}%', {RND("(SELECT AVG(otd_pct) FROM k_otd)", M)}) AS otd,
  format('{{:.1f}}d', {RND("(SELECT AVG(lead_time_total_dias) FROM k_lead_time)", M)}) AS lead_time,
  format('{{:.1f}}%', {RND("(SELECT AVG(perfect_order_pct) FROM k_perfect_order)", M)}) AS perfect_order,
  format('R${{:.0f}}', {RND("(SELECT AVG(frete_medio) FROM k_freight_cost)", M)}) AS frete"""),
    "lead_labels": (["k_lead_time"], f"""
SELECT format('{{:.1f}}h', {RND('AVG(tempo_aprovacao_horas)', M)}) AS aprovacao,
  format('{{:.1f}}d', {RND('AVG(tempo_despacho_dias)', M)}) AS despacho,
  format('{{:.1f}}d', {RND('AVG(tempo_transito_dias)', M)}) AS transito FROM k_lead_time"""),
    "perfect_labels": (["k_perfect_order"], f"""
SELECT format('{{:.1f}}%', {RND('AVG(perfect_order_pct)', M)}) AS perfect_order,
  format('{{:.2f}}', {RND('AVG(nota_media)', M)}) AS nota,
  format('{{:.1f}}%', {RND('CAST(SUM(avaliacoes_positivas) AS DOUBLE) / NULLIF(CAST(SUM(avaliacoes_positivas + avaliacoes_neutras + avaliacoes_negativas) AS DOUBLE), 0) * 100', M)}) AS positivas
FROM k_perfect_order"""),
    "freight_labels": (["k_freight_cost"], f"""
SELECT format('R${{:.2f}}', {RND('AVG(frete_medio)', M)}) AS frete,
  format('{{:.1f}}%', {RND('AVG(proporcao_frete_pct)', M)}) AS proporcao,
  format('R${{:.2f}}', MAX(frete_medio)) AS maior_frete FROM k_freight_cost"""),
    "delay_labels": (["k_delay_vs_satisfaction"], f"""
SELECT format('{{:.2f}}', a) AS no_prazo, format('{{:.2f}}', b) AS atraso_grave,
  format('-{{:.2f}}', {RND('a - b', 2)}) AS queda
FROM (SELECT MAX(nota_media) FILTER (WHERE faixa_atraso = 'No prazo') AS a,
        MAX(nota_media) FILTER (WHERE faixa_atraso = 'Atraso grave (8+ dias)') AS b FROM k_delay_vs_satisfaction) s"""),
    "volume_labels": (["k_volume_monthly"], f"""
SELECT format('{{:,}}', CAST(SUM(total_pedidos) AS BIGINT)) AS pedidos,
  {_label_money(RND('SUM(receita_total)', 2))} AS receita,
  format('R${{:.0f}}', {RND('AVG(ticket_medio)', M)}) AS ticket FROM k_volume_monthly"""),
    "payment_labels": (["k_payments"], f"""
SELECT format('{{:.1f}}%', {RND("CAST(SUM(total_transacoes) FILTER (WHERE tipo_pagamento = 'Cartão de Crédito') AS DOUBLE) / NULLIF(CAST(SUM(total_transacoes) AS DOUBLE), 0) * 100", M)}) AS cartao,
  format('{{:.1f}}x', MAX(parcelas_medias) FILTER (WHERE tipo_pagamento = 'Cartão de Crédito')) AS parcelas,
  format('R${{:.0f}}', {RND('AVG(ticket_medio)', M)}) AS ticket FROM k_payments"""),
    "otd_named": (["k_otd", "dim_state"], "SELECT k.*, d.estado_nome FROM k_otd k LEFT JOIN dim_state d USING (estado)"),
    "perfect_named": (["k_perfect_order", "dim_state"],
                      "SELECT k.*, d.estado_nome FROM k_perfect_order k LEFT JOIN dim_state d USING (estado)"),
    "freight_named": (["k_freight_cost", "dim_state"],
                      "SELECT k.*, d.estado_nome FROM k_freight_cost k LEFT JOIN dim_state d USING (estado)"),
}


# The states by code.
DIM_STATE = """
SELECT * FROM (VALUES
  ('AC', 'Acre'),
  ('AL', 'Alagoas'),
  ('AM', 'Amazonas'),
  ('AP', 'Amapá'),
  ('BA', 'Bahia'),
  ('CE', 'Ceará'),
  ('DF', 'Distrito Federal'),
  ('ES', 'Espírito Santo'),
  ('GO', 'Goiás'),
  ('MA', 'Maranhão'),
  ('MG', 'Minas Gerais'),
  ('MS', 'Mato Grosso do Sul'),
  ('MT', 'Mato Grosso'),
  ('PA', 'Pará'),
  ('PB', 'Paraíba'),
  ('PE', 'Pernambuco'),
  ('PI', 'Piauí'),
  ('PR', 'Paraná'),
  ('RJ', 'Rio de Janeiro'),
  ('RN', 'Rio Grande do Norte'),
  ('RO', 'Rondônia'),
  ('RR', 'Roraima'),
  ('RS', 'Rio Grande do Sul'),
  ('SC', 'Santa Catarina'),
  ('SE', 'Sergipe'),
  ('SP', 'São Paulo'),
  ('TO', 'Tocantins')
) AS t(estado, estado_nome)"""


def _with(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


def kpi_sql(name: str) -> str:
    """Standalone oracle statement for KPI CTE ``name`` (e.g. ``k_otd``)."""
    shared = ",\n".join(f"{n} AS ({s})" for n, s in [*ADAPTERS.items(), *FACTS.items()])
    return f"WITH {shared},\n" + KPI[name].strip().removeprefix("WITH ")


# KPIs given as SQL files (kpiforge/plans/sql), over the same order relations
SQL_FILES = {
    "sql_transit_by_state": f"""
WITH came AS (
  SELECT estado AS state, total_days, late, on_time, overdue FROM order_facts WHERE arrived)
SELECT state, count(*) AS arrivals,
  {PCT("sum(CASE WHEN late THEN 1 ELSE 0 END)", "nullif(count(CASE WHEN late OR on_time THEN 1 END), 0)", 2)} AS late_pct,
  {RND("avg(total_days * 24)", 2)} AS mean_hours, {RND("quantile_cont(total_days, 0.9)", 2)} AS p90_days,
  CAST(round(max(overdue) * 86400) AS BIGINT) AS worst_late_seconds
FROM came GROUP BY state""",
    "sql_revenue_by_month": f"""
WITH sold AS (
  SELECT order_id, sum(price) AS price, sum(freight_value) AS freight FROM r_items GROUP BY order_id),
months AS (
  SELECT CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP) AS month, count(*) AS orders,
    sum(price) AS price, sum(freight) AS freight
  FROM r_orders o LEFT JOIN sold USING (order_id)
  WHERE o.order_purchase_timestamp >= TIMESTAMP '1997-01-01' AND o.order_purchase_timestamp < TIMESTAMP '1998-09-01'
  GROUP BY 1)
SELECT month, orders, CAST(coalesce(price, 0) AS DOUBLE) AS revenue, {RND("CAST(price AS DOUBLE) / orders", 2)} AS ticket,
  {RND("CAST(price AS DOUBLE) / (SELECT CAST(sum(price) AS DOUBLE) FROM months) * 100", 3)} AS share_pct,
  {RND("CAST(freight AS DECIMAL(24,2)) * CAST(0.125 AS DECIMAL(4,3))", 3)} AS freight_eighth
FROM months""",
    "sql_review_by_delay_day": f"""
SELECT CAST(round(f.overdue) AS INTEGER) AS days_late, count(*) AS reviews, {RND("avg(r.review_score)", 3)} AS mean_score,
  {PCT("sum(CASE WHEN r.review_score >= 4 THEN 1 ELSE 0 END)", "count(*)", 1)} AS good_pct
FROM (SELECT o.order_id, {DAYS('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS overdue
      FROM r_orders o WHERE o.order_status = 'delivered') f
JOIN r_reviews r USING (order_id) WHERE r.review_score IS NOT NULL
GROUP BY 1 ORDER BY reviews DESC, days_late NULLS LAST LIMIT 25""",
}


def oracle_queries() -> dict[str, str]:
    out = {f"kpi_{k[2:]}": kpi_sql(k) for k in KPI}
    shared = ",\n".join(f"{n} AS ({s})" for n, s in [*ADAPTERS.items(), *FACTS.items()])
    for name, body in SQL_FILES.items():
        body = body.strip()
        out[name] = f"WITH {shared},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {shared}\n{body}"
    for name, (deps, body) in SECOND.items():
        ctes = [*ADAPTERS.items(), *FACTS.items()]
        for d in deps:
            if isinstance(d, tuple):
                ctes.append(d)
            else:
                ctes.append((d, DIM_STATE if d == "dim_state" else KPI[d]))
        out[name] = _with(ctes, body)
    return out

"""Cross-KPI invariants on the driver tables."""

import pytest
from pyspark.sql import functions as F

from kpiforge.operators import delay_satisfaction, otd, perfect_order, summaries, volume_monthly
from kpiforge.sources.driver_tables import DRIVER_VOLUME_BOUNDS, load_driver_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    return load_driver_tables(spark, SF_SMALL)


def test_on_time_plus_late_at_most_total(t):
    assert otd.build(t).where(F.col("pedidos_no_prazo") + F.col("pedidos_atrasados")
                              > F.col("total_pedidos")).count() == 0


def test_score_counts_at_most_rows(t):
    ds = delay_satisfaction.build(t)
    s = sum(F.col(f"nota_{v}") for v in (5, 4, 3, 2, 1))
    assert ds.where(s > F.col("total_pedidos")).count() == 0
    po = perfect_order.build(t)
    assert po.where(F.col("pedidos_perfeitos") > F.col("avaliacoes_positivas")).count() == 0


def test_monthly_orders_sum_to_distinct_orders(t):
    lo, hi = DRIVER_VOLUME_BOUNDS
    vt = volume_monthly.build(t, lo, hi)
    total = vt.agg(F.sum("total_pedidos")).first()[0]
    ts = F.col("order_purchase_timestamp")
    direct = (t["orders"].where((ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz")))
              .select("order_id").distinct().count())
    assert total == direct


def test_shares_sum_to_hundred(t):
    from kpiforge.operators import payments
    sh = summaries.payment_share(payments.build(t)).agg(F.sum("share_pct")).first()[0]
    assert sh == pytest.approx(100.0, abs=1e-3)


def test_shared_order_fact_gives_the_same_tables(t):
    from kpiforge.operators import freight_cost, lead_time
    from kpiforge.operators.facts import with_order_fact
    from kpiforge.session import cut_lineage
    shared = with_order_fact(t, cut_lineage)
    for mod in (otd, lead_time, perfect_order, freight_cost):
        a = sorted(map(tuple, mod.build(t).collect()))
        b = sorted(map(tuple, mod.build(shared).collect()))
        assert a == b, mod.NAME


def test_results_do_not_depend_on_the_session_time_zone(spark, t):
    from kpiforge.operators import lead_time
    mods = (otd, lead_time, delay_satisfaction, volume_monthly)

    def run():
        out = []
        for m in mods:
            df = m.build(t, *DRIVER_VOLUME_BOUNDS) if m is volume_monthly else m.build(t)
            out.append(sorted(map(tuple, df.collect())))
        return out

    base = run()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert run() == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

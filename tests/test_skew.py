"""KPIs on deliberately skewed inputs (and duplicate keys), against the DuckDB formulation.

One state holds ~40 % of the orders, one customer 30 %, one order thousands of
items and reviews, one product a third of the items. The percentile limits are
lowered so that the hot state's lead times and freights go through the
refinement passes inside the real KPIs.
"""

import tempfile

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kpiforge.checks.oracle import FACTS, KPI
from kpiforge.operators import (categories, delay_satisfaction, freight_cost, lead_time, otd,
                                payments, perfect_order, volume_monthly)
from kpiforge.operators.facts import with_order_fact, with_review_fold
from kpiforge.session import cut_lineage
from kpiforge.sources.driver_tables import DRIVER_VOLUME_BOUNDS
from tools.oracle_check import rows_of

N_ORDERS = 90_000
BUILDERS = {
    "k_otd": otd.build, "k_lead_time": lead_time.build, "k_perfect_order": perfect_order.build,
    "k_freight_cost": freight_cost.build, "k_delay_vs_satisfaction": delay_satisfaction.build,
    "k_volume_monthly": lambda t: volume_monthly.build(t, *DRIVER_VOLUME_BOUNDS),
    "k_category_top20": categories.build, "k_payments": payments.build,
}
SQL_NAMES = {"orders": "r_orders", "customers": "r_customers", "order_items": "r_items",
             "order_reviews": "r_reviews", "order_payments": "r_payments",
             "products": "r_products", "product_category_name_translation": "r_translation"}


def _money(rng, n, hi):
    return pa.array([None if x is None else x for x in
                     (np.round(rng.uniform(0, hi, n), 2).astype(str))], pa.string()).cast(pa.decimal128(12, 2))


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    n = N_ORDERS
    cust = np.where(rng.random(n) < 0.3, 0, rng.integers(1, 3000, n))          # hot customer 0
    base = np.datetime64("1997-01-01T00:00:00") + rng.integers(0, 600 * 86400, n).astype("timedelta64[s]")
    sec = lambda lo, hi: rng.integers(lo, hi, n).astype("timedelta64[s]")
    approved = base + sec(0, 2 * 86400)
    carrier = approved + sec(-3600, 5 * 86400)
    delivered = carrier + sec(86400, 25 * 86400)
    estimated = base + sec(10 * 86400, 20 * 86400)
    ts = lambda a, null_every: pa.array(
        [None if i % null_every == 0 else v for i, v in enumerate(a.astype("datetime64[us]").tolist())],
        pa.timestamp("us"))
    status = np.where(rng.random(n) < 0.85, "delivered", np.where(rng.random(n) < 0.5, "shipped", "canceled"))
    orders = pa.table({
        "order_id": pa.array(np.arange(n), pa.int64()), "customer_id": pa.array(cust, pa.int64()),
        "order_status": pa.array(status), "order_purchase_timestamp": ts(base, 10**9),
        "order_approved_at": ts(approved, 97), "order_delivered_carrier_date": ts(carrier, 89),
        "order_delivered_customer_date": ts(delivered, 83), "order_estimated_delivery_date": ts(estimated, 79)})
    states = np.array(["SP"] * 40 + [f"S{i}" for i in range(26)] * 2)
    state_of = np.where(np.arange(3000) < 1200, "SP", states[np.arange(3000) % len(states)])
    customers = pa.table({"customer_id": pa.array(np.arange(3000), pa.int64()),
                          "customer_state": pa.array([None if i % 250 == 6 else v   # some unknown states
                                                      for i, v in enumerate(state_of)])})
    m = n * 2
    item_order = np.concatenate([np.zeros(4000, np.int64), rng.integers(0, n, m)])   # hot order 0
    k = len(item_order)
    items = pa.table({"order_id": pa.array(item_order, pa.int64()),
                      "product_id": pa.array(np.where(rng.random(k) < 0.33, 0, rng.integers(1, 800, k)), pa.int64()),
                      "price": _money(rng, k, 500), "freight_value": _money(rng, k, 60)})
    rev_order = np.concatenate([np.zeros(3000, np.int64), rng.integers(0, n, n)])
    reviews = pa.table({"order_id": pa.array(rev_order, pa.int64()),
                        "review_score": pa.array([None if i % 37 == 0 else int(v) for i, v in
                                                  enumerate(rng.integers(1, 6, len(rev_order)))], pa.int32())})
    payments_t = pa.table({"payment_type": pa.array(rng.choice(["credit_card", "boleto", "voucher", "not_defined", "pix"], n)),
                           "payment_installments": pa.array(rng.integers(1, 10, n), pa.int32()),
                           "payment_value": _money(rng, n, 900)})
    products = pa.table({"product_id": pa.array(np.arange(800), pa.int64()),
                         "product_category_name": pa.array([None if i % 17 == 0 else f"cat_{i % 40}" for i in range(800)])})
    translation = pa.table({"product_category_name": [f"cat_{i}" for i in range(0, 40, 3)],
                            "product_category_name_english": [f"category_{i}" for i in range(0, 40, 3)]})
    # duplicate keys: customer 5 listed twice with different states, order 7 twice
    customers = pa.concat_tables([customers, pa.table({
        "customer_id": pa.array([5], pa.int64()), "customer_state": pa.array(["DUP"])})])
    orders = pa.concat_tables([orders, orders.slice(7, 1)])
    d = tempfile.mkdtemp(prefix="kpiforge-skew-")
    tables = {"orders": orders, "customers": customers, "order_items": items, "order_reviews": reviews,
              "order_payments": payments_t, "products": products,
              "product_category_name_translation": translation}
    con = duckdb.connect()
    t = {}
    for name, tab in tables.items():
        path = f"{d}/{name}.parquet"
        pq.write_table(tab, path, row_group_size=8192)  # several map tasks per table
        t[name] = spark.read.parquet(path)
        con.execute(f"CREATE VIEW {SQL_NAMES[name]} AS SELECT * FROM read_parquet('{path}')")
    for name, sql in FACTS.items():
        con.execute(f"CREATE VIEW {name} AS {sql}")
    return t, con


def test_hot_state_holds_over_a_third(skewed):
    t, _ = skewed
    from pyspark.sql import functions as F
    sp = t["orders"].join(t["customers"], "customer_id").where(F.col("customer_state") == "SP")
    assert sp.count() > N_ORDERS / 3
    assert sp.select("order_delivered_customer_date").distinct().count() > 50_000


@pytest.mark.parametrize("kpi", sorted(BUILDERS))
def test_skewed_inputs_match_sql(skewed, kpi, monkeypatch):
    import kpiforge.operators.percentile as P
    # small limits force several refinement passes on the hot state
    monkeypatch.setattr(P, "DEFAULT_FINISH_ROWS", 1000)
    monkeypatch.setattr(P, "DEFAULT_BUCKETS", 8)
    t, con = skewed
    cur = con.execute(KPI[kpi])
    cols = [c[0] for c in cur.description]
    want = rows_of(cols, cur.fetchall())
    for tables in (t, with_order_fact(t, cut_lineage), with_review_fold(t, cut_lineage)):
        df = BUILDERS[kpi](tables)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("kpi", ["k_category_top20", "k_freight_cost", "k_volume_monthly", "k_lead_time"])
def test_split_hot_join_partitions_match_sql(spark, skewed, kpi):
    """With tiny skew thresholds AQE splits the hot order / product / customer
    partitions of the joins; results must not change."""
    t, con = skewed
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.files.maxPartitionBytes": "64k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        cur = con.execute(KPI[kpi])
        cols = [c[0] for c in cur.description]
        df = BUILDERS[kpi](t)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())
        if kpi == "k_category_top20":   # the hot product's partition was split
            from tools.explain_plans import plan_text
            assert "SortMergeJoin(skew=true)" in plan_text(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

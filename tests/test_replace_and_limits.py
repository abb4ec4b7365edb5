"""Replaces under readers and writers at work; KPIs that never end; orders of
very many items."""

import threading
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpiforge.operators import freight_cost
from kpiforge.plans import runner
from kpiforge.plans.registry import Registry
from kpiforge.plans.runner import run_kpis
from kpiforge.sources import catalog
from kpiforge.sources.catalog import ensure_databases, recover_tables, replace_table


def test_readers_never_fail_while_columns_change(spark):
    ensure_databases(spark, "an_loop")
    shapes = ["id, 'a' AS x", "id, 1.5 AS y, 'b' AS x", "'c' AS z, id", "CAST(id AS STRING) AS id"]

    def write(i):
        replace_table(spark.range(50).selectExpr(*[c.strip() for c in shapes[i % 4].split(",")]), "an_loop", "t", keep=3)

    write(0)
    stop, failures, seen = threading.Event(), [], set()

    def read():
        while not stop.is_set():
            try:
                df = spark.table("an_loop.t")
                seen.add((tuple(df.columns), len(df.collect())))
            except Exception as e:  # any failure fails the test
                failures.append(e)
                return

    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    for i in range(1, 9):
        write(i)
    stop.set()
    for r in readers:
        r.join()
    assert failures == []
    assert {n for _, n in seen} == {50} and len(seen) >= 2
    assert spark.table("an_loop.t").columns == ["id", "x"]
    assert spark.catalog.getTable("an_loop.t").tableType == "VIEW"


def test_of_several_writers_one_wins_whole(spark):
    ensure_databases(spark, "an_race")
    errors = []

    def write(k):
        try:
            for _ in range(3):
                replace_table(spark.range(20 + k).select(F.lit(k).alias("who"), F.col("id").alias(f"c{k}")), "an_race", "t", keep=1)
        except Exception as e:
            errors.append(e)

    writers = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert [str(e) for e in errors] == []
    rows = spark.table("an_race.t").collect()
    assert len({r.who for r in rows}) == 1 and len(rows) == 20 + rows[0].who
    assert spark.table("an_race.t").columns == ["who", f"c{rows[0].who}"]


def test_a_late_older_writer_does_not_turn_the_view_back(spark, monkeypatch):
    ensure_databases(spark, "an_late")
    replace_table(spark.range(5), "an_late", "t")
    now = time.time()
    monkeypatch.setattr(catalog.time, "time", lambda: now - 3600)  # a writer that began an hour ago ends now
    replace_table(spark.range(9), "an_late", "t")
    assert spark.table("an_late.t").count() == 5


def test_entries_of_old_kind_and_versions_of_another_process(spark, tmp_path):
    ensure_databases(spark, "an_old")
    spark.range(3).write.parquet(str(tmp_path / "x"))
    spark.catalog.createTable("an_old.t", path=str(tmp_path / "x"), source="parquet")
    replace_table(spark.range(4), "an_old", "t")
    assert spark.table("an_old.t").count() == 4
    spark.sql("DROP VIEW an_old.t")
    spark.sql("DROP DATABASE an_old__versions CASCADE")  # external tables: files stay
    assert recover_tables(spark, "an_old") == ["t"] and spark.table("an_old.t").count() == 4


def test_stored_by_bucket_and_by_folder(spark):
    from tools.explain_plans import plan_text
    ensure_databases(spark, "an_lay")
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"), F.lit(1).alias("v"))
    assert replace_table(df, "an_lay", "a", buckets=(4, "id")) == 1000
    assert replace_table(df.withColumnRenamed("v", "w"), "an_lay", "b", buckets=(4, "id")) == 1000
    replace_table(df, "an_lay", "p", partition_by="k")
    assert spark.table("an_lay.p").columns == ["id", "k", "v"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("an_lay.a").join(spark.table("an_lay.b"), "id")
        assert "Exchange" not in plan_text(joined) and joined.count() == 1000
        assert "PartitionFilters: [isnotnull(k" in plan_text(spark.table("an_lay.p").filter("k = 3"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for t in ("a", "p"):
        spark.sql(f"DROP VIEW an_lay.{t}")
    spark.sql("DROP DATABASE an_lay__versions CASCADE")
    assert sorted(recover_tables(spark, "an_lay")) == ["a", "p"]
    assert spark.table("an_lay.a").count() == spark.table("an_lay.p").filter("k >= 0").count() == 1000


def endless(spark):
    return spark.range(10**14).filter("pmod(hash(id), 1000003) = -1").select("id")


def test_a_kpi_that_never_ends_is_stopped_and_the_others_are_written(spark):
    reg = (Registry().register("before", lambda t: spark.range(3)).register("endless", lambda t: endless(spark))
           .register("joins", lambda t: endless(spark).join(endless(spark), "id"))
           .register("after", lambda t: spark.range(4)))
    t0 = time.time()
    rep = run_kpis(spark, reg, tables={}, out_db="an_stuck", parallelism=1, kpi_seconds=3)
    assert rep.written == {"before": 3, "after": 4}
    assert rep.failed == {"endless": "stopped after 3 s", "joins": "stopped after 3 s"}
    assert time.time() - t0 < 60
    assert not spark.catalog.tableExists("an_stuck.endless")


def test_a_kpi_that_hangs_outside_of_spark_is_left_behind(spark, monkeypatch):
    monkeypatch.setattr(runner, "GRACE_SECONDS", 1.0)
    gate = threading.Event()

    def hang(t):
        gate.wait(60)
        raise RuntimeError("late")

    reg = Registry().register("hangs", hang).register("after", lambda t: spark.range(4))
    rep = run_kpis(spark, reg, tables={}, out_db="an_hang", parallelism=1, kpi_seconds=1)
    gate.set()
    assert rep.written == {"after": 4} and set(rep.failed) == {"hangs"}
    assert "still hanging" in rep.failed["hangs"]


def test_a_limit_that_is_not_reached_changes_nothing(spark):
    reg = Registry().register("a", lambda t: spark.range(3)).register("b", lambda t: 1 / 0)
    rep = run_kpis(spark, reg, tables={}, out_db="an_limit", kpi_seconds=600)
    assert rep.written == {"a": 3} and rep.failed["b"].startswith("ZeroDivisionError")


def test_an_order_of_very_many_items_is_one_order(spark):
    from tests.helpers import ts
    state = spark.createDataFrame([("c1", "SP"), ("c2", "RJ")], "customer_id string, customer_state string")
    day = ts("2018-01-05 00:00:00")
    orders = spark.createDataFrame(
        [(f"o{i}", "c1" if i else "c2", "delivered", day, day, day, day, day) for i in range(4)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    hot = spark.range(30000).select(F.lit("o0").alias("order_id"), F.lit(Decimal("2.00")).alias("price"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("decimal(12,2)").alias("freight_value"))
    few = spark.createDataFrame([("o1", Decimal("5.00"), None), ("o1", Decimal("5.00"), None), ("o2", Decimal("0.00"), Decimal("1.00")),
                                 ("o2", None, Decimal("3.00"))], "order_id string, price decimal(12,2), freight_value decimal(12,2)")
    items = hot.select("order_id", F.col("price").cast("decimal(12,2)").alias("price"), "freight_value").unionByName(few)
    got = {r.estado: r for r in freight_cost.build({"orders": orders, "customers": state, "order_items": items}).collect()}
    assert (got["RJ"].total_pedidos, got["SP"].total_pedidos) == (1, 2)
    assert (got["RJ"].frete_medio, got["RJ"].frete_mediano, got["RJ"].frete_total) == (1.5, 1.5, 30000.0)
    assert (got["RJ"].proporcao_frete_pct, got["SP"].frete_medio, got["SP"].receita_total) == (75.0, 2.0, 10.0)

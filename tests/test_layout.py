"""The stored layout: plans without exchanges on the orders, months pruned, the
same results, and tables with a hot order left as they are."""

import json
import re

import pytest
from pyspark.sql import functions as F

from kpiforge.__main__ import main
from kpiforge.operators import delay_satisfaction, freight_cost, perfect_order, volume_monthly
from kpiforge.plans.layout import MONTH, bucket_number, bucket_skew, store_for_joins
from kpiforge.plans.registry import default_registry
from kpiforge.sources.catalog import ensure_databases, raw_tables, replace_table
from kpiforge.sources.driver_tables import DRIVER_VOLUME_BOUNDS, load_driver_tables
from tests.conftest import SF_SMALL
from tools.explain_plans import plan_text, summarize


@pytest.fixture(scope="module")
def stored(spark):
    """{db: tables}: as ingested, and laid out."""
    out = {}
    for db in ("raw_flat", "raw_laid"):
        ensure_databases(spark, db)
        for name, df in load_driver_tables(spark, SF_SMALL).items():
            replace_table(df, db, name, keep=1)
    assert store_for_joins(spark, "raw_laid", buckets=4) == {
        "orders": 4, "order_items": 4, "order_reviews": 4, "order_payments": 4}
    for db in ("raw_flat", "raw_laid"):
        out[db] = raw_tables(spark, db)
    return out


@pytest.fixture
def at_scale(spark):
    """As when every table is large: no broadcast by size, no new plan at run time."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges_on(text, column):
    return len(re.findall(rf"hashpartitioning\({column}#", text))


def test_every_kpi_gives_the_same_rows(spark, stored):
    for job in default_registry().jobs():
        if job.name == volume_monthly.NAME:
            flat, laid = (volume_monthly.build(stored[d], *DRIVER_VOLUME_BOUNDS) for d in ("raw_flat", "raw_laid"))
        else:
            flat, laid = (job.build(spark, stored[d]) for d in ("raw_flat", "raw_laid"))
        assert flat.columns == laid.columns and flat.collect() == laid.collect(), job.name


def test_folds_and_joins_on_orders_need_no_exchange(spark, stored, at_scale):
    t = stored["raw_laid"]
    for build in (delay_satisfaction.build, perfect_order.build,
                  lambda x: volume_monthly.build(x, *DRIVER_VOLUME_BOUNDS)):
        assert exchanges_on(plan_text(build(stored["raw_flat"])), "order_id") >= 2
        assert exchanges_on(plan_text(build(t)), "order_id") == 0
    assert summarize(plan_text(volume_monthly.build(t, *DRIVER_VOLUME_BOUNDS)))["exchanges"] == 2  # per month, sort
    items = t["order_items"].join(t["orders"].select("order_id", "customer_id"), "order_id").groupBy("order_id").count()
    assert "Exchange" not in plan_text(items)
    assert freight_cost.build(t).count() > 0


def test_months_outside_of_the_range_are_not_read(spark, stored):
    df = volume_monthly.build(stored["raw_laid"], "1997-03-01", "1997-05-01")
    text = plan_text(df)
    assert f"PartitionFilters: [isnotnull({MONTH}" in text
    assert len(df.collect()) == 2
    read = stored["raw_laid"]["orders"].where(F.col(MONTH).between("1997-03", "1997-05"))
    assert 0 < len(read.inputFiles()) <= len(stored["raw_laid"]["orders"].inputFiles())
    assert read.select(F.input_file_name().alias("f")).distinct().count() <= 3 * 4


def test_a_table_with_a_hot_order_is_not_bucketed(spark):
    ensure_databases(spark, "raw_hot")
    replace_table(spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id"),
                                           F.lit(1.0).alias("price")), "raw_hot", "order_items")
    replace_table(spark.range(3000).select(F.col("id").alias("order_id"), F.lit(5).alias("review_score")),
                  "raw_hot", "order_reviews")
    assert store_for_joins(spark, "raw_hot", buckets=32) == {"order_items": 1, "order_reviews": 32}
    assert spark.table("raw_hot.order_items").count() == spark.table("raw_hot.order_reviews").count() == 3000
    assert bucket_skew(spark.table("raw_hot.order_items").limit(0), "order_id", 8) == 1.0


def test_bucket_numbers():
    assert [bucket_number(n, 100) for n in (0, 100, 101, 400, 401)] == [1, 1, 2, 4, 8]
    assert bucket_number(100 << 40) == 1 << 16


def test_command_line(spark, capsys):
    ensure_databases(spark, "raw_cli_lay")
    replace_table(load_driver_tables(spark, SF_SMALL)["order_reviews"], "raw_cli_lay", "order_reviews")
    assert main(["layout", "--raw-db", "raw_cli_lay", "--buckets", "2"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"buckets": {"order_reviews": 2}}

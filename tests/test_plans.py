"""Plan shape on typed raw tables: what must hold for the jobs to scale."""

import re

import pytest

from kpiforge.plans.registry import default_registry
from kpiforge.sources.catalog import ensure_databases, raw_tables, replace_table
from kpiforge.sources.driver_tables import load_driver_tables
from tests.conftest import SF_SMALL
from tools.explain_plans import plan_text, summarize


@pytest.fixture(scope="module")
def plans(spark):
    ensure_databases(spark, "plans_raw")
    for name, df in load_driver_tables(spark, SF_SMALL).items():
        replace_table(df, "plans_raw", name)
    t = raw_tables(spark, "plans_raw")
    return {job.name: plan_text(job.build(spark, t)) for job in default_registry().jobs()}


def test_no_python_no_cartesian_no_single_task_percentile(plans):
    for name, text in plans.items():
        s = summarize(text)
        assert not s["python"], name
        assert not s["cartesian"], name
        assert not re.search(r"percentile\(", text), name


@pytest.mark.parametrize("kpi", ["otd", "perfect_order", "delay_vs_satisfaction", "categorias"])
def test_status_filter_reaches_the_scan(plans, kpi):
    assert "EqualTo(order_status,delivered)" in plans[kpi]


def test_date_range_and_type_filters_pushed(plans):
    assert re.search(r"GreaterThanOrEqual\(order_purchase_timestamp,2017-01-01", plans["volume_temporal"])
    assert "Not(EqualTo(payment_type,not_defined))" in plans["pagamentos"]


def test_scans_read_only_needed_columns(plans):
    reads = summarize(plans["pagamentos"])["read"]
    assert reads == ["struct<payment_type:string,payment_installments:int,payment_value:decimal(12,2)>"]
    otd_reads = " ".join(summarize(plans["otd"])["read"])
    assert "order_purchase_timestamp" not in otd_reads and "order_approved_at" not in otd_reads


def test_tasks_of_the_queries_are_bounded(spark, tmp_path):
    """A task's share of a shuffle has a bound that does not grow with the tables."""
    from kpiforge import session
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[1], "64MB")
        (tmp_path / "orders.parquet").write_bytes(bytes(20 * session.TASK_INPUT + 1))
        session.bound_tasks(spark, str(tmp_path / "orders.parquet"))
        assert [int(spark.conf.get(k)) for k in keys] == [max(21, int(before[keys[0]])), session.TASK_SHUFFLE]
        spark.conf.set(keys[1], "1m")
        session.bound_tasks(spark, str(tmp_path / "missing.parquet"))
        assert spark.conf.get(keys[1]) == "1m"
        spark.conf.set(keys[1], "64MB")
        import __spark_entry__
        __spark_entry__.queries()["sum_overview"](spark, SF_SMALL)
        assert int(spark.conf.get(keys[1])) == session.TASK_SHUFFLE
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

"""Whole pipeline from CSV: the sf0.001 logical tables written as CSV folders
under the original file names, ingested, and every KPI table compared with the
same KPI computed straight from the parquet adapters."""

import os
import tempfile

import pytest

import __spark_entry__ as E
from kpiforge.operators import volume_monthly
from kpiforge.plans.registry import default_registry
from kpiforge.plans.runner import run_all
from kpiforge.sources.driver_tables import DRIVER_VOLUME_BOUNDS, load_driver_tables
from tests.conftest import SF_SMALL

FILE_OF = {
    "orders": "olist_orders_dataset", "customers": "olist_customers_dataset",
    "order_items": "olist_order_items_dataset", "order_reviews": "olist_order_reviews_dataset",
    "order_payments": "olist_order_payments_dataset", "products": "olist_products_dataset",
    "product_category_name_translation": "product_category_name_translation",
}
KPI_QUERY = {"otd": "kpi_otd", "lead_time": "kpi_lead_time", "perfect_order": "kpi_perfect_order",
             "freight_cost": "kpi_freight_cost", "delay_vs_satisfaction": "kpi_delay_vs_satisfaction",
             "volume_temporal": "kpi_volume_monthly", "categorias": "kpi_category_top20",
             "pagamentos": "kpi_payments"}


@pytest.fixture(scope="module")
def csv_dir(spark):
    d = tempfile.mkdtemp(prefix="kpiforge-csvpipe-")
    for name, df in load_driver_tables(spark, SF_SMALL).items():
        (df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
         .csv(os.path.join(d, FILE_OF[name])))
    return d


def test_csv_pipeline_equals_parquet_queries(spark, csv_dir):
    reg = default_registry()
    reg.register(volume_monthly.NAME, lambda t: volume_monthly.build(t, *DRIVER_VOLUME_BOUNDS))
    rep = run_all(spark, csv_dir, registry=reg, raw_db="raw_csvpipe", out_db="an_csvpipe")
    assert rep.ok, rep.failed
    assert set(rep.ingested) == set(FILE_OF)
    for table, key in KPI_QUERY.items():
        got = sorted(map(tuple, spark.table(f"an_csvpipe.{table}").collect()))
        want = sorted(map(tuple, E.queries()[key](spark, SF_SMALL).collect()))
        assert got == want, table

"""Adapters from the driver's TPC-H-like parquet tables to the logical raw
marketplace tables the KPIs read.

The driver tables carry no delivery stamps, reviews, payments or categories, so
those are derived from the keys by fixed modular rules. Every derived table
grows with its source table (orders, lineitem, part, customer). The same rules
are written in DuckDB SQL in ``kpiforge.checks.oracle`` and must stay
identical. Keys stay BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Monthly-volume window for the driver data (order dates run 1995-01..2001-08).
DRIVER_VOLUME_BOUNDS = ("1997-01-01", "1998-09-01")


# Declared read schemas (only the columns the adapters use): no schema
# inference job per file, and the scans read exactly these columns.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_extendedprice DOUBLE, "
                "l_tax DOUBLE",
    "part": "p_partkey BIGINT, p_brand STRING, p_size INT",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_hours(ts, h):
    return ts + F.make_dt_interval(F.lit(0), h.cast("int"), F.lit(0), F.lit(0))


def adapt_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    day0 = F.col("o_orderdate").cast("timestamp_ntz")
    h0 = (k * 7) % 24
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
         .when(F.col("o_orderstatus") == "O", "shipped")
         .otherwise("processing").alias("order_status"),
        _plus_hours(day0, h0).alias("order_purchase_timestamp"),
        F.when(k % 53 == 0, None)
         .otherwise(_plus_hours(day0, h0 + (k * 13) % 72)).alias("order_approved_at"),
        F.when(k % 59 == 0, None)
         .otherwise(_plus_hours(day0, h0 + 72 + (k * 17) % 240))
         .alias("order_delivered_carrier_date"),
        F.when(k % 61 == 0, None)
         .otherwise(_plus_hours(day0, h0 + 312 + (k * 31) % 500))
         .alias("order_delivered_customer_date"),
        F.when(k % 67 == 0, None)
         .otherwise(_plus_hours(F.to_date(day0).cast("timestamp_ntz"), F.lit(576)))
         .alias("order_estimated_delivery_date"),
    )


def adapt_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return (customer.select("c_custkey", "c_nationkey")
            .join(nation.select("n_nationkey", "n_name"),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("n_name").alias("customer_state")))


def adapt_order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 101 == 0, F.lit(0.0))
         .otherwise(F.col("l_extendedprice")).cast("decimal(12,2)").alias("price"),
        F.round((F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(38,10)"), 2)
         .cast("decimal(12,2)").alias("freight_value"),
    )


def adapt_order_reviews(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    first = orders.where(k % 13 != 0).select(
        k.alias("order_id"),
        F.when(k % 71 == 0, None).otherwise((k * 11) % 5 + 1).cast("int").alias("review_score"))
    second = orders.where(k % 20 == 0).select(
        k.alias("order_id"), (k % 3 + 1).cast("int").alias("review_score"))
    return first.unionByName(second)


def adapt_order_payments(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    ptype = (F.when(pr == "1-URGENT", "credit_card").when(pr == "2-HIGH", "boleto")
             .when(pr == "3-MEDIUM", "voucher").when(pr == "4-NOT SPECIFIED", "not_defined")
             .when(pr == "5-LOW", "debit_card"))
    return (orders.select(k.alias("order_id"), ptype.alias("payment_type"), k.alias("_k"),
                          F.col("o_totalprice"))
            .select("order_id", "payment_type",
                    F.when(F.col("payment_type").isin("credit_card", "voucher"), F.col("_k") % 12 + 1)
                     .otherwise(1).cast("int").alias("payment_installments"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("payment_value")))


def adapt_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 == 0, None).otherwise(F.col("p_brand"))
         .alias("product_category_name"))


def adapt_translation(part: DataFrame) -> DataFrame:
    return (part.where((F.col("p_size") % 2 == 1) & F.col("p_brand").like("%3"))
            .select(F.col("p_brand").alias("product_category_name")).distinct()
            .select("product_category_name",
                    F.concat(F.lit("en_"), F.col("product_category_name"))
                     .alias("product_category_name_english")))


class LazyTables(Mapping):
    """Read-only name -> DataFrame mapping that builds each table on first use
    (a KPI touches two to four of the seven tables)."""

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def load_driver_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """Logical raw tables (lazy DataFrames) derived from the driver parquet."""
    def rd(name):
        return lambda: _read(spark, sf_dir, name)
    return LazyTables({
        "orders": lambda: adapt_orders(rd("orders")()),
        "customers": lambda: adapt_customers(rd("customer")(), rd("nation")()),
        "order_items": lambda: adapt_order_items(rd("lineitem")()),
        "order_reviews": lambda: adapt_order_reviews(rd("orders")()),
        "order_payments": lambda: adapt_order_payments(rd("orders")()),
        "products": lambda: adapt_products(rd("part")()),
        "product_category_name_translation": lambda: adapt_translation(rd("part")()),
    })

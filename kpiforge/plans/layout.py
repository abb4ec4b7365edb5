"""A stored layout of the raw tables that the KPIs' joins need no exchange on.

Orders, items, reviews and payments are rewritten hashed and sorted by order, all
into the same number of buckets, so that folding them per order and joining them
on it reads bucket by bucket. Orders also get a folder per month of purchase, in
a column of their own, which the monthly KPI prunes by.

A bucket is read by one task. So a table is bucketed only if its fullest bucket
holds at most ``MOST_SKEW`` times the mean, counted beforehand with partial sums;
one with a hot order stays as it is, to be joined with exchanges that AQE splits.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.operators.volume_monthly import MONTH
from kpiforge.session import input_bytes
from kpiforge.sources.catalog import RAW_DB, replace_table, table_path

log = logging.getLogger(__name__)

# table -> the column its joins are on
BUCKET_COLUMN = {"orders": "order_id", "order_items": "order_id", "order_reviews": "order_id", "order_payments": "order_id"}
BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 1 << 16
MOST_SKEW = 4.0


def bucket_number(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The power of two that puts at most ``bucket_bytes`` into a bucket of a
    table of ``size`` bytes, up to ``MOST_BUCKETS``."""
    n = 1
    while n < MOST_BUCKETS and n * bucket_bytes < size:
        n *= 2
    return n


def bucket_skew(df: DataFrame, column: str, buckets: int) -> float:
    """Rows of the fullest bucket over the mean of all buckets."""
    # Spark's own bucket of a row: its hash partition
    rows = df.groupBy(F.pmod(F.hash(column), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    got = rows.agg(F.max("rows").alias("most"), F.sum("rows").alias("all")).first()
    return got["most"] * buckets / got["all"] if got["all"] else 1.0


def month_of(orders: DataFrame) -> DataFrame:
    """``orders`` with the month of purchase (yyyy-MM)."""
    return orders.withColumn(MONTH, F.date_format("order_purchase_timestamp", "yyyy-MM"))


def store_for_joins(spark: SparkSession, db: str = RAW_DB, buckets: int | None = None,
                    by_month: bool = True) -> dict[str, int]:
    """Rewrite the stored tables of ``BUCKET_COLUMN`` that lie in ``db``; returns
    the buckets each has now (1: not bucketed). ``buckets`` left out is sized by
    the largest of the tables."""
    tables = [t for t in BUCKET_COLUMN if spark.catalog.tableExists(f"`{db}`.`{t}`")]
    if buckets is None:
        buckets = bucket_number(max((input_bytes(spark, table_path(spark, db, t)) for t in tables), default=0))
    out = {}
    for t in tables:
        df, column = spark.table(f"`{db}`.`{t}`"), BUCKET_COLUMN[t]
        month = t == "orders" and by_month
        if month:
            df = month_of(df)
        n = buckets
        if n > 1 and (skew := bucket_skew(df, column, n)) > MOST_SKEW:
            log.warning("%s.%s: fullest bucket holds %.1f times the mean, not bucketed", db, t, skew)
            n = 1
        out[t] = n
        if n == 1 and not month:
            continue
        # one task writes one bucket, so that each is one file (per month)
        placed = df.repartition(n, column) if n > 1 else df
        replace_table(placed, db, t, keep=1, buckets=(n, column) if n > 1 else None,
                      partition_by=MONTH if month else None)
    return out

"""Helpers shared by the operators: input shaping and batching inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# text processed at once inside a task; bounds the numpy scratch space
CHUNK_BYTES = 1 << 19
# rows that cross to a Python worker at once, unless the session says otherwise:
# whole texts may be long
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, renamed, so extra columns can never clash."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in cols.items()])


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch where the session has Spark's default."""
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def text_or_empty(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **more: str) -> DataFrame:
    """(doc_id, text, ...) with a null text as the empty one."""
    small_batches(df.sparkSession)
    d = pick(df, doc_id=id_col, text=text_col, **more)
    return d.withColumn("text", F.coalesce(F.col("text"), F.lit("")))


def remainder_of_id(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: that of the empty text)."""
    return (F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batch: pa.RecordBatch, column: str = "text",
           most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of at most ``most`` text bytes each (one row at least)."""
    if batch.num_rows == 0:
        return
    size = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0)
    total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving memory back when its task ends: Spark
    keeps Python workers for the next stages, and with them whatever their
    allocators hold."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL("libc.so.6").malloc_trim(0)
    return task


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))

"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint holds the k smallest distinct 64-bit hashes of a document's
five-word shingles, sorted. The sketch of a union is the bottom-k of the
merged sketches, so fingerprints of parts, shards or whole corpora combine
without the texts, and two fingerprints estimate resemblance, containment and
the number of distinct shingles. Equal texts have equal fingerprints.

Defined cases: a null text counts as empty and has the empty fingerprint; two
empty fingerprints resemble each other fully (1.0), an empty and a non-empty
one not at all (0.0); a text of fewer than five words has one shingle, all its
words. Repeated rows are fingerprinted one by one. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.common import chunks, column, lean, shuffle_partitions, text_or_empty
from kpiforge.llm.textvec import Words, shingles

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
_RANGE = float(1 << 64)


# ---- sketches (numpy, inside tasks) ----------------------------------------

def sketch_column(texts: pa.Array, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Bottom-k sketch of every text of an Arrow array."""
    w = Words(texts)
    h, at = shingles(w.hash, w.of, words)
    return [np.unique(h[at[d]:at[d + 1]])[:k] for d in range(len(at) - 1)]


def merge(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> np.ndarray:
    """Sketch of the union of what ``a`` and ``b`` were taken from."""
    return np.unique(np.concatenate([a, b]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated Jaccard similarity of the shingle sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    rank = np.arange(1, len(both)) - np.cumsum(twice)  # distinct values before, for each second sight
    total = min(k, len(both) - int(twice.sum()))
    return float(np.count_nonzero(twice & (rank < total))) / total


def distinct_shingles(a: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated number of distinct shingles (exact below ``k``)."""
    if len(a) < k:
        return float(len(a))
    return (k - 1) * _RANGE / (float(a[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH_SIZE) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return min(1.0, shared / distinct_shingles(a, k))


def to_text(a: np.ndarray) -> str:
    """Base64 of the sorted hashes, big-endian."""
    return base64.b64encode(a.astype(">u8").tobytes()).decode("ascii")


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


# ---- operators --------------------------------------------------------------

def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, distinct_est) of every row; no shuffle."""
    d = text_or_empty(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                s = sketch_column(column(part, "text"), k, words)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array([to_text(x) for x in s], pa.string()),
                     pa.array([distinct_shingles(x, k) for x in s], pa.float64())],
                    ["doc_id", "fingerprint", "distinct_est"])

    id_type = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(lean(run), f"doc_id {id_type}, fingerprint string, distinct_est double")


def merge_by(prints: DataFrame, key: str, k: int = SKETCH_SIZE,
             fingerprint_col: str = "fingerprint") -> DataFrame:
    """(key, fingerprint) of the union of each group's documents.

    Every task first merges the sketches it reads, so a group sends at most
    one sketch per task however large it is; the distinct hashes are then
    ranked per group, with the rank limit applied before that shuffle too.
    """
    p = prints.select(F.col(f"`{key}`").alias("key"), F.col(f"`{fingerprint_col}`").alias("fingerprint"))
    key_type = p.schema["key"].dataType.simpleString()
    flush = 50_000  # keys held by a task before it passes its merged sketches on

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def out() -> pa.RecordBatch:
            keys = [x for x, s in held.items() for _ in range(len(s))]
            hashes = np.concatenate([*held.values(), np.zeros(0, np.uint64)])
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, schema_key), pa.array((hashes ^ np.uint64(1 << 63)).view(np.int64))], ["key", "h"])

        schema_key = None
        for batch in batches:
            schema_key = column(batch, "key").type
            for x, s in zip(column(batch, "key").to_pylist(), column(batch, "fingerprint").to_pylist()):
                held[x] = merge(held.get(x, np.zeros(0, np.uint64)), from_text(s or ""), k)
            if len(held) > flush:
                yield out()
                held.clear()
        if held:
            yield out()

    hashes = p.mapInArrow(partial, f"key {key_type}, h bigint").distinct()
    rank = F.row_number().over(Window.partitionBy("key").orderBy("h"))
    kept = hashes.withColumn("r", rank).filter(F.col("r") <= k)
    # order-preserving signed form back to the unsigned big-endian bytes
    unsigned = F.lpad(F.hex(F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))), 16, "0")
    text = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("h", unsigned.alias("x")))),
                                       lambda s: s["x"]))
    none = p.select("key").distinct()
    merged = kept.groupBy("key").agg(F.base64(F.unhex(text)).alias("fingerprint"))
    return (none.join(merged, none["key"].eqNullSafe(merged["key"]), "left")
            .select(none["key"].alias(key), F.regexp_replace(F.coalesce(merged["fingerprint"], F.lit("")), r"\s", "")
                    .alias("fingerprint")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets_per_partition: int = 4) -> tuple[DataFrame, int]:
    """Rows (bucket, is_copy, doc_id, text) whose stream in (bucket, is_copy,
    doc_id, text) order gives every document its successor by ascending id.

    Ids are cut into ranges at their quantiles (one number per range on the
    driver). The first document of a range is also sent, as a copy, behind the
    range before it, and the first of all behind the last, so a range needs
    nothing from its neighbours and the texts are shuffled once. Null ids come
    first; equal ids are ordered by text and stay in one range.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    d = text_or_empty(docs, id_col, text_col)
    key = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1e300))
    ids = d.select(key.alias("key"))
    n = parts * buckets_per_partition
    cuts = ids.approxQuantile("key", [i / n for i in range(1, n)], 0.25 / n)
    splits = [float("-inf"), *sorted({0.0} if not cuts else set(cuts)), float("inf")]
    bucket = Bucketizer(splits=splits, inputCol="key", outputCol="b")
    first = sorted((int(r["b"]), r["head"]) for r in
                   bucket.transform(ids).groupBy("b").agg(F.min("key").alias("head")).collect())
    d = bucket.transform(d.withColumn("key", key))
    # one row per range, so as many as there are partitions, times a constant
    heads = spark.createDataFrame([(h, first[i - 1][0]) for i, (_, h) in enumerate(first)],
                                  "head double, before int")
    d = d.join(F.broadcast(heads), d["key"] == heads["head"], "left")
    own = F.struct(F.col("b").cast("int").alias("bucket"), F.lit(False).alias("is_copy"))
    copy = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("is_copy"))
    d = d.select("doc_id", "text", F.explode(F.when(F.col("before").isNull(), F.array(own))
                                             .otherwise(F.array(own, copy))).alias("p"))
    d = d.select("p.bucket", "p.is_copy", "doc_id", "text")
    return (d.repartition(parts, "bucket").sortWithinPartitions("bucket", "is_copy", "doc_id", "text"), parts)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text: its last quarter
    (floor of the code points) replaced by the first as many code points, or
    all, of the next document by ascending id (after the last: the first)."""
    rows, _ = with_next(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    fields = [("doc_id", None), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
              ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
              ("near_edited", pa.float64()), ("near_next", pa.float64()),
              ("distinct_est", pa.float64()), ("contained_in_edited", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen: (bucket, id, text, sketch)
        for batch in batches:
            for part in chunks(batch):
                texts = column(part, "text")
                seq = list(zip(column(part, "bucket").to_pylist(), column(part, "is_copy").to_pylist(),
                               column(part, "doc_id").to_pylist(), texts.to_pylist(),
                               sketch_column(texts, k, words)))
                out = []  # (id, text, sketch, next sketch, edited)
                for bucket, is_copy, doc, text, sketch in seq:
                    if held is not None and held[0] == bucket:
                        cut = len(held[2]) // 4
                        edited = held[2][:len(held[2]) - cut] + text[:cut]
                        out.append((held[1], held[2], held[3], sketch, edited))
                    # a second copy (an id on several rows) has no one before it
                    held = None if is_copy else (bucket, doc, text, sketch)
                if not out:
                    continue
                edits = sketch_column(pa.array([x[4] for x in out], pa.string()), k, words)
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in out], column(part, "doc_id").type),
                    pa.array([len(x[1]) for x in out], pa.int64()),
                    pa.array([hashlib.sha256(x[4].encode()).hexdigest() for x in out], pa.string()),
                    pa.array([to_text(x[2]) for x in out], pa.string()),
                    pa.array([to_text(e) for e in edits], pa.string()),
                    pa.array([resemblance(x[2], e, k) for x, e in zip(out, edits)], pa.float64()),
                    pa.array([resemblance(x[2], x[3], k) for x in out], pa.float64()),
                    pa.array([distinct_shingles(x[2], k) for x in out], pa.float64()),
                    pa.array([containment(x[2], e, k) for x, e in zip(out, edits)], pa.float64()),
                ], [f for f, _ in fields])

    return rows.mapInArrow(lean(run), f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double, "
                                "distinct_est double, contained_in_edited double")

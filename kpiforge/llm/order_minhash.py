"""Near-duplicate classes by Order MinHash and banded alignment.

Sketching. A text's k-mers are its runs of five words, each labelled with its
occurrence number so that repeats count. Every one of ``SKETCHES`` hash orders
picks the ``LENGTH`` smallest labelled k-mers of a text and keeps them in text
order; a sketch value is the hash of that ordered list. Two texts agree on a
value with a probability that falls with every edit, moved passages included.

Candidates. Equal texts are one node from the start. Each node is entered once
per value, under that value and the ones ``STRIDES`` further along, and all
entries are sorted by range, so that a value which very many texts have is dealt
to as many tasks as it needs. Entries next to each other with their first value
in common are a candidate pair: the sort puts those side by side which agree on
the longest row of values. This is done twice. At first with the entries of
``FEW`` values, which joins a family of copies into a class or nearly so; then
with all entries, where only neighbours of different classes are pairs. That finds
nearly all links at a cost that grows with the nodes, not with the size of a group.

The rest is exact: wherever a value is still in more than one class, all pairs of
nodes of different classes that have it are met, in cells of about ``CELL`` by
``CELL`` nodes and ``CELL_BYTES`` of text a side, each a group of its own. A pair is
met under the first value it has in common and aligned within its cell, if lengths
and word counts by ``BINS`` allow it, a bound that no near pair fails, and if no
link of the cell joins its classes yet. Only links leave a cell, fewer than it has
nodes, so no table of pairs grows with the square of a group. So any two near texts
with a value in common end up in one class.

Verification. A pair is linked if the alignment of its words, within a band of
diagonals around the main one, needs edits for at most 1 - threshold of the
longer text. Before it, only what follows from that bound is asked: lengths,
and common runs of one to three words. Classes are the connected components of
links and equal texts, by alternating large-star and small-star steps.

Defined cases: null and empty texts are equal texts; a text of fewer than five
words has one k-mer, all its words; texts without words but with different
white space are different nodes that share no value; repeated rows belong to
one class; a class's id is its smallest doc_id (null if all of its are null).
Texts without a common k-mer are not met, however near.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.common import chunks, column, lean, text_or_empty
from kpiforge.llm.textvec import Words, mix, shingles
from kpiforge.session import cut_lineage, cut_lineage_counted

SHINGLE_WORDS = 5
SKETCHES = 40
LENGTH = 2
THRESHOLD = 0.8
# the values an entry is sorted by, counted from its own; each list is one sort
STRIDES = [(0, 1, 2, 3), (0, 7, 18, 29)]
FEW = 4  # values whose entries are sorted first
CELL = 1000  # nodes of one value that meet as many others in one group
CELL_BYTES = 8 << 20  # of their texts
BINS = 512   # word counts that bound what two texts have in common
NARROW = 24  # edits up to which an alignment follows single diagonals
SMALL_ROWS = 200_000  # a table is broadcast up to this counted size

_U = np.uint64
_SIGN = _U(1 << 63)
_ORDERS = mix(np.arange(1, SKETCHES + 1, dtype=_U)) | _U(1)
_PLACES = mix(np.arange(100, 100 + LENGTH, dtype=_U)) | _U(1)


# ---- sketches ---------------------------------------------------------------

def occurrence_labelled(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Hashes that also tell a text's first, second, ... occurrence of a k-mer apart."""
    doc = np.repeat(np.arange(len(of) - 1, dtype=_U), np.diff(of))
    key = mix(h ^ (doc + _U(1)) * _U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    start = np.maximum.accumulate(np.where(first, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    nth = np.empty(len(k), _U)
    nth[order] = (np.arange(len(k)) - start).astype(_U)
    return np.where(nth == 0, h, mix(h + nth * _U(0xD6E8FEB86659FD93)))


def sketch(kmers: np.ndarray) -> np.ndarray:
    """The sketch values of one text from its labelled k-mers in text order."""
    n = len(kmers)
    take = min(n, LENGTH)
    out = np.empty(SKETCHES, _U)
    step = max(1, min(SKETCHES, (1 << 22) // n))
    for a in range(0, SKETCHES, step):
        ranked = kmers[:, None] * _ORDERS[None, a:a + step]
        ranked ^= ranked >> _U(32)
        ranked *= _U(0xBF58476D1CE4E5B9)
        at = np.argpartition(ranked, take - 1, axis=0)[:take] if n > take else np.tile(
            np.arange(n)[:, None], (1, ranked.shape[1]))
        at = np.sort(at, axis=0)  # text order
        out[a:a + step] = (kmers[at] * _PLACES[:take, None]).sum(axis=0, dtype=_U)
    return mix(out + _ORDERS + _U(take))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, node, words, size, values) of every row: node is the text's MD5, words
    the number of its words, size that of its bytes."""
    d = text_or_empty(docs, id_col, text_col).withColumn("node", F.unhex(F.md5("text")))
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                w = Words(column(part, "text"))
                h, of = shingles(w.hash, w.of, SHINGLE_WORDS)
                h = occurrence_labelled(h, of)
                n = np.diff(of)
                some = np.flatnonzero(n)
                values = np.concatenate([*[sketch(h[of[d]:of[d + 1]]) for d in some], np.zeros(0, _U)])
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, SKETCHES, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), column(part, "node"), pa.array(w.counts()), pa.array(np.diff(w.offsets)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array((values ^ _SIGN).view(np.int64)))],
                    ["doc_id", "node", "words", "size", "values"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, node binary, words bigint, size bigint, values array<bigint>")


# ---- verification -----------------------------------------------------------

def banded_distance(a: list, b: list, band: int) -> int | None:
    """Edits (insert, delete, replace) that turn ``a`` into ``b``, or None if
    more than ``band``. Only the diagonals of the band are followed: ``reach``
    holds how far each one gets with the edits so far. Beyond ``NARROW`` edits all
    diagonals of a column go at once, as bits of a number."""
    n, m = len(a), len(b)
    if abs(n - m) > band:
        return None
    reach = {}
    for edits in range(min(band, NARROW) + 1):
        now = {}
        for k in range(-edits, edits + 1):  # diagonal: place in b minus place in a
            if edits == 0:
                i = 0
            else:
                i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            if i > n:
                i = n
            if i < 0 or i + k < 0:
                continue
            if i + k > m:
                i = m - k
                if i < 0:
                    continue
            while i < n and i + k < m and a[i] == b[i + k]:
                i += 1
            if i == n and i + k == m:
                return edits
            now[k] = i
        reach = now
    return _by_columns(a, b, band) if band > NARROW else None


def _by_columns(a: list, b: list, band: int) -> int | None:
    """The same by Myers' bit vectors: ``up`` and ``down`` tell where a column of
    the table of distances rises or falls by one from one item of ``a`` to the next."""
    n, m = len(a), len(b)
    if not n:
        return m if m <= band else None
    at: dict = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, last = (1 << n) - 1, n - 1
    up, down, edits = full, 0, n
    for j, y in enumerate(b, 1):
        same = at.get(y, 0)
        level = ((same & up) + up ^ up) | same
        right, left = down | full & ~(level | up), up & level
        edits += (right >> last & 1) - (left >> last & 1)
        if edits - (m - j) > band:  # each column left lowers it by one at most
            return None
        right, left, same = right << 1 | 1, left << 1, same | down
        up = (left | ~(same | right)) & full
        down = right & same & full
    return edits


def _runs(a: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` items."""
    acc = a[:len(a) - k + 1].copy()
    for j in range(1, k):
        acc = mix(acc) + a[j:len(a) - k + 1 + j]
    return acc


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the multisets' intersection."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(nx[i], ny[j]).sum())


def near(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether an alignment of the word hashes ``a`` and ``b`` needs edits for at
    most 1 - ``threshold`` of the longer one."""
    band = int((1 - threshold) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > band:
        return False
    # what the texts begin and end with alike needs no alignment
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(a[len(a) - n + head:][::-1] != b[len(b) - n + head:][::-1])
    tail = int(differ[0]) if len(differ) else n - head
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if min(len(a), len(b)) == 0:
        return True  # the longer one's rest is within the band
    # an edit spoils at most k runs of k words
    for k in (1, 2, 3):
        least = max(len(a), len(b)) - k + 1 - k * band
        if least > 0 and (min(len(a), len(b)) < k or in_common(_runs(a, k), _runs(b, k)) < least):
            return False
    return banded_distance(a.tolist(), b.tolist(), band) is not None


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked) of every candidate pair."""
    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
              .select("a", "b", "ta", "tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "ta"):
                wa, wb = Words(column(part, "ta")), Words(column(part, "tb"))
                linked = [near(wa.hash[wa.of[i]:wa.of[i + 1]], wb.hash[wb.of[i]:wb.of[i + 1]], threshold)
                          for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([column(part, "a"), column(part, "b"), pa.array(linked, pa.bool_())],
                                                 ["a", "b", "linked"])

    return joined.mapInArrow(lean(run), "a binary, b binary, linked boolean")


# ---- candidates -------------------------------------------------------------

def entries(nodes: DataFrame, strides: tuple[int, ...], first: int = SKETCHES, more: str = "words") -> DataFrame:
    """(k0, k1, ..., node, root, ``more``): an entry of each node for its first values."""
    def entry(i: Column) -> Column:
        return F.struct(*[F.element_at("values", ((i + s) % SKETCHES + 1).cast("int")).alias(f"k{j}")
                          for j, s in enumerate(strides)])
    places = F.transform(F.sequence(F.lit(0), F.lit(first - 1)), entry)
    return (nodes.filter(F.size("values") > 0).select(F.explode(places).alias("e"), "node", "root", more)
            .select("e.*", "node", "root", more))


def side_by_side(rows: DataFrame, threshold: float = 0.0) -> DataFrame:
    """(a, b): nodes of entries next to each other in sorted order that agree on
    their first value, have different roots and, if given as words, lengths that
    allow an alignment."""
    by = [c for c in rows.columns if c not in ("root", "words")]
    words = "words" if "words" in rows.columns else F.lit(0).cast("bigint").alias("words")
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("k0", "node", "root", words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # kind 0: a pair; 1 and 2: the first and the last entry of a partition
        part = TaskContext.get().partitionId()
        names = ["a", "b", "k0", "root", "words", "kind", "part"]

        def out(a: pa.Array, b: pa.Array, key: pa.Array, root: pa.Array, size: pa.Array, kind: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [a, b, key, root, size, pa.array(np.full(len(a), kind, np.int32)), pa.array(np.full(len(a), part, np.int32))], names)

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, root, size = (column(batch, c) for c in ("k0", "node", "root", "words"))
            if last is None:
                yield out(node[:1], node[:1], key[:1], root[:1], size[:1], 1)
            else:
                key, node, root, size = (pa.concat_arrays([x, y]) for x, y in zip(last, (key, node, root, size)))
            k, n = key.to_numpy(), size.to_numpy()
            fit = np.abs(n[1:] - n[:-1]) <= ((1 - threshold) * np.maximum(n[1:], n[:-1]) + 1e-9).astype(np.int64)
            met = pc.and_(pa.array((k[1:] == k[:-1]) & fit), pc.not_equal(root[1:], root[:-1]))
            yield out(node[:-1].filter(met), node[1:].filter(met), key[1:].filter(met), root[1:].filter(met),
                      size[1:].filter(met), 0)
            last = key[-1:], node[-1:], root[-1:], size[-1:]
        if last is not None:
            yield out(last[1], last[1], last[0], last[2], last[3], 2)

    found = cut_lineage(sorted_rows.mapInArrow(
        lean(run), "a binary, b binary, k0 bigint, root binary, words bigint, kind int, part int"))
    # the ends of partitions, two rows of each, meet across the borders
    border = Window.orderBy("part", "kind")
    ends = found.filter("kind > 0").select(
        "kind", "k0", "root", "words", "b",
        *[F.lag(c).over(border).alias(f"{c}_before") for c in ("k0", "root", "words", "a")])
    longer = F.greatest("words", "words_before")
    across = (ends.filter("kind = 1 AND k0 = k0_before AND root <> root_before")
              .filter(longer - F.least("words", "words_before") <= F.floor((1 - threshold) * longer + 1e-9))
              .select(F.col("a_before").alias("a"), "b"))
    return found.filter("kind = 0").select("a", "b").union(across)


def candidates(nodes: DataFrame, threshold: float, first: int = SKETCHES, lists: list[tuple] = STRIDES) -> DataFrame:
    """(a, b): candidate pairs of nodes (node, words, values, root) whose lengths
    allow an alignment."""
    pairs = None
    for strides in lists:
        found = side_by_side(entries(nodes, strides, first), threshold)
        pairs = found if pairs is None else pairs.unionByName(found)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cell_pairs(root: np.ndarray, length: np.ndarray, bins: np.ndarray, left: np.ndarray, right: np.ndarray,
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of an item of ``left`` and one of ``right`` (numbers of items; each
    pair once where both are the same) of different roots that may be near: words in
    common are at most those of the bins in common, and edits spoil at most the band."""
    coarse = bins.reshape(len(bins), -1, 8).sum(axis=2)
    same = left is right
    out_a, out_b = [], []
    for k, a in enumerate(left.tolist()):
        b = right[k + 1:] if same else right
        longer = np.maximum(length[a], length[b])
        band = ((1 - threshold) * longer + 1e-9).astype(np.int64)
        ok = (root[b] != root[a]) & (np.abs(length[b] - length[a]) <= band)
        b, least = b[ok], (longer - band)[ok]
        for table in (coarse, bins):
            ok = np.minimum(table[b], table[a]).sum(axis=1) >= least
            b, least = b[ok], least[ok]
        out_a.append(np.full(len(b), a))
        out_b.append(b)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def cell_links(node: pa.Array, root: np.ndarray, values: np.ndarray, hashes: list[np.ndarray], pairs: tuple,
               key: int, threshold: float) -> pa.Table:
    """(a, b): links of the cell of value ``key`` that join the roots which its near
    ``pairs`` join, each pair tested under the first value it has in common only."""
    parent = list(range(int(root.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for at in range(0, len(pairs[0]), 4096):
        a, b = (x[at:at + 4096] for x in pairs)
        same = values[a] == values[b]
        first = values[a, same.argmax(axis=1)]
        here = (first == key) | ~same.any(axis=1)
        for x, y in zip(a[here].tolist(), b[here].tolist()):
            rx, ry = find(int(root[x])), find(int(root[y]))
            if rx != ry and near(hashes[x], hashes[y], threshold):
                parent[rx] = ry
                out.append((x, y))
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": node.take(pa.array(a)), "b": node.take(pa.array(b))})


def rest(nodes: DataFrame, texts_of, threshold: float) -> DataFrame | None:
    """(a, b): links that join what near pairs of nodes (node, size, values, root) of
    different roots with a common value join; None if no value has two roots."""
    places = entries(nodes, (0,), more="size")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / CELL), F.ceil(F.sum("size") / CELL_BYTES))
    mixed, n = cut_lineage_counted(
        places.groupBy("k0").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), parts.cast("int").alias("parts"))
        .filter("lo <> hi").select("k0", "parts"))
    if not n:
        return None
    met = cut_lineage(places.select("k0", "node", "root").join(_small(mixed, n), "k0"))
    texts = texts_of(met.select("node").distinct()).join(nodes.select("node", "values"), "node")
    rows = (met.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("k0", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "root")
            .join(texts, "node"))

    def meet(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        root = cell["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        values = cell["values"].combine_chunks().flatten().to_numpy().reshape(-1, SKETCHES)
        hashes, bins = [], []
        for piece in (p for batch in cell.to_batches() for p in chunks(batch)):
            w = Words(column(piece, "text"))
            hashes += [w.hash[a:b] for a, b in zip(w.of[:-1], w.of[1:])]
            at = w.doc_index() * BINS + (w.hash % _U(BINS)).astype(np.int64)
            bins.append(np.bincount(at, minlength=piece.num_rows * BINS).reshape(-1, BINS).astype(np.int32))
        part, i, j = cell["part"].to_numpy(), cell["i"][0].as_py(), cell["j"][0].as_py()
        left = np.flatnonzero(part == i)
        pairs = cell_pairs(root, np.array([len(h) for h in hashes]), np.concatenate(bins),
                           left, left if i == j else np.flatnonzero(part == j), threshold)
        return cell_links(cell["node"].combine_chunks(), root, values, hashes, pairs, cell["k0"][0].as_py(), threshold)

    return rows.groupBy("k0", "i", "j").applyInArrow(meet, "a binary, b binary")


def links(nodes: DataFrame, texts_of, threshold: float) -> DataFrame | None:
    """(a, b): verified links between nodes (node, words, size, values) that connect
    all near candidates. ``texts_of(ids)`` gives (node, text) of the nodes in
    ``ids``."""
    def test(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return cut_lineage(verified(pairs, texts_of(ids), threshold))

    nodes = nodes.withColumn("root", F.col("node"))
    few, n = cut_lineage_counted(candidates(nodes, threshold, FEW, STRIDES[:1]))
    if n:
        tested = test(few)
        family = cut_lineage(components(tested.filter("linked").select("a", "b")))
        nodes = cut_lineage(nodes.drop("root").join(family, "node", "left").withColumn("root", F.coalesce("root", "node")))
    left = candidates(nodes, threshold)
    if n:  # what failed is not tried again
        left = left.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    left, n_left = cut_lineage_counted(left)
    if n_left:
        edges = test(left).filter("linked").select("a", "b")
        if n:  # of the first links the classes they make are enough
            edges = edges.union(family.select(F.col("node").alias("a"), F.col("root").alias("b")))
        family = cut_lineage(components(edges))
        nodes = cut_lineage(nodes.drop("root").join(family, "node", "left").withColumn("root", F.coalesce("root", "node")))
    first = family.select(F.col("node").alias("a"), F.col("root").alias("b")) if n or n_left else None
    last = rest(nodes, texts_of, threshold)
    if last is None:
        return first
    return last if first is None else first.union(last)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large-star and
    small-star steps, each one shuffle by node with partial minima, until
    the edges no longer change."""
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small)
        got = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(got) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(got)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, node, class_id, class_rows) of every row."""
    rows = cut_lineage(sketches(docs, id_col, text_col))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("values").alias("values"),
                                     F.first("words").alias("words"), F.first("size").alias("size"),
                                     F.count(F.lit(1)).alias("n"))
    nodes = cut_lineage(nodes)

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted, n = cut_lineage_counted(nodes.select("node", "doc_id").join(ids, "node", "left_semi"))
        d = text_or_empty(docs, id_col, text_col).withColumn("node", F.unhex(F.md5("text")))
        # one row of each wanted text: that of its smallest id (rows may still repeat)
        hit = d.join(_small(wanted.withColumnRenamed("doc_id", "least_id"), n), "node").filter(
            F.col("doc_id").eqNullSafe(F.col("least_id")))
        return cut_lineage(hit.groupBy("node").agg(F.first("text").alias("text")))

    found = links(nodes.select("node", "words", "size", "values"), texts_of, threshold)
    root = nodes.select("node").limit(0).withColumn("root", F.col("node")) if found is None else components(found)
    # linked nodes point to their root; the root itself and every other node to itself
    rooted = cut_lineage(nodes.select("node", "doc_id", "n").join(root, "node", "left")
                         .withColumn("root", F.coalesce("root", "node")))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_rows"))
    class_of = cut_lineage(rooted.join(ids, "root").select("node", "root", "class_id", "class_rows"))
    return rows.select("doc_id", "node").join(class_of, "node")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row of
    the smallest id stays (of several such texts the one whose MD5 is least),
    with all of its columns."""
    found = cut_lineage(classes(docs, id_col, text_col, threshold))
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("k"))
    best = best.select("root", F.col("k.doc_id").alias("best_id"), F.col("k.node").alias("best_node"))
    rows = found.groupBy("root", "node", "doc_id").agg(F.count(F.lit(1)).alias("n")).join(best, "root")
    stays = (F.col("node") == F.col("best_node")) & F.col("doc_id").eqNullSafe(F.col("best_id"))
    # what goes, and rows that stay but are there several times
    change, n = cut_lineage_counted(rows.filter(~stays | (F.col("n") > 1)).select(
        F.col("node").alias("_n"), F.col("doc_id").alias("_i"), stays.alias("_stays")))
    # the row travels as one struct, so none of its names can clash
    d = text_or_empty(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                  F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), row="row")
    d = d.select("row", "doc_id", F.unhex(F.md5("text")).alias("node"))
    d = d.join(_small(change, n), (F.col("node") == F.col("_n")) & F.col("doc_id").eqNullSafe(F.col("_i")), "left")
    once = d.filter(F.col("_n").isNull())
    repeated = d.filter(F.col("_stays")).dropDuplicates(["node", "doc_id"])
    return once.unionByName(repeated).select("row.*")

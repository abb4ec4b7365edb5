"""Class-based n-gram scoring after Brown et al.: exchange clustering assigns
words to classes; P(word | previous word) is the class transition probability
times the word's emission probability within its class.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text, capitals A-Z lowered, then
one end token in a class of its own, which is also the context of a first word.

How the work is spread
  blocks    Each task turns the texts it reads into blocks of at most
            ``BLOCK_BYTES``: the block's distinct words (64-bit hashes, training
            counts) and every text as numbers into that list. Stored once.
  exchange  A core is clustered first: the ``CORE`` words with the greatest counts
            over those blocks where they are frequent (which spares a shuffle of
            all words for choosing it). All other words are lumped by their endings
            (``ENDINGS`` slots) meanwhile. In each round all blocks count how often
            each unit precedes and follows each class; Spark adds the counts up,
            and the units then move, the most frequent first, each to the class
            that raises the class bigram likelihood most. The driver sees
            units x classes numbers, whatever the corpus.
  words     Then every other word of the training texts, however rare, is
            exchanged by its own contexts: Spark sums them by word, and tasks move
            each word to its best class against the class bigram table. The
            result, (word, count, class), is a Spark table, joined back to the
            blocks by word. The core's counts and classes are broadcast instead,
            so the most frequent words are in no join.
  scores    The class bigrams are counted anew with all words in their final
            classes; a last pass over the stored blocks scores every text.
A word without a training count takes the class of its ending.

Defined cases: a null or empty text is the end token alone; null ids are held
out or not by the rule for the empty id and keep their rows; repeated rows are
counted and scored one by one; without training texts every count is zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm.common import chunks, column, lean, text_or_empty
from kpiforge.llm.textvec import SPACE, buffer_of, mix, span_hashes, spans
from kpiforge.session import cut_lineage

BLOCK_BYTES = 4 << 20
CORE = 8192    # words clustered one after another; all others are exchanged in tasks
ENDINGS = 4096
CLASSES = 32   # class 0 is the end token's
ROUNDS = 3
ROWS = 1 << 12  # words and blocks whose contexts a task adds up at once

_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_BYTES_DEFAULT = ("64MB", "67108864", "67108864b")

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SIGN = _U(1 << 63)


# ---- blocks -----------------------------------------------------------------

def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, ending slot) of every word, and each text's number of words."""
    raw, offsets = buffer_of(texts)
    low = _LOWER[raw]
    starts, ends = spans(~SPACE[raw], offsets)
    padded = np.concatenate([np.zeros(4, np.uint8), low])
    tail = np.zeros(len(starts), np.uint32)
    if len(starts):
        size = np.minimum(ends - starts, 4)
        tail = np.lib.stride_tricks.sliding_window_view(padded, 4)[ends].copy().view(">u4")[:, 0].astype(np.uint32)
        tail &= np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)[size]
    slot = (mix(tail.astype(_U) + _U(1)) % _U(ENDINGS)).astype(np.uint16)
    return span_hashes(low, starts, ends), slot, np.diff(np.searchsorted(starts, offsets))


def planes(x: np.ndarray) -> bytes:
    """uint32 numbers as four byte planes, which compress well when most are small."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(kind)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[list]:
    """The named columns, one block in memory at a time."""
    columns = [column(batch, c) for c in names]
    for i in range(batch.num_rows):
        yield [c[i].as_py() for c in columns]


def block_batches(spark: SparkSession) -> None:
    """Bounds the bytes of an Arrow batch, which would else hold many blocks, in
    the JVM and in Python, where the session has Spark's default."""
    if spark.conf.get(_BYTES_CONF) in _BYTES_DEFAULT:
        spark.conf.set(_BYTES_CONF, str(BLOCK_BYTES))


def blocks(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block: block, ids, held_out, length (tokens with the end),
    tokens (planes of numbers into the block's words; their count is the end
    token), words (hashes, signed so that they sort), n (training counts), slot."""
    d = text_or_empty(docs, id_col, text_col).withColumn("held_out", held_out)
    block_batches(docs.sparkSession)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            nonlocal number
            counts = np.concatenate([h[4] for h in held])
            hashes = np.concatenate([h[2] for h in held])
            slots = np.concatenate([h[3] for h in held])
            test = np.concatenate([np.array(h[1], bool) for h in held])
            distinct, first, of, many = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-many, kind="stable")  # frequent words get small numbers
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            doc = np.repeat(np.arange(len(counts)), counts)
            train = np.bincount(rank[of[~test[doc]]], minlength=len(order))
            tokens = np.full(len(hashes) + len(counts), len(order), np.int64)
            ends = np.cumsum(counts + 1) - 1
            inner = np.ones(len(tokens), bool)
            inner[ends] = False
            tokens[inner] = rank[of]
            ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
            row = {"block": pa.array([number], pa.int64()),
                   "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                   "held_out": pa.array([test.tolist()], pa.list_(pa.bool_())),
                   "length": pa.array([(counts + 1).tolist()], pa.list_(pa.int32())),
                   "tokens": pa.array([planes(tokens)], pa.binary()),
                   "words": pa.array([(distinct[order] ^ _SIGN).view(np.int64).tobytes()], pa.binary()),
                   "n": pa.array([planes(train)], pa.binary()),
                   "slot": pa.array([slots[first[order]].tobytes()], pa.binary())}
            number += 1
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        for batch in batches:
            for part in chunks(batch):
                texts = column(part, "text")
                if size and size + texts.nbytes > BLOCK_BYTES:
                    yield out()
                    held, size = [], 0
                hashes, slots, counts = tokens_of(texts)
                held.append((column(part, "doc_id"), column(part, "held_out").to_pylist(), hashes, slots, counts))
                size += texts.nbytes
        if held:
            yield out()

    return d.mapInArrow(lean(run), f"block bigint, ids array<{id_type}>, held_out array<boolean>, length array<int>, "
                             "tokens binary, words binary, n binary, slot binary")


def frequent_words(stored: DataFrame, share: float) -> DataFrame:
    """(word, c): training counts over the blocks in which a word is at least
    ``share`` of the training tokens; a word that is so in the corpus is so in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, n in rows_of(batch, "words", "n"):
                w, many = np.frombuffer(words, np.int64), from_planes(n)
                some = many > 0
                some &= many >= share * many.sum()
                yield pa.RecordBatch.from_arrays([pa.array(w[some]), pa.array(many[some])], ["word", "n"])

    return (stored.select("words", "n").mapInArrow(lean(run), "word bigint, n bigint")
            .groupBy("word").agg(F.sum("n").alias("c")))


# ---- exchange clustering ----------------------------------------------------

@dataclass
class Units:
    """What is clustered first: core words (sorted signed hashes), endings, the end
    token (last). ``classes`` has a class for each."""
    head: np.ndarray
    classes: np.ndarray

    def of_words(self, words: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Unit of each word of a block, and of the end token behind them."""
        out = len(self.head) + slots.astype(np.int64)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, words), len(self.head) - 1)
            hit = self.head[at] == words
            out[hit] = at[hit]
        return np.append(out, len(self.classes) - 1)


def _previous(tokens: np.ndarray, end: int) -> np.ndarray:
    """The token before each: the end token before a text's first word, which is
    also what stands before it in the block."""
    return np.concatenate([[end], tokens[:-1]])


def context_counts(stored: DataFrame, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """(before, after): how often each unit stands before, and after, a word of
    each class in the training texts; unit x class."""
    spark = stored.sparkSession
    shared = spark.sparkContext.broadcast(units)
    n_units = len(units.classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = shared.value
        classes = u.classes.astype(np.int32)
        before = np.zeros(n_units * CLASSES, np.int64)
        after = np.zeros(n_units * CLASSES, np.int64)
        for batch in batches:
            for held, length, tokens, words, slot in rows_of(batch, "held_out", "length", "tokens", "words", "slot"):
                unit = u.of_words(np.frombuffer(words, np.int64), np.frombuffer(slot, np.uint16)).astype(np.int32)
                t = from_planes(tokens, np.int32)
                train = np.repeat(~np.array(held, bool), length)
                q = unit[t[train]]
                p = unit[_previous(t, len(unit) - 1)[train]]
                before += np.bincount(p * CLASSES + classes[q], minlength=len(before))
                after += np.bincount(q * CLASSES + classes[p], minlength=len(after))
        for kind, x in enumerate((before, after)):
            x = x.reshape(n_units, CLASSES)
            some = np.flatnonzero(x.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), kind, np.int32)), pa.array(some.astype(np.int32)),
                 *[pa.array(np.ascontiguousarray(x[some, c])) for c in range(CLASSES)]],
                ["kind", "unit", *[f"c{c}" for c in range(CLASSES)]])

    names = [f"c{c}" for c in range(CLASSES)]
    got = (stored.select("held_out", "length", "tokens", "words", "slot")
           .mapInArrow(lean(run), "kind int, unit int, " + ", ".join(f"{c} bigint" for c in names))
           .groupBy("kind", "unit").agg(*[F.sum(c).alias(c) for c in names]).toArrow())
    out = np.zeros((2, n_units, CLASSES), np.int64)
    if got.num_rows:
        out[got["kind"].to_numpy(), got["unit"].to_numpy()] = np.column_stack([got[c].to_numpy() for c in names])
    return out[0], out[1]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(units: Units, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """One round of exchange: the new class of every unit. Each unit in turn,
    the most frequent first, goes where the class bigram likelihood
    sum f(G) - sum f(rows) - sum f(columns), f(x) = x log x, is highest."""
    classes = units.classes.copy()
    g = np.zeros((CLASSES, CLASSES))
    np.add.at(g, classes, before.astype(float))
    row, col = g.sum(axis=1), g.sum(axis=0)
    total = before.sum(axis=1)
    diagonal = np.arange(CLASSES)
    for u in np.argsort(-total[:-1], kind="stable"):
        if not total[u]:
            break
        a, r, l = classes[u], before[u].astype(float), after[u].astype(float)
        g[a] -= r
        g[:, a] -= l
        np.maximum(g, 0.0, out=g)
        row[a] -= r.sum()
        col[a] -= l.sum()
        plus_r, plus_l = g + r, g.T + l
        gain = (_xlogx(plus_r) - _xlogx(g)).sum(axis=1) + (_xlogx(plus_l) - _xlogx(g.T)).sum(axis=1)
        d = g[diagonal, diagonal]
        gain += _xlogx(d + r + l) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
        gain -= _xlogx(row + r.sum()) - _xlogx(row) + _xlogx(col + l.sum()) - _xlogx(col)
        gain[0] = -np.inf  # the end token's own class
        b = int(np.argmax(gain))
        if gain[b] <= gain[a] + 1e-9:
            b = a
        g[b] += r
        g[:, b] += l
        row[b] += r.sum()
        col[b] += l.sum()
        classes[u] = b
    return classes


def likelihood(before: np.ndarray, classes: np.ndarray) -> float:
    """The part of the class bigram log likelihood that depends on the classes."""
    g = np.zeros((CLASSES, CLASSES))
    np.add.at(g, classes, before.astype(float))
    return float(_xlogx(g).sum() - _xlogx(g.sum(axis=0)).sum() - _xlogx(g.sum(axis=1)).sum())


def cluster(stored: DataFrame, head: np.ndarray, rounds: int = ROUNDS) -> tuple[Units, np.ndarray]:
    """The clustered units and their ``before`` counts under the final classes.
    Counts are a round old while units move, so the best round is kept."""
    n = len(head) + ENDINGS
    start = 1 + np.arange(n) % (CLASSES - 1)
    units = Units(head, np.append(start, 0))
    before, after = context_counts(stored, units)
    best = likelihood(before, units.classes), units, before
    for _ in range(rounds):
        units = Units(head, exchange(units, before, after))
        before, after = context_counts(stored, units)
        best = max(best, (likelihood(before, units.classes), units, before), key=lambda x: x[0])
    return best[1], best[2]


# ---- every other word -------------------------------------------------------

def contexts(stored: DataFrame, units: Units) -> DataFrame:
    """(word, seen), a row per block and training word outside the core. ``seen`` is
    bytes: the class of the word's ending, then a code for each of its neighbours:
    the class of the token behind it, ``CLASSES`` + the class of the one before it."""
    shared = stored.sparkSession.sparkContext.broadcast(units)
    kinds = 1 + 2 * CLASSES  # of bytes: the ending's class, then the codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = shared.value
        for batch in batches:
            for held, length, tokens, words, slot in rows_of(batch, "held_out", "length", "tokens", "words", "slot"):
                w = np.frombuffer(words, np.int64)
                unit = u.of_words(w, np.frombuffer(slot, np.uint16))
                classes = u.classes[unit]
                other = unit >= len(u.head)
                other[-1] = False
                t = from_planes(tokens)
                train = np.repeat(~np.array(held, bool), length)
                q, p = t[train], _previous(t, len(unit) - 1)[train]
                first, second = other[p], other[q]
                local = np.unique(q[second])
                keys = np.sort(np.concatenate([local * kinds, p[first] * kinds + 1 + classes[q[first]],
                                               q[second] * kinds + 1 + CLASSES + classes[p[second]]]))
                code = keys % kinds
                seen = np.where(code == 0, classes[keys // kinds], code - 1).astype(np.uint8)
                cuts = np.append(np.searchsorted(keys, local * kinds), len(keys)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[local]), pa.Array.from_buffers(pa.binary(), len(local),
                                                               [None, pa.py_buffer(cuts), pa.py_buffer(seen)])],
                    ["word", "seen"])

    return (stored.select("held_out", "length", "tokens", "words", "slot")
            .mapInArrow(lean(run), "word bigint, seen binary"))


def best_classes(of: np.ndarray, start: np.ndarray, code: np.ndarray, n: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The class of every word that raises the class bigram likelihood most, the
    other words staying where they are. ``of`` is the word of each context count,
    ``start`` the class of each word now, ``g`` the class bigram table with it."""
    m, entry = len(start), np.arange(len(of))
    sides = np.zeros((2, m, CLASSES))  # as first, as second word of a bigram
    side, near = code // CLASSES, code % CLASSES
    np.add.at(sides, (side, of, near), n)
    word, now = np.arange(m), start[of]
    gain = np.zeros((m, CLASSES))
    # cells (b, near) or (near, b) for every class b, without the word itself
    cell = np.where(side[:, None] == 0, g[:, near].T, g[near])
    cell -= np.where((near == now)[:, None], sides[1 - side, of], 0.0)
    cell[entry, now] -= n
    np.maximum(cell, 0.0, out=cell)
    np.add.at(gain, of, _xlogx(cell + n[:, None]) - _xlogx(cell))
    r, l = sides
    d = np.tile(g.diagonal(), (m, 1))
    d[word, start] -= r[word, start] + l[word, start]
    np.maximum(d, 0.0, out=d)
    gain += _xlogx(d + r + l) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
    for whole, own in ((g.sum(axis=1), r.sum(axis=1)), (g.sum(axis=0), l.sum(axis=1))):
        rest = np.tile(whole, (m, 1))
        rest[word, start] -= own
        gain -= _xlogx(rest + own[:, None]) - _xlogx(rest)
    gain[:, 0] = -np.inf  # the end token's own class
    best = gain.argmax(axis=1)
    return np.where(gain[word, best] > gain[word, start] + 1e-9, best, start)


def word_classes(found: DataFrame, g: np.ndarray) -> DataFrame:
    """(word, c, class) of the words of ``contexts``: training count and best class.
    Rows come sorted by word; the last word's sums are carried on, so memory is
    bounded however many rows a word has."""
    shared = found.sparkSession.sparkContext.broadcast(g)
    codes = 2 * CLASSES

    def settled(words: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        of, code = np.nonzero(n)
        best = best_classes(of, start, code, n[of, code].astype(float), shared.value)
        c = n[:, CLASSES:].sum(axis=1)  # every occurrence has one token before it
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(c), pa.array(best.astype(np.int16))],
                                          ["word", "c", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, codes), np.int64)
        for batch in gathered(batches, ROWS):
            word = batch["word"].to_numpy()
            raw, cuts = buffer_of(batch["seen"].combine_chunks())
            row = np.repeat(np.arange(len(word)), np.diff(cuts))
            inner = np.ones(len(raw), bool)
            inner[cuts[:-1]] = False
            distinct, first, of = np.unique(np.concatenate([words, word]), return_index=True, return_inverse=True)
            start = np.concatenate([start, raw[cuts[:-1]].astype(np.int64)])[first]
            sums = np.bincount(of[len(words) + row[inner]] * codes + raw[inner],
                               minlength=len(distinct) * codes).reshape(-1, codes)
            sums[:len(words)] += n  # the word carried on is the least
            if len(distinct) > 1:
                yield settled(distinct[:-1], start[:-1], sums[:-1])
            words, start, n = distinct[-1:], start[-1:], sums[-1:]
        if len(words):
            yield settled(words, start, n)

    return (found.repartition("word").sortWithinPartitions("word")
            .mapInArrow(lean(run), "word bigint, c bigint, class smallint"))


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches, several as one of at least ``rows`` rows; none is empty."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


# ---- blocks with counts and classes -----------------------------------------

def _per_text(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    done = np.concatenate([[0.0], np.cumsum(x)])
    ends = np.cumsum(length)
    return done[ends] - done[ends - length]


@dataclass
class Core:
    """The core's units with the training counts of its words."""
    units: Units
    c: np.ndarray


def classed_blocks(stored: DataFrame, core: Core, known: DataFrame) -> DataFrame:
    """(ids, held_out, length, plus, known, classes): a row per block. Of its texts:
    the sum of log10(count + 1) over their words and how many words have a training
    count; and the class of every token, which is all that the model asks further."""
    spark = stored.sparkSession
    shared = spark.sparkContext.broadcast(core)
    keep = ["block", "ids", "held_out", "length", "tokens"]
    types = {f.name: f.dataType.simpleString() for f in stored.schema.fields}

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = shared.value.units
        for batch in batches:
            for block, words, slot in rows_of(batch, "block", "words", "slot"):
                w = np.frombuffer(words, np.int64)
                local = np.flatnonzero(u.of_words(w, np.frombuffer(slot, np.uint16))[:-1] >= len(u.head))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(local), block)), pa.array(local.astype(np.int32)),
                                                  pa.array(w[local])], ["block", "local", "word"])

    def of_core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, counts = shared.value.units, np.append(shared.value.c, 0)
        for batch in batches:
            c, classes = [], []
            for words, slot in rows_of(batch, "words", "slot"):
                unit = u.of_words(np.frombuffer(words, np.int64), np.frombuffer(slot, np.uint16))[:-1]
                c.append(counts[np.minimum(unit, len(u.head))].astype("<i8").tobytes())
                classes.append(u.classes[unit].astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in keep], pa.array(c, pa.binary()),
                                              pa.array(classes, pa.binary())], [*keep, "c", "classes"])

    def meet(block: pa.Table, words: pa.Table) -> pa.Table:
        c = np.frombuffer(block["c"][0].as_py(), "<i8").copy()
        classes = np.frombuffer(block["classes"][0].as_py(), np.uint8).copy()
        local = words["local"].to_numpy()
        c[local] = words["c"].to_numpy()
        classes[local] = words["class"].to_numpy()
        t = from_planes(block["tokens"][0].as_py())
        c, classes = np.append(c, 0), np.append(classes, 0)  # the end token's count is for the model
        length = np.array(block["length"][0].as_py(), np.int64)
        plus, some = _per_text(np.log10(c + 1.0)[t], length), _per_text((c > 0)[t].astype(float), length)
        return pa.table({**{k: block[k] for k in keep[1:-1]}, "plus": pa.array([plus.tolist()], pa.list_(pa.float64())),
                         "known": pa.array([some.astype(np.int64).tolist()], pa.list_(pa.int64())),
                         "classes": pa.array([classes[t].astype(np.uint8).tobytes()], pa.binary())})

    looked_up = (stored.select("block", "words", "slot")
                 .mapInArrow(lean(others), "block bigint, local int, word bigint")
                 .join(known, "word").select("block", "local", "c", "class"))
    named = ", ".join(f"{c} {types[c]}" for c in keep)
    return (stored.drop("n").mapInArrow(lean(of_core), f"{named}, c binary, classes binary").groupBy("block")
            .cogroup(looked_up.groupBy("block"))
            .applyInArrow(meet, ", ".join(f"{c} {types[c]}" for c in keep[1:-1])
                          + ", plus array<double>, known array<bigint>, classes binary"))


def class_bigrams(ready: DataFrame) -> np.ndarray:
    """How often a token of each class follows one of each class in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for held, length, classes in rows_of(batch, "held_out", "length", "classes"):
                q = np.frombuffer(classes, np.uint8).astype(np.int64)
                train = np.repeat(~np.array(held, bool), length)
                g += np.bincount((_previous(q, 0) * CLASSES + q)[train], minlength=len(g))
        some = np.flatnonzero(g)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(g[some])], ["cell", "n"])

    got = (ready.select("held_out", "length", "classes").mapInArrow(lean(run), "cell bigint, n bigint")
           .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    g = np.zeros(CLASSES * CLASSES, np.int64)
    g[got["cell"].to_numpy()] = got["n"].to_numpy()
    return g.reshape(CLASSES, CLASSES)


# ---- scores -----------------------------------------------------------------

@dataclass
class ClassModel:
    transition: np.ndarray  # log10 P(class | class before)
    emission: np.ndarray    # log10 of each class's emission denominator
    train_tokens: int
    types: int              # distinct training tokens
    ends: int               # training count of the end token


def class_model(g: np.ndarray, types: np.ndarray) -> ClassModel:
    """The model from class bigrams and the number of distinct words per class."""
    after = g.sum(axis=0)  # tokens of each class
    train_tokens = int(after.sum())
    # Witten-Bell between the class bigram and the add-one class unigram
    unigram = (after + 1) / (train_tokens + CLASSES)
    rows, kinds = g.sum(axis=1, keepdims=True), np.maximum((g > 0).sum(axis=1, keepdims=True), 1)
    transition = np.log10((g + kinds * unigram) / (rows + kinds))
    emission = np.log10(after + types + 1)
    emission[0] = 0.0  # the end token is the only word of its class
    ended = int(after[0])
    return ClassModel(transition, emission, train_tokens, int(types.sum()) + (ended > 0), ended)


def fit(stored: DataFrame, core_size: int = CORE, rounds: int = ROUNDS) -> tuple[ClassModel, DataFrame]:
    """The model of stored blocks, and the blocks with counts and classes."""
    top = (frequent_words(stored, 1 / (4 * core_size)).orderBy(F.col("c").desc(), "word").limit(core_size)
           .select("word").toArrow())
    head = np.sort(top["word"].to_numpy())
    units, before = cluster(stored, head, rounds)
    c = before[:len(head)].sum(axis=1)  # a token stands behind each word
    g = np.zeros((CLASSES, CLASSES))
    np.add.at(g, units.classes, before.astype(float))
    known = cut_lineage(word_classes(contexts(stored, units), g))
    ready = cut_lineage(classed_blocks(stored, Core(units, c), known))
    types = np.bincount(units.classes[:len(head)], minlength=CLASSES)
    got = known.groupBy("class").agg(F.count(F.lit(1)).alias("n")).toArrow()
    types[got["class"].to_numpy()] += got["n"].to_numpy()
    return class_model(class_bigrams(ready), types), ready


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          core_size: int = CORE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram), score (the class model's log10 probability) and perplexity."""
    stored = cut_lineage(blocks(docs, held_out, id_col, text_col))
    model, ready = fit(stored, core_size, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = stored.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                length = np.array(column(batch, "length")[i].as_py(), np.int64)
                plus = np.array(column(batch, "plus")[i].as_py())
                some = np.array(column(batch, "known")[i].as_py(), np.int64) + (m.ends > 0)
                base = plus + np.log10(m.ends + 1) - length * np.log10(m.train_tokens + m.types + 1)
                # in the class model the end token is certain once its class is given
                q = np.frombuffer(column(batch, "classes")[i].as_py(), np.uint8).astype(np.int64)
                by_class = plus + _per_text(m.transition[_previous(q, 0), q] - m.emission[q], length)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "ids")[i].values, column(batch, "held_out")[i].values, pa.array(length),
                     pa.array(some), pa.array(np.full(len(length), m.train_tokens)), pa.array(base), pa.array(by_class)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = ready.mapInArrow(lean(run), f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, "
                                         "train_tokens bigint, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))

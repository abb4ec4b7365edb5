"""Byte-level BPE by padded numpy matrices, with a public rank file.

A text is cut by a pattern; each match is encoded by itself. The matches that a
worker has not met before are put into matrices by length (rows of up to 8, 16,
32 ... bytes, padded), one id per cell. In each round every row looks up the
rank of its changed pairs in a hash table of pairs, merges its leftmost pair of
least rank, and closes the gap; rows without a pair to merge leave the matrix.

A match longer than ``LONGEST`` is a matrix of one row, and its round takes the
leftmost merge together with those after it that the next rounds would take
anyway: all pairs of that rank, left to right, up to the first whose merge makes
a pair of lower rank. A match that is itself in the vocabulary has that id.
Decoding concatenates the bytes of the ids.

The file holds one line per token, its bytes in base 64 and its rank, which is
its id. A worker keeps the ids of matches up to ``REMEMBERED`` bytes, then
starts afresh; matches of more than ``LONGEST`` bytes are not kept.

Defined cases: a null or empty text has no ids; rows are independent, so
repeated rows give repeated results; an empty table gives no rows; texts and
matches may be of any length; other columns are ignored. No shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kpiforge.llm.common import chunks, column, lean, pick, text_or_empty
from kpiforge.llm.pieces import gather

LONGEST = 256             # bytes of a match that shares a matrix with others
SHORTEST = 8              # widest row of the first matrix
CELLS = 1 << 18           # cells of a matrix
REMEMBERED = 32 << 20     # bytes a worker's memory of matches may take, about
_PER_MATCH = 200          # bytes of a remembered match besides its letters and ids
NO_RANK = np.int32(2**31 - 1)


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of the merge,
    which is its rank too; ``NO_RANK`` where there is none."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = self.key(left, right)
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NO_RANK, np.int32)
        todo = np.arange(len(keys))
        at = self.slot(keys)
        while len(todo):  # one key of each free slot settles, the others move on
            free = np.flatnonzero(self.keys[at] == -1)
            slots, first = np.unique(at[free], return_index=True)
            settled = free[first]
            self.keys[slots] = keys[todo[settled]]
            self.values[slots] = merged[todo[settled]]
            stay = np.ones(len(todo), bool)
            stay[settled] = False
            todo, at = todo[stay], (at[stay] + 1) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs (arrays of one dimension); a negative id has none."""
        out = np.full(len(left), NO_RANK, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys = self.key(left[open_], right[open_])
        at = self.slot(keys)
        while len(open_):
            seen = self.keys[at]
            hit = seen == keys
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (seen != -1)
            open_, keys, at = open_[on], keys[on], (at[on] + 1) & self.mask
        return out


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        self.pattern = regex.compile(pattern)
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f))}
        ranks = self.ranks
        # every way to put a token together from two others
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        strings = [b""] * size
        for t, r in ranks.items():
            strings[r] = t
        self.length = np.array([len(t) for t in strings], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(strings), np.uint8)
        self.memory: dict[str, bytes] = {}
        self.room = REMEMBERED

    # matches ----------------------------------------------------------------

    def merge_rows(self, ids: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
        """Ids of every row of a padded matrix (cells beyond a row's length are -1)."""
        done: list[np.ndarray] = [None] * len(ids)
        row = np.arange(len(ids))
        rank = np.full(ids.shape, NO_RANK, np.int32)  # of the pair that starts at a cell
        rank[:, :-1] = self.pairs.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while True:
            best = rank.argmin(axis=1)  # the leftmost of the least
            least = rank[np.arange(len(row)), best]
            out = least == NO_RANK
            if out.any():
                for k in np.flatnonzero(out).tolist():
                    done[row[k]] = ids[k, :length[k]].copy()
                on = ~out
                row, best, least, length = row[on], best[on], least[on], length[on]
                if not len(row):
                    return done
                width = int(length.max())
                ids, rank = ids[on, :width], rank[on, :width]
            r, width = np.arange(len(row)), ids.shape[1]
            # close the gap: what lies right of the merged pair moves one cell left
            ids[r, best] = least
            cells = np.arange(width - 1)
            later = cells > best[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(later, rank[:, 1:], rank[:, :-1])
            ids[:, -1] = -1
            rank[:, -1] = NO_RANK
            length = length - 1
            after = np.where(best + 1 < width, ids[r, np.minimum(best + 1, width - 1)], -1)
            rank[r, best] = self.pairs.rank(ids[r, best], after)
            b = np.flatnonzero(best > 0)
            rank[b, best[b] - 1] = self.pairs.rank(ids[b, best[b] - 1], ids[b, best[b]])

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """Ids of one row of any length."""
        rank = np.append(self.pairs.rank(ids[:-1], ids[1:]), NO_RANK)
        while len(ids) > 1:
            least = rank.min()
            if least == NO_RANK:
                break
            at = np.flatnonzero(rank == least)
            # of pairs that overlap, the first, third ... of each chain
            head = np.concatenate([[True], np.diff(at) != 1])
            chain = np.flatnonzero(head)[np.cumsum(head) - 1]
            at = at[(np.arange(len(at)) - chain) % 2 == 0]
            before = np.where(at > 0, ids[at - 1], -1)
            before[1:][at[1:] - 2 == at[:-1]] = least  # the pair before has just been merged
            after = np.append(ids, -1)[at + 2]
            made = np.full(len(at), least, np.int32)
            lower = (self.pairs.rank(before, made) < least) | (self.pairs.rank(made, after) < least)
            if lower.any():
                at = at[:int(lower.argmax()) + 1]
            ids[at] = least
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            now = np.cumsum(keep) - 1
            ids, rank = ids[keep], rank[keep]
            touched = np.unique(np.concatenate([now[at], np.maximum(now[at] - 1, 0)]))
            rank[touched] = self.pairs.rank(ids[touched], np.append(ids, -1)[touched + 1])
        return ids

    def merge(self, matches: list[bytes]) -> list[np.ndarray]:
        """Ids of every match."""
        out: list[np.ndarray] = [None] * len(matches)
        size = np.array([len(m) for m in matches], np.int64)
        for k in np.flatnonzero(size > LONGEST).tolist():
            out[k] = self.merge_long(self.of_byte[np.frombuffer(matches[k], np.uint8)])
        lower, width = 0, SHORTEST
        while lower < LONGEST:
            bucket = np.flatnonzero((size > lower) & (size <= width))
            for a in range(0, len(bucket), CELLS // width):
                part = bucket[a:a + CELLS // width]
                length = size[part]
                inside = np.arange(int(length.max())) < length[:, None]
                ids = np.full(inside.shape, -1, np.int32)
                ids[inside] = self.of_byte[np.frombuffer(b"".join([matches[k] for k in part.tolist()]), np.uint8)]
                for k, got in zip(part.tolist(), self.merge_rows(ids, length)):
                    out[k] = got
            lower, width = width, 2 * width
        for k, m in enumerate(matches):
            whole = self.ranks.get(m)
            if whole is not None:
                out[k] = np.array([whole], np.int32)
        return out

    # texts ------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of every text."""
        cut = [self.pattern.findall(t) for t in texts]
        if self.room <= 0:
            self.memory, self.room = {}, REMEMBERED
        memory = self.memory
        new = [m for m in dict.fromkeys(m for c in cut for m in c) if m not in memory]
        fresh: dict[str, bytes] = {}
        for m, ids in zip(new, self.merge([m.encode() for m in new])):
            packed = ids.astype("<u4").tobytes()
            if len(m) > LONGEST:
                fresh[m] = packed
            else:
                memory[m] = packed
                self.room -= _PER_MATCH + len(m) + len(packed)
        if fresh:
            memory = memory | fresh
        return [np.frombuffer(b"".join([memory[m] for m in c]), "<u4") for c in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, concatenated."""
        return gather(self.pool, self.start[ids], self.length[ids]).tobytes()


_loaded: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """The rank file at ``path``, read once per process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    d = text_or_empty(docs, id_col, text_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for part in chunks(batch):
                ids = bpe.encode(column(part, "text").to_pylist())
                at = np.cumsum([0] + [len(x) for x in ids])
                flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), lists], ["doc_id", "ids"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes binary): the bytes of each row's ids; a null list has none."""
    d = pick(coded, doc_id=id_col, ids=ids_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            got = [bpe.decode(np.array(x or [], np.int64)) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(got, pa.binary())],
                                             ["doc_id", "bytes"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes every
    text in one pass and keeps the digests only, so that neither the ids nor the
    decoded bytes leave the task."""
    d = text_or_empty(docs, id_col, text_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            for part in chunks(batch):
                ids = bpe.encode(column(part, "text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

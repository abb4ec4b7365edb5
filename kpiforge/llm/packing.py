"""Packing of documents into token sequences by minimum bin slack.

A document is its token ids and one end id. Whatever fills whole windows is
cut off first; the remaining lengths wait in a pool. Each window takes the
longest waiting piece and then the multiset of waiting lengths that fills it
closest to capacity: a subset-sum dynamic program over a bitset of reachable
fill levels, one step per distinct length with its count, from which the
counts are traced back. Slack left by the best multiset is filled by cutting
one waiting piece. When a task has no more input, the rest that fills no window is laid into
sequences of power-of-two lengths, which need no padding.

A task packs the documents it reads, as a stream: nothing is shuffled, at most
``POOL`` pieces (each below the window length) wait, and only each task's last
windows are short. Sequence ids hold the task number in their upper bits, so
they are unique. The input must be read in a fixed order (a stored table), as
a repeated task must lay out the same sequences.

Defined cases: a null or empty text is a document of the end id alone; a null
doc_id is kept; repeated rows are packed as separate documents; an empty table
gives no sequences; other columns are ignored.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kpiforge.llm.common import chunks, column, lean, text_or_empty
from kpiforge.llm.pieces import Pieces

WINDOW = 4096
END_ID = 2
POOL = 4096  # waiting pieces of a task
TEXT_BYTES = 2 << 20  # text encoded at once: the more, the fewer distinct pieces are looked up again


class FileTokenizer:
    """A ``tokenizers`` file of a vocabulary whose words end in a suffix."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
        from tokenizers import Tokenizer
        self.coder = Tokenizer.from_file(path)
        self.coder.no_padding()
        self.coder.no_truncation()
        vocab = self.coder.get_vocab()
        self._ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self._ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.pieces = Pieces(self._learn, lambda texts: [np.frombuffer(x, "<u4") for x in self._ids(texts)])

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.coder.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, unknown: list[str]) -> list[bytes]:
        """Words of letters go many to a call: each is one word to the
        tokenizer too, so its ids end where a word-end symbol stands."""
        plain = [w.isalpha() and (w.isascii() or is_normalized("NFC", w) and w.lower().isalpha()) for w in unknown]
        words = [w for w, p in zip(unknown, plain) if p]
        flat = b"".join(self._ids([" ".join(words[i:i + 500]) for i in range(0, len(words), 500)]))
        ends = (np.flatnonzero(self._ends_word[np.frombuffer(flat, "<u4")]) + 1) * 4
        if len(ends) != len(words):
            raise ValueError("words and word ends differ in number")
        cuts = [0, *ends.tolist()]
        known = iter([flat[a:b] for a, b in zip(cuts, cuts[1:])])
        other = iter(self._ids([w for w, p in zip(unknown, plain) if not p]))
        return [next(known) if p else next(other) for p in plain]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offset of each text's first id)."""
        return self.pieces.encode(texts)


_loaded: dict[str, FileTokenizer] = {}


def tokenizer(path: str) -> FileTokenizer:
    if path not in _loaded:
        _loaded[path] = FileTokenizer(path)
    return _loaded[path]


def best_fill(counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The fill closest to ``capacity`` from a multiset of lengths, and how
    many pieces of each length it takes. Bit s of the bitset says that fill s
    can be reached with the lengths looked at so far; the longest come first
    and the search ends once the capacity itself can be reached."""
    reach, steps = 1, []
    full = 1 << capacity
    mask = (full << 1) - 1
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        before = reach
        for _ in range(min(counts[length], capacity // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            reach = grown
        steps.append((length, before))
        if reach & full:
            break
    best = fill = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for length, before in reversed(steps):
        n = 0
        while not before >> fill & 1:
            fill -= length
            n += 1
        if n:
            taken[length] = n
    return best, taken


class Packer:
    """Packs the pieces of one task; ``add`` and ``finish`` yield rows
    (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int, pool: int = POOL):
        self.window, self.sequence, self.pool = window, first_sequence, pool
        self.waiting: dict[int, list] = defaultdict(list)  # length -> pieces (doc, start, ids, doc_tokens)
        self.n_waiting = 0

    def _wait(self, piece: tuple) -> None:
        self.waiting[len(piece[2])].append(piece)
        self.n_waiting += 1

    def _take(self, length: int) -> tuple:
        group = self.waiting[length]
        piece = group.pop()
        if not group:
            del self.waiting[length]
        self.n_waiting -= 1
        return piece

    def _lay(self, parts: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in parts:
            yield doc, start, ids, total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def _cut(self, piece: tuple, length: int) -> tuple[tuple, tuple]:
        doc, start, ids, total = piece
        return (doc, start, ids[:length], total), (doc, start + length, ids[length:], total)

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        piece = (doc, 0, ids, len(ids))
        while len(piece[2]) >= self.window:
            head, piece = self._cut(piece, self.window)
            yield from self._lay([head])
        if len(piece[2]):
            self._wait(piece)
        while self.n_waiting > self.pool:
            yield from self._window()

    def _window(self) -> Iterator[tuple]:
        """One full window from the pool, which must hold enough tokens."""
        parts = [self._take(max(self.waiting))]
        room = self.window - len(parts[0][2])
        fill, taken = best_fill({n: len(g) for n, g in self.waiting.items()}, room)
        for length, n in taken.items():
            parts += [self._take(length) for _ in range(n)]
        if fill < room:
            # what still waits is longer than the slack, as the fill is the best one
            head, rest = self._cut(self._take(min(self.waiting)), room - fill)
            parts.append(head)
            self._wait(rest)
        yield from self._lay(parts)

    def finish(self) -> Iterator[tuple]:
        left = sum(n * len(g) for n, g in self.waiting.items())
        while left >= self.window:
            yield from self._window()
            left -= self.window
        rest = [p for n in sorted(self.waiting, reverse=True) for p in self.waiting[n]]
        self.waiting.clear()
        self.n_waiting = 0
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            parts = []
            while room:
                piece = rest.pop(0)
                if len(piece[2]) > room:
                    piece, more = self._cut(piece, room)
                    rest.insert(0, more)
                parts.append(piece)
                room -= len(piece[2])
            yield from self._lay(parts)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, ids (binary, little-endian uint32),
    doc_tokens, sequence_id, offset. A sequence is its pieces by offset,
    padded to ``window`` unless its length is a power of two."""
    d = text_or_empty(docs, id_col, text_col)
    id_type = d.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        kind = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2].tobytes() for r in rows], pa.binary()),
                pa.array([len(r[2]) for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()),
                pa.array([r[5] for r in rows], pa.int64())],
                ["doc_id", "start", "ids", "length", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            kind = column(batch, "doc_id").type
            for part in chunks(batch, most=TEXT_BYTES):
                rows = []
                ids, at = coder.encode(column(part, "text"))
                for i, doc in enumerate(column(part, "doc_id").to_pylist()):
                    rows += packer.add(doc, np.concatenate([ids[at[i]:at[i + 1]], end]))
                if rows:
                    yield out(rows)
        if kind is not None:
            rows = []
            for row in packer.finish():
                rows.append(row)
                if len(rows) >= 2000:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)

    return d.mapInArrow(lean(run), f"doc_id {id_type}, start bigint, ids binary, length bigint, doc_tokens bigint, "
                             "sequence_id bigint, offset bigint")

"""Periodic runs of words: a suffix automaton whose link tree is kept by link-cut access.

Words are appended one by one to a suffix automaton. The nodes from a prefix's
state up to the root are its suffixes, and every node carries the end of its
last occurrence as its colour. Appending word i recolours that whole path to i:
the link-cut access walks it by segments of one colour. A segment whose deepest
node has length b and whose colour is e says that the suffix of b words also
ends at e, and no longer one does, so the words have period d = i - e over the
last b + d of them. Where d <= b that is a square, and it starts exactly where
the run of that period starts; the last i with the same start and period is the
run's end. The segment holding the suffix of d words always has the run's
smallest period, so every run is met at each of its ends.

Only stretches that can hold a run reach the automaton. A run of length >= 4
periods holds each of its words four times or more, so words that are rarer in
their text (then in their stretch, again until nothing changes) part it into
stretches that no run crosses; neither can a rarer neighbour extend one.

Defined cases: a null or empty text, or one of white space, has no words and no
runs; a null id is kept; repeated rows give repeated results; a very long text
takes about 1 KB of memory for each word of its longest stretch; an empty table
gives no rows; other columns are ignored. There is no shuffle and no state
between rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from kpiforge.llm.common import chunks, column, lean, text_or_empty
from kpiforge.llm.textvec import SPACE, buffer_of, spans

LEAST_WORDS = 6   # a shorter stretch is no run
LEAST_PERIODS = 4  # nor is one of fewer periods
NARROWINGS = 16   # rounds of parting; more would only save time

RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def runs_of(seq: Sequence, least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of ``seq`` that spans
    ``least_words`` items and ``least_periods`` (two or more) periods, by start,
    then period."""
    # automaton: state 0 is none, state 1 the root
    length, link, step = [0, 0], [0, 0], [{}, {}]
    # link-cut forest: one splay tree per coloured path, ordered by depth; ``up``
    # of a tree's root is the parent of the path's top; its colour sits at the root
    left, right, up, colour = [0, 0], [0, 0], [0, 0], [0, -1 - len(seq)]

    def rotate(v: int) -> None:
        p = up[v]
        g = up[p]
        if left[g] == p:
            left[g] = v
        elif right[g] == p:
            right[g] = v
        up[v] = g
        up[p] = v
        if left[p] == v:
            m = left[p] = right[v]
            right[v] = p
        else:
            m = right[p] = left[v]
            left[v] = p
        if m:
            up[m] = p

    def splay(v: int) -> None:
        p = up[v]
        if left[p] != v and right[p] != v:
            return
        while True:
            g = up[p]
            if left[g] == p:
                rotate(p if left[p] == v else v)
            elif right[g] == p:
                rotate(p if right[p] == v else v)
            else:
                rotate(v)
                colour[v] = colour[p]
                return
            rotate(v)
            p = up[v]
            if left[p] != v and right[p] != v:
                colour[v] = colour[g]  # g was the tree's root
                return

    def state(size: int, moves: dict) -> int:
        length.append(size)
        step.append(moves)
        for x in (link, left, right, up, colour):
            x.append(0)
        return len(length) - 1

    found: dict[tuple[int, int], int] = {}
    last = 1
    for i, c in enumerate(seq):
        new = state(length[last] + 1, {})
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = link[p]
        above = 1
        if p:
            above = step[p][c]
            if length[p] + 1 != length[above]:
                # split: the shorter suffixes of ``q`` get a state of their own,
                # right above it on the same coloured path
                q, above = above, state(length[p] + 1, step[above].copy())
                splay(q)
                m = left[above] = left[q]
                if m:
                    up[m] = above
                left[q] = above
                up[above] = q
                link[above], link[q] = link[q], above
                while p and step[p].get(c) == q:
                    step[p][c] = above
                    p = link[p]
        link[new] = up[new] = above
        last = below = new
        v = above
        while v:
            splay(v)
            e = colour[v]
            d = i - e
            b = length[v]
            if b >= (least_periods - 1) * d and b + d >= least_words:
                found[e - b + 1, d] = i
            if right[v]:
                colour[right[v]] = e
            right[v] = below
            below = v
            v = up[v]
        colour[below] = i
        splay(new)
    return sorted((s, i - s + 1, d) for (s, d), i in found.items())


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts in order, offset of each text's first word)."""
    raw, offsets = buffer_of(texts)
    inside = ~SPACE[raw]
    starts, ends = spans(inside, offsets)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.tobytes()),
                                             pa.py_buffer(raw[inside].tobytes()))
    return words, np.searchsorted(starts, offsets)


def stretches(words: np.ndarray, text: np.ndarray, least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> list[tuple[int, int]]:
    """(start, end) of the stretches of consecutive words of one text that hold
    each of their words ``least_periods`` times or more. ``words`` are word
    numbers, ``text`` the number of the text each lies in."""
    at, part = np.arange(len(words)), text.astype(np.int64)
    size = int(words.max()) + 1 if len(words) else 1
    for _ in range(NARROWINGS):
        _, back, count = np.unique(part * size + words[at], return_inverse=True, return_counts=True)
        keep = count[back] >= least_periods
        if keep.all():
            break
        at, part = at[keep], part[keep]
        part = np.concatenate([[0], np.cumsum((np.diff(at) != 1) | (np.diff(part) != 0))])[:len(at)]
        keep = np.bincount(part)[part] >= least_words if len(part) else part.astype(bool)
        at, part = at[keep], part[keep]
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(part) != 0)]))
    ends = np.append(first[1:], len(at)) - 1
    return list(zip(at[first].tolist(), (at[ends] + 1).tolist()))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs by start, then
    period, and its words joined by one space without those that a run holds
    after its first period."""
    d = text_or_empty(docs, id_col, text_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def part_of(part: pa.RecordBatch) -> pa.RecordBatch:
        words, of = words_of(column(part, "text"))
        ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(part.num_rows), np.diff(of))
        rows: list[tuple[int, int, int, int]] = []  # text, start, length, period
        change = np.zeros(len(ids) + 1, np.int64)  # of the number of runs that drop a word
        for a, b in stretches(ids, text, least_words, least_periods):
            t = int(text[a])
            for s, n, q in runs_of(ids[a:b].tolist(), least_words, least_periods):
                rows.append((t, a + s - int(of[t]), n, q))
                change[a + s + q] += 1
                change[a + s + n] -= 1
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(kept, of), pa.int32()), words.take(pa.array(kept)))
        collapsed = pc.binary_join(lists, pa.scalar(" ", words.type)).cast(pa.string())
        r = np.array(rows, np.int64).reshape(-1, 4)
        fields = pa.StructArray.from_arrays([pa.array(r[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
        runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(r[:, 0], np.arange(part.num_rows + 1)), pa.int32()),
                                        fields)
        return pa.RecordBatch.from_arrays(
            [column(part, "doc_id"), pa.array(np.diff(of)), runs, collapsed],
            ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield part_of(part)

    return d.mapInArrow(lean(run), f"doc_id {id_type}, n_words bigint, runs {RUN_TYPE}, collapsed string")

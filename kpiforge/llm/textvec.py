"""Vectorised word spans and hashes over a whole column of texts.

A word is ``[^\\x20\\x09-\\x0D]+``. All functions work on the UTF-8 buffer of an
Arrow string array at once: a text costs a few array operations per byte and
no Python per word. Hashes are 64-bit, fixed across processes and versions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_LONG_SPAN = 256
_HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)  # the first k bytes of eight
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD6E8FEB86659FD93 | 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (xor-shift and multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls count as empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    n = len(texts)
    _, offs, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, kind, count=n + 1, offset=texts.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` that stay within a text."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    outside = ~inside
    start = inside.copy()
    start[1:] &= outside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= outside[1:] | first[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span's bytes. Eight bytes at a time go through a
    mixing step each, so no algebra of the bytes makes two spans collide; spans
    beyond ``_LONG_SPAN`` bytes are hashed by a library, one by one."""
    if len(starts) == 0:
        return np.zeros(0, _U)
    size = ends - starts
    h = mix(size.astype(_U) * _U(_STEP) + _U(_BASE))
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(8, np.uint8)]), 8)
    at, left, which = starts, size, np.arange(len(starts))
    if len(long := np.flatnonzero(size > _LONG_SPAN)):
        data = raw.data
        h[long] = [xxhash.xxh3_64_intdigest(data[a:b], seed=_BASE) for a, b in zip(starts[long].tolist(), ends[long].tolist())]
        which = np.flatnonzero(size <= _LONG_SPAN)
        at, left = at[which], left[which]
    while len(which):
        block = eights[at].view("<u8")[:, 0] & _HEAD[np.minimum(left, 8)]
        h[which] = mix(h[which] ^ block) * _U(_STEP)
        more = left > 8
        at, left, which = at[more] + 8, left[more] - 8, which[more]
    return mix(h)


class Words:
    """Words of a column of texts: ``starts``/``ends`` in the buffer, ``hash``,
    and ``of``: words of text d are ``of[d]:of[d + 1]``."""

    def __init__(self, texts: pa.Array):
        self.raw, self.offsets = buffer_of(texts)
        self.starts, self.ends = spans(~SPACE[self.raw], self.offsets)
        self.of = np.searchsorted(self.starts, self.offsets)
        self.hash = span_hashes(self.raw, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def doc_index(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.counts())


def windows(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start position, hash) of every window of ``k`` items within one text."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    acc = np.zeros(n - k + 1, dtype=_U)
    weight = 1
    for j in range(k):
        acc += hashes[j:n - k + 1 + j] * _U(weight)
        weight = weight * _STEP & _MASK
    last = np.repeat(of[1:], np.diff(of))  # end of the text each item lies in
    at = np.flatnonzero(np.arange(n - k + 1) + k <= last[:n - k + 1])
    return at, mix(acc[at])


def shingles(hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of the k-word shingles. A text of fewer words
    than ``k`` has one shingle, all its words; a text without words has none."""
    at, h = windows(hashes, of, k)
    short = np.flatnonzero((np.diff(of) > 0) & (np.diff(of) < k))
    if len(short):
        extra = []
        for d in short:
            total, weight = 1, 1
            for x in hashes[of[d]:of[d + 1]].tolist():
                total += x * weight
                weight = weight * _STEP & _MASK
            extra.append(total & _MASK)
        extra = mix(np.array(extra, dtype=_U))
        at = np.concatenate([at, of[short]])
        h = np.concatenate([h, extra])
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
    return h, np.searchsorted(at, of)

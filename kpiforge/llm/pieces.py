"""Ids of whole texts from the ids of their distinct pieces.

For vocabularies whose ids never cross white space and whose words are made of
lower-cased letters, a text's ids are those of its pieces in order. The pieces
of a whole column of texts are found and told apart as array operations, by all
of their bytes; only pieces that this process does not remember are handed to
the encoder, each once.

The memory is bounded by bytes: letters and ids of what it holds, and about
``_PER_PIECE`` more for each. When half of it is full, that half becomes the older
one, whose pieces come over as they are met, and the older one so far goes. Pieces of more
than ``_LONGEST`` bytes (unspaced text) are encoded each time and not kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from kpiforge.llm.textvec import SPACE, buffer_of, spans

REMEMBERED = 96 << 20  # bytes
_PER_PIECE = 200
_LONGEST = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
# second bytes of U+00C0..U+00FF that are letters (not the signs x and :)
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_MARK = np.zeros(256, dtype=bool)
_MARK[[0x2C, 0x2E]] = True


def gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs ``pool[start[i]:start[i] + length[i]]``, concatenated."""
    done = np.cumsum(length)
    total = int(done[-1]) if len(done) else 0
    return pool[np.repeat(start - (done - length), length) + np.arange(total)]


class Pieces:
    """``learn`` gives the packed uint32 ids of each of a list of pieces without
    ASCII white space; ``plain`` the ids of each of a list of whole texts."""

    def __init__(self, learn: Callable[[list[str]], list[bytes]],
                 plain: Callable[[list[str]], list[np.ndarray]], most: int = REMEMBERED):
        self.learn, self.plain, self.most = learn, plain, most
        self.memory: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _keep(self, piece: bytes, packed: bytes) -> None:
        self.memory[piece] = packed
        self.held += _PER_PIECE + len(piece) + len(packed)

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of distinct pieces."""
        if self.held > self.most // 2:
            self.older, self.memory, self.held = self.memory, {}, 0
        out = list(map(self.memory.get, pieces))
        new = []
        for i in [i for i, packed in enumerate(out) if packed is None]:
            out[i] = self.older.get(pieces[i])
            if out[i] is None:
                new.append(i)
            else:
                self._keep(pieces[i], out[i])
        if new:
            for i, packed in zip(new, self.learn([pieces[i].decode() for i in new])):
                out[i] = packed
                if len(pieces[i]) <= _LONGEST:
                    self._keep(pieces[i], packed)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offset of each text's first id)."""
        raw, offsets = buffer_of(texts)
        n = len(raw)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        follows = np.append(raw[1:], np.uint8(0))
        if np.any((raw == 0x3C) & (follows == 0x7C)):  # "<|" may start a special token
            return self._one_by_one(texts)
        # a letter before a combining mark may compose with it: left as it is
        low = np.where(follows < 0xCC, _LOWER[raw], raw)
        inside = ~SPACE[raw]
        starts, ends = spans(inside, offsets)
        # a closing '.' or ',' right after a letter is a word of its own
        last = ends - 1
        before = raw[last - 1]
        letter = _LETTER[before] | (_LATIN[before] & (raw[np.maximum(last - 2, 0)] == 0xC3) & (last - 2 >= starts))
        closing = last[_MARK[raw[last]] & (last > starts) & letter]
        starts, ends = np.sort(np.concatenate([starts, closing])), np.sort(np.concatenate([ends, closing]))

        # only white space lies between the pieces: without it they follow one another
        at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(low[inside].tobytes())])
        coded = pieces.dictionary_encode()
        packed = self._ids_of(coded.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(packed), "<u4")
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        of = coded.indices.to_numpy()
        length = size[of]
        ids = gather(pool, (np.cumsum(size) - size)[of], length)
        done = np.concatenate([[0], np.cumsum(length)])
        return ids, done[np.searchsorted(starts, offsets)]

    def _one_by_one(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self.plain([t or "" for t in texts.to_pylist()])
        return (np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.uint32),
                np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64))

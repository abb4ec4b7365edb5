"""BPE encoding and decoding with a public vocabulary file.

A word's symbols form a doubly linked list; every adjacent pair that has a
merge rank waits in a priority queue, the lowest rank and then the leftmost
first. A popped entry whose two symbols have changed since is stale and is
skipped. Decoding looks up each id's vocabulary string and concatenates them
with the joiner the vocabulary calls for (one space where it has no decoder).

The file is the JSON layout of the ``tokenizers`` library; supported are the
steps of the word-end BPE vocabulary: NFC, white space folding, lower case per
code point, splitting into words, byte-level symbols, a suffix on each word's
last symbol, and added special tokens that are found in the raw text.

White space always separates words there, so a text's ids are those of its
white-space-separated pieces in order; each worker process remembers the ids
of the pieces it has seen, up to a bound (``pieces.Pieces``).

Defined cases: a null or empty text has no ids; a text of white space only has
none either; rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kpiforge.llm.common import chunks, column, lean, pick, text_or_empty
from kpiforge.llm.pieces import Pieces

WORDS_REMEMBERED = 50_000  # merged words a worker keeps, besides its pieces ...
LONGEST_WORD = 64          # ... of so many characters at most

# fixed values: the code points of Unicode White_Space
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006" \
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# python's str.split() also splits on these four, which are not White_Space
_CONTROL_SPACE = "\x1c\x1d\x1e\x1f"
_SPLIT = regex.compile(f"[{WHITE_SPACE}]+")


def white_space_pieces(text: str) -> list[str]:
    """White-space-separated pieces of ``text``."""
    if any(c in text for c in _CONTROL_SPACE):
        return [x for x in _SPLIT.split(text) if x]
    return text.split()


def lower(text: str) -> str:
    """Lower case code point by code point, without the final-sigma rule."""
    return "σ".join(x.lower() for x in text.split("Σ"))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is a
    printable Latin-1 character, else the next one from code point 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.strings: dict[int, str] = {i: s for s, i in self.ids.items()}
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: s for s, i in self.special.items()})
        # (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # \s there means White_Space
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", WHITE_SPACE))
        self.first = {b: self.ids.get(c) for b, c in enumerate(byte_symbols())}
        self.last = {b: self.ids.get(c + self.suffix) for b, c in enumerate(byte_symbols())}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._word_memory: dict[str, bytes] = {}
        self.pieces = Pieces(lambda words: [self.piece_ids(w) for w in words],
                             lambda texts: [self.encode_text(t) for t in texts])

    # one word ---------------------------------------------------------------

    def merge_word(self, symbols: list[int]) -> list[int]:
        """Ids of one word from its byte symbols."""
        n = len(symbols)
        if n < 2:
            return symbols
        merges = self.merges
        get = merges.get
        queue = []
        for i in range(n - 1):
            m = get((symbols[i], symbols[i + 1]))
            if m is not None:
                queue.append((m[0], i, m[1]))
        if not queue:
            return symbols
        heapify(queue)
        after = list(range(1, n + 1))   # n: end of the list
        before = list(range(-1, n - 1))  # -1: start of the list
        gone = -1
        while queue:
            rank, i, merged = heappop(queue)
            j = after[i]
            if symbols[i] == gone or j == n:
                continue
            m = get((symbols[i], symbols[j]))
            if m is None or m[0] != rank:
                continue  # stale: one of the two symbols was merged meanwhile
            symbols[i] = merged
            symbols[j] = gone
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = get((merged, symbols[k]))
                if m is not None:
                    heappush(queue, (m[0], i, m[1]))
            h = before[i]
            if h >= 0:
                m = get((symbols[h], merged))
                if m is not None:
                    heappush(queue, (m[0], h, m[1]))
        return [s for s in symbols if s != gone]

    def word_ids(self, word: str) -> bytes:
        got = self._word_memory.get(word)
        if got is None:
            raw = word.encode()
            first = self.first
            symbols = [first[b] for b in raw]
            symbols[-1] = self.last[raw[-1]]
            got = np.array(self.merge_word([s for s in symbols if s is not None]), "<u4").tobytes()
            if len(word) <= LONGEST_WORD:
                if len(self._word_memory) >= WORDS_REMEMBERED:
                    self._word_memory.clear()
                self._word_memory[word] = got
        return got

    # pieces and texts --------------------------------------------------------

    def piece_ids(self, piece: str) -> bytes:
        """Ids (packed uint32) of a piece of text; white space in it only
        separates words."""
        out = b""
        for i, part in enumerate(self.specials.split(piece) if self.specials and "<" in piece else [piece]):
            if i % 2:
                out += self.special[part].to_bytes(4, "little")
            elif part:
                for word in self.words.findall(lower(unicodedata.normalize("NFC", part))):
                    out += self.word_ids(word)
        return out

    def encode_text(self, text: str) -> np.ndarray:
        """Ids (uint32) of one whole text."""
        return np.frombuffer(b"".join([self.piece_ids(p) for p in white_space_pieces(text)]), "<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offset of each text's first id)."""
        return self.pieces.encode(texts)

    def decode(self, ids, joiner: str = " ") -> str:
        """The vocabulary strings of ``ids``, concatenated."""
        strings = self.strings
        return joiner.join([strings[i] for i in ids])


_loaded: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The vocabulary at ``path``, read once per process."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row. No shuffle."""
    d = text_or_empty(docs, id_col, text_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in chunks(batch):
                ids, at = bpe.encode(column(part, "text"))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), lists], ["doc_id", "ids"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, ids array<int>")


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids",
           joiner: str = " ") -> DataFrame:
    """(doc_id, text): the vocabulary strings of each row's ids."""
    d = pick(coded, doc_id=id_col, ids=ids_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(x or [], joiner) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes
    every text in one pass and keeps the digests only, so that neither the ids
    nor the decoded texts leave the task."""
    d = text_or_empty(docs, id_col, text_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        decimal = [str(i) for i in range(max(bpe.strings) + 1)]
        for batch in batches:
            for part in chunks(batch):
                rows = []
                flat, at = bpe.encode(column(part, "text"))
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    ids = flat[a:b].tolist()
                    rows.append((len(ids),
                                 hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest(),
                                 hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

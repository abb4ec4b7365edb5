"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from kpiforge.llm import byte_bpe
from kpiforge.llm.queries import op12_byte_bpe, vocabulary
from tests.llm.helpers import ODD, corpus, frame

SF = "/root/testdata/sf0.001"
FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
ALPHABET = list("aaabbeéètthe 0123  \n\t'sre字ム😀ÅŒßm\x00\x1c\x85 ")


def library(name):
    with open(vocabulary(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(coder, lib, texts):
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == lib.encode_ordinary(text), text[:60]
        assert coder.decode(ids) == text.encode()


@pytest.mark.parametrize("name", FILES)
def test_short_and_odd_texts_equal_the_library(name):
    rng, lib = random.Random(4), library(name)
    coder = byte_bpe.ByteBpe(vocabulary(name), public_tokenizers.PATTERN)
    check(coder, lib, ["", " ", "\n", "'s", "<|endoftext|>", "a" * 8, "a" * 9] + [
        "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 70))) for _ in range(1500)])
    check(coder, lib, [r[1] for r in corpus()])


@pytest.mark.parametrize("name", FILES)
def test_matches_around_and_beyond_the_matrix_width_equal_the_library(name):
    rng, lib = random.Random(5), library(name)
    coder = byte_bpe.ByteBpe(vocabulary(name), public_tokenizers.PATTERN)
    texts = ["".join(rng.choice(letters) for _ in range(n))
             for letters in ("a", "ab", "theinr", "abcdefghijklmnopqrstuvwxyz", "字ムあいう漢語日本", "éèßœ")
             for n in (85, 86, 127, 128, 129, 255, 256, 257, 258, 400, 3000)]
    check(coder, lib, texts + ["the" * 900, " " * 2000, "=" * 3000, "=-" * 900, "\n" * 700, "9" * 1000])


def test_overlapping_pairs_of_one_rank_merge_from_the_left():
    coder = byte_bpe.load(vocabulary(FILES[0]), public_tokenizers.PATTERN)
    for n in range(1, 40):
        row = coder.of_byte[np.frombuffer(b"a" * n, np.uint8)]
        matrix = coder.merge_rows(row[None, :].copy(), np.array([n]))[0] if n > 1 else row
        assert coder.merge_long(row.copy()).tolist() == matrix.tolist()


def test_a_merge_that_opens_a_lower_rank_goes_first(tmp_path):
    # ab has rank 300, abc 301, but cab 299: after one merge of a and b a lower rank waits
    ranks = {bytes([b]): b for b in range(256)} | {b"cab": 299, b"ab": 300, b"abc": 301, b"cabc": 298}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    coder = byte_bpe.ByteBpe(str(path), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    check(coder, lib, ["".join(rng.choice("abc") for _ in range(n)) for n in (3, 7, 20, 60, 254, 300, 900) for _ in range(40)])


def test_hash_table_finds_every_pair_and_no_other():
    rng = np.random.default_rng(7)
    left, right = rng.integers(0, 300, 5000), rng.integers(0, 300, 5000)
    keys = np.unique(byte_bpe.PairTable.key(left, right))
    left, right = (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32)
    table = byte_bpe.PairTable(left, right, np.arange(len(keys)))
    assert (table.rank(left, right) == np.arange(len(keys))).all()
    known = set(keys.tolist())
    a, b = rng.integers(-1, 320, 9000).astype(np.int32), rng.integers(-1, 320, 9000).astype(np.int32)
    for x, y, r in zip(a.tolist(), b.tolist(), table.rank(a, b).tolist()):
        assert (r != byte_bpe.NO_RANK) == (x >= 0 and y >= 0 and (x << 32 | y) in known)


def test_memory_starts_afresh_and_stays_right():
    lib = library(FILES[0])
    coder = byte_bpe.ByteBpe(vocabulary(FILES[0]), public_tokenizers.PATTERN)
    coder.room = 2000
    for r in corpus()[:20]:
        check(coder, lib, [r[1], "x" * 5000])
    assert not any(len(m) > byte_bpe.LONGEST for m in coder.memory)


def expected(lib, doc_id, text):
    ids = lib.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def key(row):
    return (row[0] is None, row[0] or 0, row[2])


def test_query_equals_the_library_on_whole_documents(spark, tmp_path):
    lib = library(FILES[0])
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = [tuple(r) for r in op12_byte_bpe(spark, SF).collect()]
    assert sorted(got, key=key) == sorted([expected(lib, r.doc_id, r.text) for r in docs], key=key)
    frame(spark, ODD, clashing=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_byte_bpe(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted([expected(lib, r[0], r[1]) for r in ODD], key=key)


def test_encode_and_decode_are_inverse(spark):
    path, pattern = vocabulary(FILES[1]), public_tokenizers.PATTERN
    docs = frame(spark, ODD)
    back = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path, pattern).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((r[1] or "").encode() for r in ODD)
    none = docs.limit(0)
    assert byte_bpe.round_trip(none, path, pattern).collect() == []
    assert byte_bpe.encode(none, path, pattern).collect() == []

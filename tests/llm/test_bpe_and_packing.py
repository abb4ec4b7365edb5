"""BPE against the tokenizers library; packing by its contract."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kpiforge.llm import bpe, packing, pieces, textvec
from kpiforge.llm.queries import op3_packing, op5_bpe, vocabulary
from tests.llm.helpers import ODD, corpus, frame

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def odd_texts(seed, n):
    rng = random.Random(seed)
    alphabet = list("abcABCHTthe'sre vellmd 012é̱̈ÅÅ\x1c\x1f\x85\xa0 ​<|>Σσςİıßẞ.,!#字ムﬁÉ×÷\n\t") + [
        "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", "😀"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_both_encoders_equal_the_library(library, seed):
    texts = odd_texts(seed, 400)
    # texts without "<|" take the remembered-pieces way
    for batch in (texts, [t.replace("<|", "<") for t in texts]):
        want = [e.ids for e in library.encode_batch(batch, add_special_tokens=False)]
        for coder in (bpe.load(vocabulary()), packing.tokenizer(vocabulary())):
            ids, at = coder.encode(pa.array(batch))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
        one = bpe.load(vocabulary())
        assert [one.encode_text(t).tolist() for t in batch] == want
        assert [one.decode(w) for w in want] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_memory_keeps_what_is_met_again():
    """A piece of every text is learned once, however many others come and go."""
    asked = []

    def learn(words):
        asked.extend(words)
        return [np.array([len(w)], "<u4").tobytes() for w in words]

    memory = pieces.Pieces(learn, lambda ts: [], most=20_000)
    for i in range(200):
        ids, _ = memory.encode(pa.array(["the " + " ".join(f"w{i}x{k}" for k in range(20))]))
        assert ids[0] == 3
        assert memory.held < 20_000
    assert asked.count("the") == 1 and len(asked) == 200 * 20 + 1


def test_memory_forgets_but_stays_right():
    learn = lambda ws: [np.array([len(w), ord(w[0])], "<u4").tobytes() for w in ws]
    memory = pieces.Pieces(learn, lambda ts: [], most=20_000)
    rng = random.Random(0)
    for _ in range(30):
        text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 30) for _ in range(40))
        ids, _ = memory.encode(pa.array([text, None, ""]))
        assert ids.tolist() == [x for w in text.split() for x in (len(w), ord(w[0]))]
    assert memory.held < 40_000 and len(memory.memory) < 200


def collide():
    """Two words of one hash under any polynomial modulo 2^64 (Thue-Morse)."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    return ["xxxxxxxx" + "".join(p[b] for b in bits) for p in ("ab", "ba")]


def test_words_of_structure_are_told_apart(spark, library):
    x, y = collide()
    texts = [f"{x} {y}", f"{y} {x}", f"{x[:200]} {y[:200]} {x[:200]}"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert want[0] != want[1]
    for coder in (bpe.load(vocabulary()), packing.tokenizer(vocabulary())):
        ids, at = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    from kpiforge.llm import quality_rules
    lines = [(1, f"{x}\n{y}\n{x}", "en", "s", 0), (2, f"{x}\n{y}", "en", "s", 0)]
    got = {r.doc_id: r.n_dup_lines for r in quality_rules.judge(frame(spark, lines)).collect()}
    assert got == {1: 1, 2: 0}


def test_span_hashes_depend_on_every_byte():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(4000)}
                   | {"a" * n for n in range(1, 600)} | {"a" * n + "b" for n in range(1, 600)}
                   | {"\x00" * n for n in range(1, 40)})
    w = textvec.Words(pa.array([" ".join(words), " ".join(reversed(words))]))
    assert len(w.hash) == 2 * len(words)
    first = dict(zip(words, w.hash[:len(words)].tolist()))
    again = dict(zip(reversed(words), w.hash[len(words):].tolist()))
    assert first == again and len(set(first.values())) == len(words)


def test_unspaced_text_is_right_and_not_remembered(library):
    rng = random.Random(6)
    han = ["".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(800)) for _ in range(30)]
    want = [e.ids for e in library.encode_batch(han, add_special_tokens=False)]
    for make in (bpe.Bpe, packing.FileTokenizer):
        coder = make(vocabulary())
        ids, at = coder.encode(pa.array(han))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
        assert coder.pieces.held == 0 and not coder.pieces.memory


def test_operator_encode_and_decode(spark, library):
    docs = frame(spark, corpus() + ODD, clashing=True)
    coded = bpe.encode(docs, vocabulary())
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in corpus() + ODD]
    assert sorted(((r.doc_id, r.ids) for r in coded.collect()), key=key) == sorted(want, key=key)
    back = {r.doc_id: r.text for r in bpe.decode(coded, vocabulary()).collect()}
    for r in corpus():
        ids = library.encode(r[1], add_special_tokens=False).ids
        assert back[r[0]] == library.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op5_bpe(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def check_pieces(rows, ids_of):
    """Each id in exactly one piece; sequences gapless and at most a window long."""
    per_doc, per_sequence = {}, {}
    for r in rows:
        per_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        per_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(per_doc) == set(ids_of)
    for doc, parts in per_doc.items():
        ids = np.array(ids_of[doc], "<u4")
        at = 0
        for start, length, crc, total in sorted(parts):
            assert start == at and total == len(ids) and length > 0
            assert crc == zlib.crc32(ids[start:start + length].tobytes())
            at += length
        assert at == len(ids)
    padding = 0
    for parts in per_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding


def test_packing_query_by_contract(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: library.encode(d.text or "", add_special_tokens=False).ids + [2] for d in docs}
    df = op3_packing(spark, SF)
    assert df.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check_pieces(df.collect(), want) == 0


def test_packing_odd_rows(spark):
    from pyspark.sql import functions as F
    odd = [r for r in ODD if r[0] != 1003]
    rows = packing.pack(frame(spark, odd, clashing=True), vocabulary()).withColumn("ids_crc32", F.crc32("ids"))
    library = Tokenizer.from_file(vocabulary())
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in odd}
    check_pieces(rows.collect(), want)
    assert packing.pack(frame(spark, []), vocabulary()).collect() == []


def test_best_fill_against_all_multisets():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(rng.randint(0, 4))}
        capacity = rng.randint(0, 30)
        fill, taken = packing.best_fill(counts, capacity)
        sums = [sum(n * k for n, k in zip(ks, counts)) for ks in
                itertools.product(*[range(c + 1) for c in counts.values()])]
        assert fill == max(s for s in sums if s <= capacity)
        assert fill == sum(n * k for n, k in taken.items())
        assert all(0 < k <= counts[n] for n, k in taken.items())


def test_packer_cuts_nothing_needlessly():
    packer = packing.Packer(16, 0, pool=8)
    rng = random.Random(4)
    docs = [rng.randint(1, 40) for _ in range(200)]
    rows = [r for i, n in enumerate(docs) for r in packer.add(i, np.arange(n))] + list(packer.finish())
    length = {}
    for doc, start, ids, total, sequence, offset in rows:
        length[sequence] = length.get(sequence, 0) + len(ids)
    assert sum(length.values()) == sum(docs)
    short = sorted(n for n in length.values() if n < 16)
    assert len(set(short)) == len(short) and all(n & (n - 1) == 0 for n in short)

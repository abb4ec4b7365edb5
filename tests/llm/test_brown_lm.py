"""The class model against dictionaries over whole texts."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa

from kpiforge.llm import brown_lm
from kpiforge.llm.common import remainder_of_id
from kpiforge.llm.queries import op2_brown_lm
from tests.llm.helpers import ODD, corpus, frame, words

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [w.translate(LOWER) for w in words(text)] + [None]


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def brute(rows):
    counts = collections.Counter(t for d, x in rows if not held(d) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, x in rows:
        ts = tokens(x)
        base = sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in ts)
        out.append((d, held(d), len(ts), sum(counts[t] > 0 for t in ts), n, base))
    return out


def same(got, rows):
    key = lambda x: (x[0] is not None, x[0] or 0, x[2], x[5])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))


def test_query_base_and_gain(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = op2_brown_lm(spark, SF)
    assert df.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = df.collect()
    same(got, rows)
    test = [r for r in got if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
    assert all(r.score < 0 for r in got)


def test_odd_rows(spark):
    rows = corpus() + ODD
    got = brown_lm.score(frame(spark, rows, clashing=True), remainder_of_id("doc_id", 7) == 2, core_size=50, rounds=1)
    same(got.collect(), [(r[0], r[1]) for r in rows])
    assert brown_lm.score(frame(spark, []), remainder_of_id("doc_id", 7) == 2).collect() == []
    # every text held out: nothing is known
    only = [r for r in rows if held(r[0])]
    got = brown_lm.score(frame(spark, only), remainder_of_id("doc_id", 7) == 2).collect()
    assert {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}


def one_block(spark, rows, rounds=1):
    """The model of a corpus in a single block, and the class of each of its words by hash."""
    docs = frame(spark, rows).coalesce(1)
    stored = brown_lm.cut_lineage(brown_lm.blocks(docs, remainder_of_id("doc_id", 7) == 2))
    model, ready = brown_lm.fit(stored, core_size=40, rounds=rounds)
    (block,), (classed,) = stored.collect(), ready.collect()
    hashes = np.frombuffer(block.words, np.int64).view(np.uint64) ^ brown_lm._SIGN
    kinds = dict(zip(brown_lm.from_planes(block.tokens).tolist(), classed.classes))
    return model, {h: kinds[i] for i, h in enumerate(hashes.tolist())}


def test_word_probabilities_sum_to_one(spark):
    """Over all known words and one unknown word per class, after each class."""
    rows = corpus(n=30)
    model, of = one_block(spark, rows)
    counts = collections.Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]) if t is not None)
    hashes, _, _ = brown_lm.tokens_of(pa.array(list(counts)))
    known = [(n, of[h]) for n, h in zip(counts.values(), hashes.tolist())]
    assert model.types == len(known) + 1 and len(known) > 100
    emitted = np.zeros(brown_lm.CLASSES)
    np.add.at(emitted, [k for _, k in known], [n + 1 for n, _ in known])
    emitted = (emitted + 1) / 10 ** model.emission
    emitted[0] = 1.0  # the end token
    assert np.allclose(emitted, 1.0)
    assert np.allclose((10 ** model.transition).sum(axis=1), 1.0)


def test_score_by_dictionaries(spark):
    rows = [(r[0], r[1]) for r in corpus(n=30) + ODD if r[1] is not None]
    full = [r for r in corpus(n=30) + ODD if r[1] is not None]
    _, of = one_block(spark, full)
    texts = sorted({t for _, x in rows for t in tokens(x) if t is not None})
    hashes, _, _ = brown_lm.tokens_of(pa.array(texts))
    kind = {t: of[h] for t, h in zip(texts, hashes.tolist())} | {None: 0}
    counts, pairs = collections.Counter(), collections.Counter()
    for d, x in rows:
        if not held(d):
            ts = tokens(x)
            counts.update(ts)
            pairs.update((kind[a], kind[b]) for a, b in zip([None] + ts[:-1], ts))
    k, total = brown_lm.CLASSES, sum(counts.values())
    size, types, followers, first = (collections.Counter() for _ in range(4))
    for (a, b), n in pairs.items():
        size[b] += n
        first[a] += n
        followers[a] += 1
    types.update(kind[t] for t in counts)
    want = []
    for d, x in rows:
        ts, score = tokens(x), 0.0
        for a, b in zip([None] + ts[:-1], ts):
            i, j = kind[a], kind[b]
            w = max(followers[i], 1)
            score += math.log10((pairs[i, j] + w * (size[j] + 1) / (total + k)) / (first[i] + w))
            if b is not None:
                score += math.log10((counts[b] + 1) / (size[j] + types[j] + 1))
        want.append(score)
    got = brown_lm.score(frame(spark, full).coalesce(1), remainder_of_id("doc_id", 7) == 2, core_size=40, rounds=1)
    assert np.allclose(sorted(r.score for r in got.collect()), sorted(want))


def likelihood(classes, pairs):
    f = lambda x: x * math.log(x) if x else 0.0
    g, r, c = collections.Counter(), collections.Counter(), collections.Counter()
    for (a, b), n in pairs.items():
        g[classes[a], classes[b]] += n
        r[classes[a]] += n
        c[classes[b]] += n
    return sum(map(f, g.values())) - sum(map(f, r.values())) - sum(map(f, c.values()))


def test_exchange_raises_the_class_bigram_likelihood():
    rng = np.random.default_rng(2)
    n = 60
    # words of two kinds that follow one another
    pairs = collections.Counter()
    last = n
    for _ in range(20000):
        kind = 0 if last == n or last % 2 else 1
        word = n if rng.random() < 0.05 else int(rng.integers(0, n // 2)) * 2 + kind
        pairs[last, word] += 1
        last = word
    classes = np.append(1 + rng.integers(0, brown_lm.CLASSES - 1, n), 0)
    scores = [likelihood(classes, pairs)]
    for _ in range(4):
        before, after = (np.zeros((n + 1, brown_lm.CLASSES), np.int64) for _ in range(2))
        for (a, b), m in pairs.items():
            before[a, classes[b]] += m
            after[b, classes[a]] += m
        assert math.isclose(brown_lm.likelihood(before, classes), scores[-1], rel_tol=1e-9)
        classes = brown_lm.exchange(brown_lm.Units(np.arange(n), classes), before, after)
        scores.append(likelihood(classes, pairs))
    assert min(scores[1:]) > scores[0] + 0.9 * (max(scores) - scores[0])
    assert classes[-1] == 0 and 0 not in classes[:-1]


def test_rare_words_go_to_their_best_class():
    rng = np.random.default_rng(5)
    n, k = 50, brown_lm.CLASSES
    pairs = collections.Counter()
    for a, b in rng.integers(0, n + 1, (600, 2)).tolist():
        if a != b:  # a word beside itself counts on both sides
            pairs[a, b] += 1
    classes = np.append(1 + rng.integers(0, 6, n), 0)
    g = np.zeros((k, k))
    seen = collections.Counter()
    for (a, b), m in pairs.items():
        g[classes[a], classes[b]] += m
        seen[a, classes[b]] += m
        seen[b, k + classes[a]] += m
    rows = sorted((w, code, m) for (w, code), m in seen.items() if w < n)
    of, code, m = (np.array(x) for x in zip(*rows))
    got = brown_lm.best_classes(of, classes[:n], code, m.astype(float), g)
    for w in range(n):
        scores = {b: likelihood(np.where(np.arange(n + 1) == w, b, classes), pairs) for b in range(1, k)}
        assert math.isclose(scores[got[w]], max(scores.values()), abs_tol=1e-7)
    assert (got != classes[:n]).any()


def test_every_word_counts_by_its_own_contexts(spark):
    """Words of one ending and one hash slot, outside the core, part by what stands beside them."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        kinds = [("left", "a"), ("right", "b")]
        text = " ".join(f"{side} {mark}{rng.integers(40)}same" for side, mark in
                        (kinds[int(x)] for x in rng.integers(0, 2, 30)))
        rows.append((i, text, "en", "s", len(text)))
    _, of = one_block(spark, rows, rounds=3)
    hashes, slot, _ = brown_lm.tokens_of(pa.array([f"{m}{i}same" for m in "ab" for i in range(40)]))
    assert len(set(slot.tolist())) == 1 and len(of) == 82  # half of them in the core
    kinds = [of[h] for h in hashes.tolist()]
    assert not set(kinds[:40]) & set(kinds[40:])


def test_planes_round_trip():
    x = np.array([0, 1, 255, 256, 70000, 2**31], np.int64)
    assert brown_lm.from_planes(brown_lm.planes(x)).tolist() == x.tolist()
    assert brown_lm.from_planes(brown_lm.planes(np.zeros(0, np.int64))).tolist() == []


def test_batches_hold_few_blocks(spark):
    """Blocks cross to Python a few at a time, whatever a stored file holds."""
    import pyarrow as pa
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        brown_lm.block_batches(spark)

        def rows(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

        large = spark.range(0, 8, 1, 1).selectExpr(f"repeat('x', {brown_lm.BLOCK_BYTES // 2 + 1}) AS tokens")
        got = [r.n for r in large.mapInArrow(rows, "n bigint").collect()]
        assert sum(got) == 8 and max(got) <= 2
        spark.conf.set(key, "1000")
        brown_lm.block_batches(spark)
        assert spark.conf.get(key).startswith("1000")
    finally:
        spark.conf.set(key, before)

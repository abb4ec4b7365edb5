"""Periodic runs against brute force: all runs of small sequences, the query of
whole documents, and what happens to odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiforge.llm import periodic_runs
from kpiforge.llm.queries import op11_periodic_runs, with_periodic_tails
from tests.llm.helpers import ODD, corpus, frame, words

SF = "/root/testdata/sf0.001"


def brute_runs(seq, least_words=6, least_periods=4):
    """Every maximal stretch of every period, without those of a smaller one."""
    n, out = len(seq), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and seq[j] == seq[j + q]:
                j += 1
            size = j - i + q
            w = seq[i:i + size]
            if j > i and size >= max(least_words, least_periods * q) and not any(
                    w[r:] == w[:-r] for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out)


def brute_collapse(seq, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(seq) if i not in gone]


def periodic(rng, n, letters):
    seq = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n:
            a, p = rng.randrange(n), rng.randint(1, 7)
            b = rng.randint(a, n)
            seq[a:b] = [seq[a + k % p] if a + k % p < n else 0 for k in range(b - a)]
    return seq


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(400):
        seq = periodic(rng, rng.randint(0, 70), letters)
        for bounds in ((6, 4), (1, 2), (4, 3)):
            assert periodic_runs.runs_of(seq, *bounds) == brute_runs(seq, *bounds), (seq, bounds)


@given(st.lists(st.integers(0, 2), max_size=40))
@settings(max_examples=200, deadline=None)
def test_squares_of_any_sequence(seq):
    assert periodic_runs.runs_of(seq, 1, 2) == brute_runs(seq, 1, 2)


def test_words_that_share_a_polynomial_hash_are_different_words():
    def thue_morse(a, b):
        return "".join((a, b)[bin(i).count("1") % 2] for i in range(1024))
    x, y = "xxxxxxxx" + thue_morse("a", "b"), "xxxxxxxx" + thue_morse("b", "a")
    found, of = periodic_runs.words_of(pa.array([" ".join([x, y] * 4), None, "one two"]))
    assert of.tolist() == [0, 8, 8, 10]
    assert found.to_pylist()[:2] == [x, y]


def test_stretches_hold_every_run_and_stop_at_text_ends():
    rng = random.Random(8)
    for _ in range(60):
        texts = [periodic(rng, rng.randint(0, 50), 12) for _ in range(4)]
        ids = np.array([w for t in texts for w in t], np.int64)
        of = np.cumsum([0] + [len(t) for t in texts])
        text = np.repeat(np.arange(4), np.diff(of))
        parts = periodic_runs.stretches(ids, text)
        got = [(a + s, n, q) for a, b in parts for s, n, q in periodic_runs.runs_of(ids[a:b].tolist())]
        assert all(text[a] == text[b - 1] for a, b in parts)
        assert sorted(got) == sorted((int(of[t]) + s, n, q) for t in range(4) for s, n, q in brute_runs(texts[t]))


def test_long_periodic_texts_stay_near_linear():
    # an automaton that walked all suffixes would take n squared steps here
    n = 60_000
    assert periodic_runs.runs_of([0] * n) == [(0, n, 1)]
    assert periodic_runs.runs_of([i % 700 for i in range(n)]) == [(0, n, 700)]
    low = [bin(i).count("1") % 2 for i in range(n)]  # Thue-Morse: no cube anywhere
    assert periodic_runs.runs_of(low) == []


def expected(doc_id, text):
    w = words(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute_runs_by_word(w)
    best = (None,) * 4
    for s, n, q in runs:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(brute_collapse(w, runs)))]
    return (doc_id, len(runs), *best, *sha)


def brute_runs_by_word(w):
    """As ``brute_runs``, for whole documents: periods up to a fourth only."""
    x = np.array([hash(v) for v in w], np.int64)
    out = []
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate([[False], x[q:] == x[:-q], [False]]).astype(np.int8)
        edge = np.diff(same)
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            size = j - i + q
            if size >= max(6, 4 * q):
                v = w[i:i + size]
                if not any(v[r:] == v[:-r] for r in range(1, q)):
                    out.append((i, size, q))
    return sorted(out)


def key(row):
    return (row[0] is None, row[0] or 0, row[-1])


def test_query_equals_brute_force_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = [tuple(r) for r in op11_periodic_runs(spark, SF).collect()]
    want = [expected(r.doc_id, r.text) for r in docs]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in got) >= len(docs) // 20


def test_odd_rows(spark, tmp_path):
    path = str(tmp_path)
    rows = ODD + corpus()[:6] + [(2000, "a b " * 500, "en", "s", 2000), (2001, " ".join(["z"] * 5), "en", "s", 9),
                                 (2002, " ".join(["z"] * 6), "en", "s", 11)]
    frame(spark, rows, clashing=True).write.parquet(f"{path}/documents.parquet")
    got = [tuple(r) for r in op11_periodic_runs(spark, path).collect()]
    assert sorted(got, key=key) == sorted([expected(r[0], r[1]) for r in rows], key=key)
    by_id = {r[0]: r for r in got}
    assert by_id[2001][1] == 0 and by_id[2002][1:5] == (1, 0, 6, 1)
    assert by_id[1000][-1] == hashlib.sha256(b"").hexdigest()
    plain = {r.doc_id: r for r in periodic_runs.find(frame(spark, rows)).collect()}
    assert plain[2000].collapsed == "a b" and plain[1000].n_words == 0 and plain[1000].runs == []


def test_empty_table(spark):
    none = frame(spark, []).limit(0)
    assert periodic_runs.find(none).collect() == []
    assert with_periodic_tails(none).collect() == []

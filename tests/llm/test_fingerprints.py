"""Bottom-k fingerprints against exact shingle sets."""

import hashlib
import statistics

import numpy as np
import pyarrow as pa

from kpiforge.llm import fingerprints as fp
from kpiforge.llm.queries import op1_fingerprints
from tests.llm.helpers import ODD, corpus, frame, jaccard, shingle_set


def expected_edits(rows):
    """doc -> (text, edited, next) by ascending id, null ids first."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in order]
    out = []
    for i, r in enumerate(order):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        cut = len(t) // 4
        out.append((r[0], t, t[:len(t) - cut] + nxt[:cut], nxt))
    return out


def test_edited_texts_and_likeness(spark):
    rows = corpus() + ODD
    got = fp.edited_likeness(frame(spark, rows, clashing=True)).collect()
    want = expected_edits(rows)
    assert sorted((r.n_chars, r.edited_sha256) for r in got) == sorted(
        (len(t), hashlib.sha256(e.encode()).hexdigest()) for _, t, e, _ in want)
    by_id = {r.doc_id: r for r in got}
    errors = []
    for doc, t, e, nxt in want:
        if doc == 1003:
            continue  # an id on two rows
        r = by_id[doc]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        errors.append(abs(r.near_edited - jaccard(shingle_set(t), shingle_set(e))))
        errors.append(abs(r.near_next - jaccard(shingle_set(t), shingle_set(nxt))))
    assert max(errors) < 0.2 and statistics.mean(errors) < 0.02
    same = {}
    for doc, t, _, _ in want:
        if doc != 1003:
            assert same.setdefault(t, by_id[doc].fingerprint) == by_id[doc].fingerprint


def test_query_columns_and_rows(spark):
    df = op1_fingerprints(spark, "/root/testdata/sf0.001")
    assert df.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                              "near_edited", "near_next"]
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_empty_and_single_document(spark):
    assert fp.edited_likeness(frame(spark, [])).collect() == []
    r = fp.edited_likeness(frame(spark, [(7, "a b c d e f g h", "en", "s", 15)])).collect()[0]
    assert r.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest()


def test_sketches_merge_like_unions():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 900).astype(np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 1 << 62, 500).astype(np.uint64)])
    sa, sb, both = (np.unique(x)[:fp.SKETCH_SIZE] for x in (a, b, np.concatenate([a, b])))
    assert (fp.merge(sa, sb) == both).all()
    assert abs(fp.resemblance(sa, sb) - 600 / 1400) < 0.15
    assert abs(fp.containment(sa, sb) - 600 / 900) < 0.2
    assert abs(fp.distinct_shingles(both) - 1400 * (1 << 64) / (1 << 62)) / 5600 < 0.3
    assert (fp.from_text(fp.to_text(sa)) == sa).all()
    empty = np.zeros(0, np.uint64)
    assert fp.resemblance(empty, empty) == 1.0 and fp.resemblance(empty, sa) == 0.0


def test_short_texts_are_exact():
    s = fp.sketch_column(pa.array(["a b c d e f", "a b c d e f", "a b c", None, "a b c d e g"]))
    assert [len(x) for x in s] == [2, 2, 1, 0, 2]
    assert fp.resemblance(s[0], s[4]) == 1 / 3


def test_merge_by_group(spark):
    rows = corpus() + ODD
    prints = fp.fingerprint(frame(spark, rows)).join(
        frame(spark, rows).select("doc_id", "source").distinct(), "doc_id")
    got = {r["source"]: r["fingerprint"] for r in fp.merge_by(prints, "source").collect()}
    for source in ("s0", "s1", "s2"):
        texts = {r[1] or "" for r in rows if r[3] == source and r[0] is not None}
        sketches = fp.sketch_column(pa.array(sorted(texts)))
        assert got[source] == fp.to_text(np.unique(np.concatenate(sketches))[:fp.SKETCH_SIZE])

"""Near-duplicate classes against all pairs."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kpiforge.llm import order_minhash as om
from kpiforge.llm.queries import op9_order_minhash
from kpiforge.llm.textvec import Words, mix, shingles
from tests.llm.helpers import ODD, corpus, frame, jaccard, sentence, shingle_set, words


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_classes(rows):
    """row number -> smallest id of its class, by all pairs of texts."""
    texts = sorted({r[1] or "" for r in rows})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    sets = {t: shingle_set(t) for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if sets[a] & sets[b]:
                n = max(len(words(a)), len(words(b)))
                if edit_distance(words(a), words(b)) <= int(0.2 * n + 1e-9):
                    parent[find(a)] = find(b)
    least = {}
    for r in rows:
        if r[0] is not None:
            root = find(r[1] or "")
            least[root] = min(least.get(root, r[0]), r[0])
    return [least.get(find(r[1] or "")) for r in rows]


def family(seed=2, copies=60):
    """Copies of one text with few to many changed words, and copies of copies."""
    rng = random.Random(seed)
    base = sentence(rng, "en", 120).split(" ")
    rows = [(5000, " ".join(base), "en", "s", 0)]
    for i in range(copies):
        w = list(rng.choice(rows)[1].split(" ")) if i % 3 == 0 else list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 999)}"
        rows.append((5001 + i, " ".join(w), "en", "s", 0))
    return rows


def test_classes_equal_all_pairs(spark):
    rows = corpus() + ODD + family()
    got = om.classes(frame(spark, rows, clashing=True)).collect()
    want = sorted((r[0] is None, r[0] or 0, c) for r, c in zip(rows, brute_classes(rows)) if c is not None)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.class_id) for r in got if r.class_id is not None) == want
    assert len(got) == len(rows)
    size = {}
    for r in got:
        size[r.root] = size.get(r.root, 0) + 1
    assert all(r.class_rows == size[r.root] for r in got)


def test_keep_one_row_of_each_class(spark):
    rows = corpus() + ODD + family()
    docs = frame(spark, rows, clashing=True)
    kept = om.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted({c for c in brute_classes(rows) if c is not None})
    assert got.count(None) == 1
    assert om.keep_one(frame(spark, [])).collect() == []
    assert om.keep_one(frame(spark, [rows[0]] * 3)).count() == 1


def test_query_covers_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    got = {r.doc_id: r.class_id for r in op9_order_minhash(spark, sf).collect()}
    texts = {}
    for d, t in rows:
        texts.setdefault(t, []).append(d)
    assert set(got) == {d for d, _ in rows}
    assert all(len({got[d] for d in ids}) == 1 for ids in texts.values())


def test_copies_of_copies_in_a_large_family(spark):
    """Each copy's copy is near that copy only, not the original or a sibling."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
    rows = [(0, " ".join(base), "en", "s", 0)]
    for i in range(1000):
        places = rng.sample(range(5, 295, 6), 8)
        n = rng.randint(1, 2)
        copy = list(base)
        for at in places[:n]:
            copy[at] = f"c{i}x{at}"
        second = list(copy)
        for at in places[n:n + 6]:
            second[at] = f"d{i}x{at}"
        rows += [(1 + 2 * i, " ".join(copy), "en", "s", 0), (2 + 2 * i, " ".join(second), "en", "s", 0)]
    sets = [shingle_set(r[1]) for r in rows[:41]]
    assert all(jaccard(sets[k - 1], sets[k]) >= 0.8 > jaccard(sets[0], sets[k]) for k in range(2, 41, 2))
    # by alignment the copies' copies are near the original too, so one class holds all
    got = om.classes(frame(spark, rows)).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if r.class_id != 0] == []


def test_banded_distance_is_exact_within_the_band():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 9))]
        b = a[:]
        for _ in range(rng.randint(0, 4)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 3))
        band = rng.randint(0, 6)
        d = edit_distance(a, b)
        assert om.banded_distance(a, b, band) == (d if d <= band else None)


def test_moved_passages_are_not_near():
    """The shingles are nearly all shared, the order is not."""
    w = [f"w{i}" for i in range(400)]
    moved = w[200:] + w[:200]
    a, b = (Words(pa.array([" ".join(x)])) for x in (w, moved))
    sa, sb = (set(shingles(x.hash, x.of, 5)[0].tolist()) for x in (a, b))
    assert jaccard(sa, sb) > 0.95
    assert not om.near(a.hash, b.hash, 0.8)


def test_near_is_edit_distance_within_a_fifth():
    rng = random.Random(4)
    seen = set()
    for _ in range(1200):
        a = [rng.randint(0, 30) for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = [rng.randint(0, 30)] * rng.randint(0, 1)
        if rng.random() < 0.2:
            b = b[len(b) // 2:] + b[:len(b) // 2]
        want = edit_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)
        x, y = (mix(np.array(v, np.uint64)) for v in (a, b))
        assert om.near(x, y, 0.8) == want
        seen.add(want)
    assert seen == {True, False}


def test_recall_of_edited_copies(spark):
    """Copies that share well under 0.8 of their shingles, but align."""
    rng = random.Random(12)
    rows, lost = [], []
    for i in range(150):
        base = [f"w{rng.randrange(10 ** 5)}" for _ in range(rng.randint(80, 300))]
        copy = list(base)
        for at in rng.sample(range(len(base)), int(len(base) * rng.uniform(0.02, 0.12))):
            copy[at] = f"new{rng.randrange(10 ** 6)}"
        rows += [(2 * i, " ".join(base), "en", "s", 0), (2 * i + 1, " ".join(copy), "en", "s", 0)]
    got = {r.doc_id: r.class_id for r in om.classes(frame(spark, rows)).collect()}
    lost = [i for i in range(150) if got[2 * i + 1] != 2 * i]
    assert len(lost) <= 3
    assert all(got[2 * i] == 2 * i for i in range(150))


def test_pairs_across_the_borders_of_partitions(spark):
    """Sorted neighbours are pairs wherever the tasks' borders lie."""
    rng = random.Random(13)
    rows = [(rng.randrange(40), rng.randrange(3), bytes([i % 256, i // 256]), rng.choice([b"x", b"y", b"z"])) for i in range(700)]
    df = spark.createDataFrame(rows, "k0 bigint, k1 bigint, node binary, root binary")
    want = {(x[2], y[2]) for x, y in zip(sorted(rows), sorted(rows)[1:]) if x[0] == y[0] and x[3] != y[3]}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for parts in ("1", "7", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = [(bytes(r.a), bytes(r.b)) for r in om.side_by_side(df).collect()]
            assert len(got) == len(want) and set(got) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert om.side_by_side(df.limit(0)).collect() == []


def test_a_group_makes_pairs_in_proportion(spark):
    """Five times the copies of one text, each changed a little: five times the pairs."""
    def pairs(n):
        rng = random.Random(14)
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
        rows = []
        for i in range(n):
            w = list(base)
            w[rng.randrange(200)] = f"c{i}"
            rows.append((i, " ".join(w), "en", "s", 0))
        nodes = om.sketches(frame(spark, rows)).select("node", "words", "values", F.col("node").alias("root"))
        return om.candidates(nodes, 0.8).count()
    few, many = pairs(100), pairs(500)
    assert many < 7 * few and many < 2 * om.SKETCHES * 500


def test_sketch_agreement_follows_similarity():
    rng = random.Random(7)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(300)]

    def values(w):
        x = Words(pa.array([" ".join(w)]))
        return om.sketch(om.occurrence_labelled(*shingles(x.hash, x.of, 5)))

    near, far = list(base), list(base)
    for _ in range(5):
        near[rng.randrange(300)] = "x"
    for _ in range(60):
        far[rng.randrange(300)] = f"y{rng.random()}"
    v = values(base)
    assert (v == values(near)).sum() > 10 > (v == values(far)).sum()
    # repeated k-mers are told apart
    h = np.array([5, 7, 5, 5], np.uint64)
    assert len(set(om.occurrence_labelled(h, np.array([0, 4])).tolist())) == 4
    assert om.occurrence_labelled(h, np.array([0, 2, 4])).tolist()[0] == 5


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(1, 40)] + [(b"\x64", b"\x65")],
                                  "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in om.components(edges).collect()}
    assert {got[bytes([i])] for i in range(2, 41)} == {b"\x01"} and got[b"\x65"] == b"\x64"


def test_near_texts_that_are_never_neighbours_are_linked(spark, monkeypatch):
    """All texts share a passage; near ones stand apart in every sorted order."""
    monkeypatch.setattr(om, "CELL", 7)
    none = spark.createDataFrame([], "a binary, b binary")
    monkeypatch.setattr(om, "candidates", lambda *args: none)  # as if no neighbours were near
    rows = corpus(n=60) + family(copies=25)
    got = om.classes(frame(spark, rows)).collect()
    want = sorted((r[0], c) for r, c in zip(rows, brute_classes(rows)))
    assert sorted((r.doc_id, r.class_id) for r in got) == want


def test_cells_keep_every_near_pair():
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(40)}" for _ in range(rng.randint(0, 60))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randint(0, 8)):
                copy.insert(rng.randrange(len(copy) + 1), f"w{rng.randrange(40)}")
            texts.append(copy)
    w = Words(pa.array([" ".join(x) for x in texts]))
    bins = np.zeros((len(texts), om.BINS), np.int64)
    np.add.at(bins, (w.doc_index(), (w.hash % np.uint64(om.BINS)).astype(np.int64)), 1)
    root = np.arange(len(texts)) % 47
    every = np.arange(len(texts))
    a, b = om.cell_pairs(root, w.counts(), bins, every, every, 0.8)
    got = set(zip(a.tolist(), b.tolist()))
    near = {(i, j) for j in every for i in range(j)
            if root[i] != root[j] and om.near(w.hash[w.of[i]:w.of[i + 1]], w.hash[w.of[j]:w.of[j + 1]], 0.8)}
    assert near <= got and len(got) < len(every) ** 2 / 4 and len(near) > 20
    a, b = om.cell_pairs(root, w.counts(), bins, every[:20], every[20:], 0.8)
    assert {p for p in got if p[0] < 20 <= p[1]} == set(zip(a.tolist(), b.tolist()))


def apart(spark, rows):
    """Nodes of texts, each a class of its own, and a function that gives their texts."""
    nodes = (om.sketches(frame(spark, rows)).select("node", "words", "size", "values", F.col("node").alias("root"))
             .localCheckpoint())
    texts = frame(spark, rows).select(F.unhex(F.md5("text")).alias("node"), "text")
    return nodes, lambda ids: texts.join(ids, "node")


def test_texts_that_only_share_a_passage_make_no_rows(spark):
    """Their word counts allow an alignment, so each cell has to align all its pairs."""
    rng = random.Random(15)
    shared = [f"w{rng.randrange(10 ** 6)}" for _ in range(78)]
    rows = [(i, " ".join(shared + [f"c{i}x{k}" for k in range(22)]), "en", "s", 0) for i in range(120)]
    rows.append((500, " ".join(shared + [f"c7x{k}" for k in range(20)]), "en", "s", 0))
    got = [sorted((bytes(r.a), bytes(r.b))) for r in om.rest(*apart(spark, rows), 0.8).collect()]
    node = {r.doc_id: bytes(r.node) for r in om.sketches(frame(spark, rows)).collect()}
    assert got == [sorted((node[7], node[500]))]


def test_links_of_a_group_stay_in_proportion(spark, monkeypatch):
    """Near copies that are all in classes of their own: links, not all their pairs."""
    rng = random.Random(16)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(200):
        w = list(base)
        w[rng.randrange(150)] = f"c{i}"
        rows.append((i, " ".join(w), "en", "s", 0))
    nodes, texts_of = apart(spark, rows)
    for cell, size in ((1000, 8 << 20), (30, 8 << 20), (1000, 30 << 10)):
        monkeypatch.setattr(om, "CELL", cell)
        monkeypatch.setattr(om, "CELL_BYTES", size)
        found = om.cut_lineage(om.rest(nodes, texts_of, 0.8))
        assert 199 <= found.count() < (200 * 199 / 8 if cell == 1000 and size == 8 << 20 else 200 * om.SKETCHES)
        assert om.components(found).agg(F.count("node"), F.countDistinct("root")).first()[:] == (199, 1)


def test_distance_beyond_a_few_edits_is_exact():
    rng = random.Random(17)
    seen = set()
    for _ in range(150):
        a = [rng.randint(0, 50) for _ in range(rng.randint(0, 150))]
        b = list(a)
        for _ in range(rng.randint(0, 90)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 2)] = [rng.randint(0, 50)] * rng.randint(0, 2)
        band = rng.randint(0, 80)
        d = edit_distance(a, b)
        assert om.banded_distance(a, b, band) == (d if d <= band else None)
        seen.add((d > om.NARROW, d <= band))
    assert len(seen) == 4

"""Held-out accuracy of the quality classifier; the pipeline against its operators."""

import math
import random
import zlib

import numpy as np

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kpiforge.llm import cotraining
from kpiforge.llm.queries import op6_cotraining, vocabulary
from tests.llm.helpers import CLASHING, ODD, corpus, frame, sentence
from tests.llm.test_bpe_and_packing import check_pieces
from tests.llm.test_order_minhash import brute_classes


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op6_cotraining(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    # the fold that the views do not train on
    fold = [r for r in rows if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good = [r.good for r in fold if labels[r.doc_id] == 1]
    bad = [not r.good for r in fold if labels[r.doc_id] == 0]
    assert len(good) > 100 and sum(good) / len(good) > 0.98
    assert len(bad) > 10 and sum(bad) / len(bad) > 0.85
    assert all(0 <= r.score <= 1 for r in rows)


def test_rounds_use_unlabelled_documents(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        text = sentence(rng, "en", 80)
        rows.append((i, text if i % 2 else text.upper().replace(" ", "!! "), "en", "s", len(text)))
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    for rounds in (0, 2):
        got = {r.doc_id: r.score for r in cotraining.score(docs, labels, rounds=rounds).collect()}
        assert all((got[i] > 0.5) == bool(i % 2) for i in range(300))


def test_odd_rows_and_missing_labels(spark):
    rows = corpus(n=30) + ODD
    docs = frame(spark, rows, clashing=True)
    labels = spark.createDataFrame([(0, 1, "x"), (0, 0, "x"), (1, 0, "x"), (2, None, "x"), (None, 1, "x"), (77777, 1, "x")],
                                   "doc_id long, quality int, fold string")
    got = cotraining.score(docs, labels).collect()
    assert len(got) == len(rows) and all(math.isfinite(r.score) for r in got)
    assert {r.doc_id for r in got if r.labelled} == {0, 1}
    none = cotraining.score(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert cotraining.score(frame(spark, []), labels).collect() == []


def test_platt_recovers_a_logistic():
    x = np.linspace(-4, 4, 81)
    p = 1 / (1 + np.exp(-(1.5 * x - 0.7)))
    a, b = cotraining.platt(x, 1000 * p, 1000 * (1 - p))
    assert abs(a - 1.5) < 0.01 and abs(b + 0.7) < 0.01


def stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, ""))
        out.append(docs)
    return out


def test_stage_order_and_contract(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_duplicates",
                                                      "secret_scan", "packing"]
    rng = random.Random(6)
    secret = sentence(rng, "en", 70) + " token=abcdefabcdefabcdefabcdef"
    symbols = " ".join(w + "#*|" for w in sentence(rng, "en", 150).split())
    rows = corpus() + ODD + [(3000, secret, "en", "s0", len(secret)), (3001, symbols, "en", "s0", len(symbols))]
    docs = frame(spark, rows, clashing=True)
    good, known, single, masked, packed = stages(spark, docs)
    for d in (good, known, single, masked):
        assert d.dtypes == docs.dtypes
    clean = {r[0] for r in corpus()}
    assert clean | {3000} == {r.doc_id for r in good.collect()} == {r.doc_id for r in known.collect()}
    kept = [r for r in rows if r[0] in clean | {3000}]
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(brute_classes(kept)))
    texts = {r.doc_id: r for r in masked.collect()}
    assert texts[3000].text.endswith(" [SECRET]") and texts[3000].n_chars == len(texts[3000].text)
    assert all(r.text == texts[r.doc_id].text for r in single.collect() if r.doc_id != 3000)
    assert all(r[c] == "x" for r in texts.values() for c in CLASHING)
    library = Tokenizer.from_file(vocabulary())
    want = {d: library.encode(r.text, add_special_tokens=False).ids + [2] for d, r in texts.items()}
    check_pieces(packed.withColumn("ids_crc32", F.crc32("ids")).collect(), want)


def test_empty_table(spark):
    assert [d.count() for d in stages(spark, frame(spark, []))] == [0] * 5


def test_run_on_driver_tables(spark):
    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf).select("doc_id").distinct().count()
    assert 0 < got < spark.read.parquet(f"{sf}/documents.parquet").count()

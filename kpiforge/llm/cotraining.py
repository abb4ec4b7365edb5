"""Quality classifier by co-training of two views.

The content view sees how often each pair of character classes occurs in the
text; the page view sees the document's metadata: language, source, size, line
structure and typography, in bins. Each view is a naive Bayes model, so it is
fitted from sums that Spark adds up over all labelled documents. In every
round each view labels the documents it is sure of, over the whole corpus, and
those pseudo-labels go to the other view's sums, with less weight than true
ones, unless that view leans the other way. Scores are calibrated by Platt's
logistic on a fold of the labelled documents that the views never train on;
the views' calibrated log odds, less the prior counted twice, score every
document.

Texts are read once; their features are stored (a few hundred numbers a
document) and every round is one pass over them. All models have fixed sizes.

Defined cases: a null or empty text has no pairs and content odds equal to the
prior; a null language or source is a bin of its own; several labels of one
document count as their mean, at one half as the better one; without labels of
both classes every score is the smoothed share of good labels, or one half;
repeated rows are scored one by one and each counts as a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import chunks, column, lean, pick, remainder_of_id, text_or_empty
from kpiforge.llm.quality_rules import statistics
from kpiforge.llm.textvec import buffer_of
from kpiforge.session import cut_lineage, cut_lineage_counted

ROUNDS = 2
PSEUDO_WEIGHT = 0.3   # of a pseudo-label beside a true label
SURE = 0.97           # calibrated probability from which a view passes a label on
FOLDS = 5             # one of them is for calibration
SMALL_ROWS = 200_000
SLOTS = 64     # classes of the letters of other scripts


def _classes() -> tuple[np.ndarray, int]:
    """Coarse class of each code point below 65536 for the page view's pairs, and
    the first of the ``SLOTS`` classes of other scripts' letters and their combining marks."""
    groups = (" \t\n\x0b\x0c\r", *"abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
              ".", ",", "!", "#", "*", "$%&", "|<>", "'\"-", "?:;()/@=+_[]{}\\^`~")
    table = np.zeros(1 << 16, np.int64)  # 0: before the text's start, and control characters
    for n, group in enumerate(groups, 1):
        table[[ord(c) for c in group]] = n
    capital, digit, mark = table[ord("A")], table[ord("0")], len(groups) + 1
    for point in range(0x80, 1 << 16):
        kind = category(chr(point))
        table[point] = (capital if kind == "Lu" else mark + 1 + point % SLOTS if kind[0] in "LM"
                        else digit if kind[0] == "N" else mark)
    return table, mark + 1


CLASS_OF, FIRST_SLOT = _classes()
CLASSES = FIRST_SLOT + SLOTS
PAIRS = CLASSES * CLASSES
LANGUAGES, SOURCES, BINS = 64, 256, 16
MEASURES = 8
PAGE_SLOTS = LANGUAGES + SOURCES + MEASURES * BINS
_RANGE, _STEP = 40.0, 50  # scores are calibrated on a grid of 1/50 within +-40


def _bucket(x: str | None, n: int) -> int:
    return 0 if x is None else 1 + zlib.crc32(x.encode()) % (n - 1)


def page_slots(texts: pa.Array, langs: list, sources: list) -> np.ndarray:
    """Document x feature: the slot that each metadata feature falls into."""
    s = statistics(texts)
    raw, offsets = buffer_of(texts)
    size = np.diff(offsets)

    def share(mask: np.ndarray) -> np.ndarray:
        done = np.concatenate([[0], np.cumsum(mask)])
        return np.diff(done[offsets]) / np.maximum(size, 1)

    def log_bin(x: np.ndarray) -> np.ndarray:
        return np.minimum(np.log2(1 + x), BINS - 1).astype(np.int64)

    def share_bin(x: np.ndarray) -> np.ndarray:
        return np.minimum(np.sqrt(x) * BINS, BINS - 1).astype(np.int64)

    words = np.maximum(s["n_words"], 1)
    lines = share(raw == 0x0A) * size + 1
    measures = [log_bin(size), log_bin(lines), log_bin(s["n_words"] / lines),
                np.minimum(s["word_chars"] / words, BINS - 1).astype(np.int64),
                share_bin((share((raw >= 0x41) & (raw <= 0x5A)))), share_bin(s["n_symbols"] / np.maximum(size, 1)),
                share_bin(s["n_repeat_words"] / words), share_bin(share((raw >= 0x30) & (raw <= 0x39)))]
    base = LANGUAGES + SOURCES + BINS * np.arange(MEASURES)
    return np.column_stack([[_bucket(x, LANGUAGES) for x in langs],
                            [LANGUAGES + _bucket(x, SOURCES) for x in sources],
                            *[b + m for b, m in zip(base, measures)]]).astype(np.uint16).reshape(len(size), -1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """(doc_id, pairs, counts, page): packed uint16 pair codes with uint32
    counts, and packed uint16 page slots."""
    d = text_or_empty(docs, id_col, text_col, lang=lang_col, source=source_col)
    id_type = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = column(part, "text")
                raw, offsets = buffer_of(texts)
                n = len(offsets) - 1
                c = CLASS_OF[raw]
                code = np.concatenate([[0], c[:-1]]) * CLASSES + c
                starts = offsets[:-1][np.diff(offsets) > 0]
                code[starts] = c[starts]
                doc = np.repeat(np.arange(n), np.diff(offsets))
                many = np.bincount(doc * PAIRS + code, minlength=n * PAIRS) if len(raw) else np.zeros(n * PAIRS, int)
                at = np.flatnonzero(many)
                cuts = np.searchsorted(at, np.arange(n + 1) * PAIRS)
                pairs = (at % PAIRS).astype("<u2").tobytes()
                counts = many[at].astype("<u4").tobytes()
                page = page_slots(texts, column(part, "lang").to_pylist(), column(part, "source").to_pylist())
                yield pa.RecordBatch.from_arrays([
                    column(part, "doc_id"),
                    pa.array([pairs[2 * a:2 * b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.array([counts[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.array([p.tobytes() for p in page], pa.binary())], ["doc_id", "pairs", "counts", "page"])

    return d.mapInArrow(lean(run), f"doc_id {id_type}, pairs binary, counts binary, page binary")


class Batch:
    """Features of one Arrow batch as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        def flat(name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
            values = column(batch, name).to_pylist()
            x = np.frombuffer(b"".join(values), kind)
            return x, np.array([len(v) for v in values], np.int64) // x.itemsize

        pairs, n = flat("pairs", "<u2")
        counts, _ = flat("counts", "<u4")
        self.rows = batch.num_rows
        self.pairs = pairs.astype(np.int64)
        self.doc = np.repeat(np.arange(self.rows), n)
        total = np.bincount(self.doc, counts, minlength=self.rows)
        self.share = counts / total[self.doc] if len(counts) else np.zeros(0)
        self.page = flat("page", "<u2")[0].reshape(self.rows, -1).astype(np.int64)


@dataclass
class Views:
    """Log-ratio weights and calibration (slope, offset) of both views."""
    pair_weight: np.ndarray
    page_weight: np.ndarray
    calibration: np.ndarray   # view x (slope, offset)
    prior: float              # log odds of the labelled documents

    def raw(self, b: Batch) -> np.ndarray:
        """Document x view: uncalibrated log ratios."""
        content = np.bincount(b.doc, b.share * self.pair_weight[b.pairs], minlength=b.rows)
        return np.column_stack([content, self.page_weight[b.page].sum(axis=1)])

    def odds(self, b: Batch) -> np.ndarray:
        """Document x view: calibrated log odds of being good."""
        return self.raw(b) * self.calibration[:, 0] + self.calibration[:, 1]


def weights(sums: np.ndarray, smoothing: float) -> np.ndarray:
    """Log ratio of good to bad per slot; ``sums`` is class (bad, good) x slot."""
    p = (sums + smoothing) / (sums.sum(axis=1, keepdims=True) + smoothing * sums.shape[1])
    return np.log(p[1] / p[0])


def _passed(stored: DataFrame, views: Views | None) -> tuple[np.ndarray, np.ndarray]:
    """Class x slot sums of both views: true labels of the training folds and,
    given ``views``, the other view's sure labels of unlabelled documents."""
    shared = stored.sparkSession.sparkContext.broadcast(views)
    sizes = (PAIRS, PAGE_SLOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        total = [np.zeros(2 * s) for s in sizes]
        for batch in batches:
            b = Batch(batch)
            label = column(batch, "label").fill_null(-1).to_numpy(zero_copy_only=False)
            fold = column(batch, "fold").to_numpy(zero_copy_only=False)
            true = np.where(fold > 0, label, -1).astype(np.int64)
            given = [true.copy(), true.copy()]
            if v is not None:
                odds = v.odds(b)
                sure = np.log(SURE / (1 - SURE))
                for to, by in ((0, 1), (1, 0)):
                    agrees = (odds[:, by] > 0) == (odds[:, to] > 0)
                    pseudo = np.where(agrees & (np.abs(odds[:, by]) >= sure), odds[:, by] > 0, -1)
                    given[to] = np.where(label < 0, pseudo, true).astype(np.int64)
            weight = np.where(label < 0, PSEUDO_WEIGHT, 1.0)
            kept = given[0][b.doc] >= 0
            total[0] += np.bincount(given[0][b.doc][kept] * PAIRS + b.pairs[kept],
                                    (b.share * weight[b.doc])[kept], minlength=2 * PAIRS)
            rows = given[1] >= 0
            slots = given[1][rows, None] * PAGE_SLOTS + b.page[rows]
            total[1] += np.bincount(slots.ravel(), np.repeat(weight[rows], slots.shape[1]), minlength=2 * PAGE_SLOTS)
        for view, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), view, np.int32)), pa.array(at), pa.array(t[at])], ["view", "slot", "n"])

    got = (stored.mapInArrow(lean(run), "view int, slot bigint, n double")
           .groupBy("view", "slot").agg(F.sum("n").alias("n")).toArrow())
    out = [np.zeros(2 * s) for s in sizes]
    for view in (0, 1):
        mine = got["view"].to_numpy() == view
        out[view][got["slot"].to_numpy()[mine]] = got["n"].to_numpy()[mine]
    return out[0].reshape(2, -1), out[1].reshape(2, -1)


def platt(score: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic fitted to counts of good and bad
    documents per score, by Newton's method with a slight pull to slope 0."""
    a, b = 0.0, float(np.log((good.sum() + 1) / (bad.sum() + 1)))
    n = good + bad
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        g = np.array([(score * (good - n * p)).sum() - 1e-3 * a, (good - n * p).sum()])
        w = n * p * (1 - p)
        h = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()],
                      [(w * score).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / np.abs(step).max()) if np.abs(step).max() > 0 else 1.0
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return a, b


def _calibrated(stored: DataFrame, views: Views) -> Views:
    """``views`` with both calibrations fitted on the held fold, from counts of
    its documents per score on a fixed grid."""
    shared = stored.sparkSession.sparkContext.broadcast(views)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.round(np.clip(shared.value.raw(Batch(batch)), -_RANGE, _RANGE) * _STEP).astype(np.int64)
            label = column(batch, "label").to_numpy(zero_copy_only=False).astype(np.int64)
            for view in (0, 1):
                keys, n = np.unique(np.column_stack([at[:, view], label]), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), view, np.int32)), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                     pa.array(n.astype(np.int64))], ["view", "score", "label", "n"])

    held = stored.filter((F.col("fold") == 0) & F.col("label").isNotNull())
    got = (held.mapInArrow(lean(run), "view int, score bigint, label bigint, n bigint")
           .groupBy("view", "score", "label").agg(F.sum("n").alias("n")).toArrow())
    fitted = np.array([[0.0, views.prior], [0.0, views.prior]])
    view, score, label, n = (got[c].to_numpy() for c in ("view", "score", "label", "n"))
    for i in (0, 1):
        mine = view == i
        good = np.where(label[mine] == 1, n[mine], 0).astype(float)
        bad = np.where(label[mine] == 0, n[mine], 0).astype(float)
        if good.sum() and bad.sum():
            fitted[i] = platt(score[mine] / _STEP, good, bad)
    return Views(views.pair_weight, views.page_weight, fitted, views.prior)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source", label_id_col: str = "doc_id",
          label_col: str = "quality", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, labelled, score, content_score, page_score (probabilities of good
    quality) of every row."""
    known = pick(labels, l_id=label_id_col, quality=label_col).filter("l_id IS NOT NULL AND quality IS NOT NULL")
    known, n = cut_lineage_counted(known.groupBy("l_id").agg(
        F.when(F.avg("quality") >= 0.5, 1).otherwise(0).cast("bigint").alias("label")))
    known = F.broadcast(known) if n <= SMALL_ROWS else known
    found = features(docs, id_col, text_col, lang_col, source_col)
    stored = cut_lineage(found.join(known, found["doc_id"] == known["l_id"], "left").drop("l_id")
                         .withColumn("fold", remainder_of_id("doc_id", FOLDS).cast("bigint")))
    got = {r["label"]: r["n"] for r in stored.filter("label IS NOT NULL").groupBy("label")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = got.get(1, 0), got.get(0, 0)
    prior = float(np.log((good + 0.5) / (bad + 0.5)))
    views = Views(np.zeros(PAIRS), np.zeros(PAGE_SLOTS), np.array([[0.0, prior], [0.0, prior]]), prior)
    if good and bad:
        for turn in range(rounds + 1):
            pair_sums, page_sums = _passed(stored, views if turn else None)
            views = _calibrated(stored, Views(weights(pair_sums, 0.01), weights(page_sums, 1.0),
                                              views.calibration, prior))
    shared = docs.sparkSession.sparkContext.broadcast(views)
    id_type = stored.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            odds = v.odds(Batch(batch))
            both = odds.sum(axis=1) - v.prior
            chance = 1 / (1 + np.exp(-np.clip(np.column_stack([both, odds]), -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "label").is_valid(), *[pa.array(chance[:, i]) for i in range(3)]],
                ["doc_id", "labelled", "score", "content_score", "page_score"])

    return stored.mapInArrow(lean(run), f"doc_id {id_type}, labelled boolean, score double, content_score double, "
                                  "page_score double")

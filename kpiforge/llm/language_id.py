"""Language identification of whole texts and of the spans of mixed ones.

Each word gets one score per language: the log probability of its letter
trigrams (word edges included). Unicode script ranges narrow the candidates
first: a language takes part in a word only if most of the word's letters
belong to a script that the language was seen to use. A Viterbi pass over the
words with a penalty for every change of language then labels spans, and a
document's language is the one whose spans hold most of its letters.

Trigrams are hashed into ``BUCKETS`` numbers per language, so the model's size
is languages times buckets whatever the corpus; Spark counts them over all
labelled texts of the training split.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
so is everything when no labelled text exists. A text whose letters belong to
no learned language's script gets the first learned language with score 0.
``keep_known`` also rejects texts whose letters fit their language far worse
than its documents do (gibberish, languages not learned); a language of one
document keeps it.
Ties go to the language that sorts first. Repeated rows are labelled one by
one. Only the text is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import CHUNK_BYTES, chunks, column, lean, small_batches, text_or_empty
from kpiforge.llm.textvec import mix, spans
from kpiforge.session import cut_lineage

BUCKETS = 1 << 17
SMOOTHING = 0.5
SWITCH = 14.0        # cost of a change of language, in nats
OUTSIDE = -50.0      # score of a language that a word's script rules out
SCRIPT_SHARE = 0.005  # of its letters, above which a language uses a script
OVERLAP = 3.0        # each letter takes part in three trigrams
UNKNOWN = "und"
FIT_WIDTH = 8.0      # robust standard deviations below a language's median fit ...
LEAST_SPREAD = 0.08  # ... of at least so many nats a letter

# fixed values: Unicode block ranges of the scripts told apart (last included)
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F), ("sinhala", 0x0D80, 0x0DFF), ("thai", 0x0E00, 0x0E7F),
    ("lao", 0x0E80, 0x0EFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("han", 0x20000, 0x2FFFF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]

_tables: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


def code_point_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is a letter, lower case, script) of every code point; made once a process."""
    global _tables
    if _tables is None:
        n = 0x110000
        letter = np.fromiter((chr(i).isalpha() for i in range(n)), bool, n)
        low = np.arange(n, dtype=np.uint32)
        for i in np.flatnonzero(letter):
            s = chr(i).lower()
            if len(s) == 1:
                low[i] = ord(s)
        script = np.zeros(n, np.uint8)
        for name, a, b in SCRIPTS:
            script[a:b + 1] = SCRIPT_NAMES.index(name)
        _tables = letter, low, script
    return _tables


class Letters:
    """Letters of a column of texts with their words, trigram buckets and scripts."""

    def __init__(self, texts: pa.Array):
        letter, low, script = code_point_tables()
        strings = texts.to_pylist()
        points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4")
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
        self.starts, self.ends = spans((points != 0x20) & ((points < 9) | (points > 13)), self.offsets)
        self.of = np.searchsorted(self.starts, self.offsets)  # words of text d: of[d]:of[d + 1]
        at = np.flatnonzero(letter[points])
        self.word = np.searchsorted(self.starts, at, side="right") - 1
        cur = low[points[at]].astype(np.uint64)
        near = np.zeros(len(at), bool)
        near[1:] = (at[1:] == at[:-1] + 1) & (self.word[1:] == self.word[:-1])
        left = np.zeros_like(cur)
        left[1:] = np.where(near[1:], cur[:-1], 0)
        right = np.zeros_like(cur)
        right[:-1] = np.where(near[1:], cur[1:], 0)
        self.bucket = (mix(cur | left << np.uint64(21) | right << np.uint64(42)) % np.uint64(BUCKETS)).astype(np.int64)
        self.script = script[points[at]]
        self.per_word = np.bincount(self.word, minlength=len(self.starts))


@dataclass
class Model:
    languages: list[str]        # sorted
    logp: np.ndarray            # bucket x language
    uses: np.ndarray            # script x language


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of every labelled text; each task adds up before it sends."""
    small_batches(labelled.sparkSession)
    d = labelled.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                        F.col(f"`{lang_col}`").alias("lang")).filter(F.col("lang").isNotNull())
    size = BUCKETS + len(SCRIPT_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch):
                found = Letters(column(part, "text"))
                names, lang = np.unique(np.array(column(part, "lang").to_pylist(), dtype=object).astype(str),
                                        return_inverse=True)
                of_letter = np.repeat(lang, np.diff(found.of))[found.word]
                for i, name in enumerate(names.tolist()):
                    mine = of_letter == i
                    got = total.setdefault(name, np.zeros(size, np.int32))
                    got[:BUCKETS] += np.bincount(found.bucket[mine], minlength=BUCKETS).astype(np.int32)
                    got[BUCKETS:] += np.bincount(found.script[mine], minlength=len(SCRIPT_NAMES)).astype(np.int32)
        for name, got in total.items():
            keys = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(got[keys].astype(np.int64))],
                ["lang", "bucket", "n"])

    counts = (d.mapInArrow(lean(run), "lang string, bucket bigint, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(counts["lang"].unique().to_pylist())
    n = np.zeros((size, len(languages)))
    if languages:
        index = {name: i for i, name in enumerate(languages)}
        n[counts["bucket"].to_numpy(), [index[x] for x in counts["lang"].to_pylist()]] = counts["n"].to_numpy()
    grams, scripts = n[:BUCKETS], n[BUCKETS:]
    logp = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS))
    uses = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, logp.astype(np.float32), uses)


def word_scores(found: Letters, model: Model) -> np.ndarray:
    """word x language: log probabilities, 0 for words without letters or
    without a candidate language."""
    words, k = len(found.starts), len(model.languages)
    out = np.zeros((words, k))
    some = np.flatnonzero(found.per_word)
    if len(some):
        first = np.concatenate([[0], np.cumsum(found.per_word[some])[:-1]])
        out[some] = np.add.reduceat(model.logp[found.bucket], first, axis=0, dtype=np.float64) / OVERLAP
        allowed = np.add.reduceat(model.uses[found.script].astype(np.int32), first, axis=0)
        candidate = 2 * allowed > found.per_word[some][:, None]
        none = ~candidate.any(axis=1)
        out[some] = np.where(candidate, out[some], OUTSIDE * found.per_word[some][:, None])
        out[some[none]] = 0.0
    return out


def best_constant(scores: np.ndarray, of: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """Each text's best single language, and whether that is sure to be its best
    path: a path of m runs has m - 1 changes at least, so it is if no other
    language gains more than half of ``switch`` over any run of words."""
    total = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0)])
    best = np.argmax(total[of[1:]] - total[of[:-1]], axis=1)
    doc = np.repeat(np.arange(len(of) - 1), np.diff(of))
    gain = scores - scores[np.arange(len(scores)), best[doc]][:, None]
    mixed = np.zeros(len(of) - 1, bool)
    for j in range(scores.shape[1]):
        after = np.cumsum(gain[:, j])
        # shifted down text by text, so that the running minimum starts anew with each
        down = doc * (2 * np.abs(gain[:, j]).sum() + 1.0) if len(gain) else doc
        low = np.minimum.accumulate(after - gain[:, j] - down) if len(gain) else after
        mixed[doc[(after - down) - low > switch / 2]] = True
    return best, ~mixed


def viterbi(scores: np.ndarray, of: np.ndarray, switch: float) -> np.ndarray:
    """The language of every word on each text's best path; all texts advance
    together, one word a step."""
    n = np.diff(of)
    out = np.zeros(len(scores), np.int64)
    order = np.argsort(-n, kind="stable")
    n, start = n[order], of[:-1][order]
    live = int(np.count_nonzero(n))
    n, start = n[:live], start[:live]
    if not live:
        return out
    value = scores[start].copy()
    stay = np.ones(scores.shape, bool)
    best = np.zeros(len(scores), np.int64)
    for t in range(1, int(n[0])):
        a = int(np.searchsorted(-n, -t))  # texts of more than t words
        v, at = value[:a], start[:a] + t
        b = np.argmax(v, axis=1)
        change = v[np.arange(a), b][:, None] - switch
        keep = v >= change
        value[:a] = np.where(keep, v, change) + scores[at]
        stay[at], best[at] = keep, b
    label = np.argmax(value, axis=1)
    for t in range(int(n[0]) - 1, -1, -1):
        a = int(np.searchsorted(-n, -t))
        at = start[:a] + t
        out[at] = label[:a]
        label[:a] = np.where(stay[at, label[:a]], label[:a], best[at])
    return out


def label_words(scores: np.ndarray, of: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi labels; texts whose best path is one language need no steps."""
    best, constant = best_constant(scores, of, switch)
    out = np.repeat(best, np.diff(of))
    rest = np.flatnonzero(~constant)
    if len(rest):
        pick = np.concatenate([np.arange(of[d], of[d + 1]) for d in rest])
        sub = np.concatenate([[0], np.cumsum(np.diff(of)[rest])])
        out[pick] = viterbi(scores[pick], sub, switch)
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             switch: float = SWITCH, **more: str) -> DataFrame:
    """doc_id, columns ``more``, lang_pred, score, spans (the labelled runs of
    words as (lang, start, end) in code points), letters in words that some
    language may hold and fit, those words' mean log probability a letter under
    their labels. No shuffle."""
    d = text_or_empty(docs, id_col, text_col, **more)
    kept = [c for c in d.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in kept)
    span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.languages)
        most = CHUNK_BYTES * 12 // max(8, k)
        for batch in batches:
            for part in chunks(batch, most=most):
                found = Letters(column(part, "text"))
                docs_here = len(found.of) - 1
                doc = np.repeat(np.arange(docs_here), np.diff(found.of))
                letters = np.bincount(doc, found.per_word, minlength=docs_here)
                name, score = np.array([UNKNOWN] * docs_here, dtype=object), np.zeros(docs_here)
                judged, fitted = np.zeros(docs_here, np.int64), np.zeros(docs_here)
                runs: list[list] = [[] for _ in range(docs_here)]
                if k:
                    scores = word_scores(found, m)
                    label = label_words(scores, found.of, switch)
                    held = np.zeros((docs_here, k))
                    np.add.at(held, (doc, label), found.per_word)
                    top = np.argmax(held, axis=1)
                    total = np.zeros((docs_here, k))
                    np.add.at(total, doc, scores)
                    total -= total.max(axis=1, keepdims=True)
                    chance = np.exp(total) / np.exp(total).sum(axis=1, keepdims=True)
                    some = (scores != 0).any(axis=1)
                    np.add.at(judged, doc[some], found.per_word[some])
                    np.add.at(fitted, doc, scores[np.arange(len(label)), label])
                    fitted /= np.maximum(judged, 1)
                    rows = np.arange(docs_here)
                    known = np.zeros(docs_here, bool)
                    known[doc[some]] = True
                    share = held[rows, top] / np.maximum(letters, 1)
                    # a mixed text's whole-text chance says nothing about its largest part
                    sure = np.where(share < 1, 1.0, chance[rows, top])
                    score = np.where(known, share * sure, 0.0)
                    name = np.where(letters > 0, np.array(m.languages, dtype=object)[top], UNKNOWN)
                    score = np.where(letters > 0, score, 0.0)
                    new = np.ones(len(label), bool)
                    new[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
                    at = np.flatnonzero(new)
                    last = np.append(at[1:], len(label)) - 1
                    base = found.offsets[doc[at]] if len(at) else at
                    for d_, l_, a, b in zip(doc[at].tolist(), label[at].tolist(), (found.starts[at] - base).tolist(),
                                            (found.ends[last] - base).tolist()):
                        if letters[d_]:
                            runs[d_].append({"lang": m.languages[l_], "start": a, "end": b})
                yield pa.RecordBatch.from_arrays(
                    [*[column(part, c) for c in kept], pa.array(name.tolist(), pa.string()),
                     pa.array(score, pa.float64()), pa.array(runs, pa.list_(span)), pa.array(judged),
                     pa.array(fitted)],
                    [*kept, "lang_pred", "score", "spans", "letters", "fit"])

    return d.mapInArrow(lean(run), f"{types}, lang_pred string, score double, "
                             "spans array<struct<lang: string, start: bigint, end: bigint>>, letters bigint, fit double")


def least_fit(found: DataFrame, width: float = FIT_WIDTH) -> DataFrame:
    """(lang_pred, mid, half, mid_letters): every predicted language's median fit,
    ``width`` robust standard deviations of it and median number of letters, over all
    documents. The deviation is taken from the upper half, as whatever does not belong
    lies below. One row for each learned language at most."""
    half = F.percentile_approx("fit", [0.5, 0.75], 10000)
    known = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("letters") > 0))
    rows = known.groupBy("lang_pred").agg(half.alias("q"), F.percentile_approx("letters", 0.5, 10000).alias("mid_letters"))
    spread = F.greatest((F.col("q")[1] - F.col("q")[0]) / 0.6745, F.lit(LEAST_SPREAD))
    return rows.select("lang_pred", F.col("q")[0].alias("mid"), (width * spread).alias("half"), "mid_letters")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               least_score: float = 1 / 3, width: float = FIT_WIDTH) -> DataFrame:
    """The rows of ``docs`` whose text is mainly of one learned language and fits
    it, with all of their columns; the model is fitted on the rows that name a
    language. Texts of fewer letters than their language's median may lie lower,
    by the root of the ratio. The texts are read three times and never stored."""
    ride = {f"_{i}": c for i, c in enumerate(docs.columns)}
    model = fit(docs, text_col, lang_col)
    limits = cut_lineage(least_fit(identify(docs, model, id_col, text_col), width).withColumnRenamed("lang_pred", "limit_lang"))
    found = identify(docs, model, id_col, text_col, **ride)
    # bounded by the model, which every worker holds anyway
    found = found.join(F.broadcast(limits), F.col("lang_pred") == F.col("limit_lang"), "left")
    short = F.sqrt(F.greatest(F.col("mid_letters") / F.greatest(F.col("letters"), F.lit(1)), F.lit(1.0)))
    fits = F.coalesce(F.col("fit") >= F.col("mid") - F.col("half") * short, F.lit(False))
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score) & fits)
    return kept.select(*[F.col(new).alias(c) for new, c in ride.items()])

"""Quality rules: document statistics and n-gram perplexity bands by language.

Perplexity comes from a modified Kneser-Ney model of character 4-grams. Every
character counts as itself, in all scripts: an n-gram is a 64-bit number made of
four UTF-16 units (a character beyond U+FFFF is two), so no two n-grams share a
number. Spark counts the n-grams of every text of the corpus; the lower orders'
continuation counts follow from them. A model of up to ``MOST_NGRAMS`` counted
n-grams is sorted arrays of n-grams beside their log probabilities and back-off
weights, broadcast and looked up by binary search. A larger one stays a Spark table,
worked out by joins and sums, and is joined to the distinct n-grams of blocks of
texts; both give the same probabilities. An n-gram of three or four units, or context of
one, that no other text has counts as unseen when a text is scored, or rare garbage would vouch for itself.

A document's perplexity is taken per word. Within each language, the median
and the interquartile range of log perplexity give a lower and an upper bound,
wider for short texts, whose mean over few words scatters more. Text that the
model finds far too predictable (shouting, lists, boilerplate) or far too
surprising (symbols between words, garbage) lies outside and is rejected.
A language weighs n / (n + ``PRIOR``) in its band, n its documents but one (so
that none vouches for itself alone), and the whole corpus the rest, as the mean and the spread of that mixture: the band of a
language of few documents goes over into the corpus's without a threshold.

Base rules: fewer than 50 words, or more than half of the words inside 3-word
windows that occur twice or more in the text.

Defined cases: null and empty texts have zero in every count and fail the base
rules; a null language is a language of its own; repeated rows are judged one by
one; a corpus of base-failing documents only has no bands and keeps nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import chunks, column, lean, small_batches, text_or_empty
from kpiforge.llm.textvec import Words, buffer_of, span_hashes, spans, windows
from kpiforge.session import cut_lineage, cut_lineage_counted

ORDER = 4
LONG = 3       # n-grams so long are unseen for the only text that has them
MIN_WORDS = 50
WIDTH = 5.0    # half-width of a band, in robust standard deviations
PRIOR = 5      # documents that the whole corpus counts for in a language's band
REPEAT_WORDS = 3
SMALL_ROWS = 100_000
MERGE = 1 << 19  # counts that wait in a task before they are added up
_U = np.uint64


# classes of characters are UTF-16 units: no letter of any script shares its class
CLASSES = SLOTS = 1 << 16
CLASS_OF = np.arange(CLASSES)  # of the code points below 65536; 0 also stands before a text's start
MOST_NGRAMS = 1 << 21  # n-grams of a model that is broadcast; more are joined
BLOCK_BYTES = 2 << 20  # texts whose n-grams are joined at once


def classes(raw: np.ndarray) -> np.ndarray:
    """The (first) UTF-16 unit of every character of UTF-8 bytes."""
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    first = raw[lead]
    out = CLASS_OF[first]
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        padded = np.concatenate([raw, np.zeros(3, np.uint8)])
        a, b, c = (padded[lead[wide] + i].astype(np.int64) & 0x3F for i in (1, 2, 3))
        f = first[wide].astype(np.int64)
        point = np.where(f < 0xE0, (f & 0x1F) << 6 | a,
                         np.where(f < 0xF0, (f & 0x0F) << 12 | a << 6 | b, (f & 0x07) << 18 | a << 12 | b << 6 | c))
        out[wide] = np.where(f < 0xF0, point, 0xD800 + ((point - 0x10000) >> 10))
    return out


def units_before(raw: np.ndarray) -> np.ndarray:
    """How many UTF-16 units the characters have that begin before each byte, and in all."""
    return np.concatenate([[0], np.cumsum(((raw & 0xC0) != 0x80).astype(np.int64) + (raw >= 0xF0))])


def ngram_codes(raw: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Code of the n-gram that ends at each unit; positions before a text's start
    count as class 0."""
    c = classes(raw)
    at_byte = units_before(raw)
    lead = np.flatnonzero(raw >= 0xF0)
    if len(lead):  # the second unit of a pair: ten bits of the last two bytes and a half
        low = ((raw[lead + 1].astype(np.int64) & 0x3F) << 12 | (raw[lead + 2].astype(np.int64) & 0x3F) << 6
               | raw[lead + 3] & 0x3F) & 0x3FF
        after = np.cumsum((raw & 0xC0) != 0x80)[lead]
        c = np.insert(c, after, 0xDC00 + low)
    c = c.astype(_U)
    code = c.copy()
    starts = np.unique(at_byte[offsets[:-1][np.diff(offsets) > 0]])
    for back in range(1, order):
        shifted = np.zeros_like(c)
        shifted[back:] = c[:-back]
        for i in range(back):  # the units that would look into the text before
            at = starts + i
            shifted[at[at < len(c)]] = 0
        # short texts: position start + i may belong to the next text, whose
        # own start is at most that far back, so it looks across as well
        code |= shifted << _U(16 * back)
    return code


# ---- the model --------------------------------------------------------------

@dataclass
class Level:
    """One order: sorted n-gram hashes with log10 probabilities, and sorted
    context hashes with log10 back-off weights."""
    keys: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, x)
    at[at == len(keys)] = 0
    return at, (keys[at] == x) if len(keys) else np.zeros(len(x), bool)


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more, from the
    counts of counts; where those are missing a discount stays within [0, c]."""
    return discounts_of(np.array([np.count_nonzero(counts == c) for c in (1, 2, 3, 4)], float))


def discounts_of(n: np.ndarray) -> np.ndarray:
    """Discounts from how many n-grams have the counts 1, 2, 3 and 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    d = np.zeros(4)
    for c in (1, 2, 3):
        ratio = n[c] / n[c - 1] if n[c - 1] else 0.0
        d[c] = min(max(c - (c + 1) * y * ratio, 0.0), c)
    return d


class KneserNey:
    """Interpolated modified Kneser-Ney over n-gram codes in base ``base``. With
    the least and the greatest number of the texts that have each n-gram, what only
    one text has is unseen when a text is looked up, so that none vouches for itself."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int = ORDER, base: int = CLASSES,
                 first: np.ndarray | None = None, last: np.ndarray | None = None):
        self.order, self.base = order, base
        self.floor = -np.log10(base)  # the uniform distribution below the unigrams
        self.levels: list[Level] = []
        if first is None:
            first, last = np.zeros(len(codes), np.int64), np.ones(len(codes), np.int64)
        tables = [(codes, counts, first, last)]
        shared = []
        for n in range(order - 1, 0, -1):
            # continuation count: in how many distinct left contexts an n-gram occurs
            above, _, first, last = tables[0]
            tables.insert(0, _grouped(above % base ** n, first, last))
        for n, (keys, c, first, last) in enumerate(tables, 1):
            c = c.astype(float)
            d = discounts(c)[np.minimum(c, 3).astype(int)]
            contexts, of = np.unique(keys // base, return_inverse=True)
            total = np.bincount(of, c)
            weight = np.bincount(of, d) / total
            if n == 1:
                lower = np.full(len(keys), self.floor)
            else:
                lower = self._at(n - 1, keys % base ** (n - 1))
            p = (c - d) / total[of] + weight[of] * 10.0 ** lower
            with np.errstate(divide="ignore"):
                self.levels.append(Level(keys, np.log10(p), contexts, np.log10(weight)))
            _, _, low, high = _grouped(keys // base, first, last)
            shared.append((first != last, low != high) if n >= LONG else (first == first, low == low))
        self.levels = [Level(x.keys[k], x.logp[k], x.contexts[c], x.backoff[c]) for x, (k, c) in zip(self.levels, shared)]

    def _at(self, n: int, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each n-gram's last symbol after the others."""
        if n == 0:
            return np.full(len(codes), self.floor)
        level = self.levels[n - 1]
        at, hit = _find(level.keys, codes)
        out = level.logp[at] if len(level.keys) else np.full(len(codes), self.floor)
        miss = np.flatnonzero(~hit)
        if len(miss):
            x = codes[miss]
            out[miss] = self._at(n - 1, x % self.base ** (n - 1))
            at, known = _find(level.contexts, x // self.base)
            out[miss[known]] += level.backoff[at[known]]
        return out

    def log10(self, codes: np.ndarray) -> np.ndarray:
        return self._at(self.order, codes.astype(_U))


@dataclass
class Known:
    """Log probabilities of the n-grams of some texts, sorted by n-gram."""
    keys: np.ndarray
    logp: np.ndarray
    order: int

    def log10(self, codes: np.ndarray) -> np.ndarray:
        return self.logp[np.searchsorted(self.keys, codes)]


def _grouped(codes: np.ndarray, first: np.ndarray, last: np.ndarray,
             n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct code, number of its rows or sum of their ``n``, least ``first``, greatest ``last``)."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    at = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    many = np.diff(np.append(at, len(codes))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    if not len(at):
        return codes, many, first, last
    return codes[at], many, np.minimum.reduceat(first[order], at), np.maximum.reduceat(last[order], at)


def _added(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of several parts added up by code."""
    codes, n, first, last = (np.concatenate(x) for x in zip(*parts))
    return _grouped(codes, first, last, n)


def _counted(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the n-grams of some texts. A text's number is a hash of it, so copies are one text."""
    raw, offsets = buffer_of(texts)
    codes = ngram_codes(raw, offsets, order)
    number = span_hashes(raw, offsets[:-1], offsets[1:]).view(np.int64)
    text = np.repeat(number, np.diff(units_before(raw)[offsets]))
    return _grouped(codes, text, text)


def count_ngrams(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(code, n, first, last): the n-gram counts of all texts, and the least and the
    greatest number of those that have it. Each task adds up its counts
    before it sends them, up to ``MOST_NGRAMS`` n-grams at a time. A code is
    signed here, with the bits of the unsigned one."""
    small_batches(docs.sparkSession)
    d = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def out(parts: list) -> pa.RecordBatch:
        keys, n, first, last = _added(parts)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n), pa.array(first), pa.array(last)],
                                          ["code", "n", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            for part in chunks(batch):
                parts.append(_counted(column(part, "text"), order))
                waiting += len(parts[-1][0])
                if waiting > max(MERGE, len(parts[0][0]) if parts else 0):
                    parts, waiting = [_added(parts)], 0
                    if len(parts[0][0]) > MOST_NGRAMS:
                        yield out(parts)
                        parts = []
        if parts:
            yield out(parts)

    return d.mapInArrow(lean(run), "code bigint, n bigint, first bigint, last bigint").groupBy("code").agg(
        F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def fit(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> KneserNey | DataFrame:
    """The model of the whole corpus: a ``KneserNey`` if it has at most
    ``MOST_NGRAMS`` n-grams, else the table of ``probabilities``."""
    counts, n = cut_lineage_counted(count_ngrams(docs, text_col, order))
    if n > MOST_NGRAMS:
        return cut_lineage(probabilities(counts, order))
    got = counts.toArrow()
    codes = got["code"].to_numpy().view(_U)
    at = np.argsort(codes)
    return KneserNey(codes[at], got["n"].to_numpy()[at], order, CLASSES,
                     got["first"].to_numpy()[at], got["last"].to_numpy()[at])


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, logp): what ``KneserNey`` gives for each n-gram of the counts, ``p``
    being its probability and ``q`` that for a text that may be the only one to have it. No
    context and no suffix has more n-grams than there are classes, so no key of
    these joins is large."""
    bits = CLASSES.bit_length() - 1
    tables = [counts.select("code", F.col("n").alias("c"), "first", "last")]
    span = [F.min("first").alias("first"), F.max("last").alias("last")]
    for n in range(order - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit((1 << bits * n) - 1))
        tables.insert(0, cut_lineage(tables[0].groupBy(suffix.alias("code")).agg(F.count(F.lit(1)).alias("c"), *span)))
    lower = None
    for n, table in enumerate(tables, 1):
        many = table.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()
        cut = discounts_of(np.array(many, float))
        rows = table.withColumn("d", F.get(F.array(*[F.lit(float(x)) for x in cut]), F.least("c", F.lit(3)).cast("int")))
        rows = rows.withColumn("context", F.shiftrightunsigned("code", bits))
        of = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"),
                                        (F.min("first") == F.max("last")).alias("alone"))
        rows = rows.join(of, "context")
        if lower is None:
            rows = rows.withColumn("below", F.lit(1.0 / CLASSES)).withColumn("below_q", F.col("below"))
        else:
            rows = rows.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << bits * (n - 1)) - 1)))
            rows = rows.join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("below"), F.col("q").alias("below_q")), "suffix")
        weight = F.col("left") / F.col("total")
        p = (F.col("c") - F.col("d")) / F.col("total") + weight * F.col("below")
        q = F.when((F.col("first") < F.col("last")) | F.lit(n < LONG), p).otherwise(F.when(F.col("alone"), 1.0).otherwise(weight) * F.col("below_q"))
        lower = cut_lineage(rows.select("code", p.alias("p"), q.alias("q")))
    return lower.select("code", F.log10("q").alias("logp"))


# ---- statistics of one column of texts --------------------------------------

def repeated(keys: np.ndarray) -> np.ndarray:
    """Which items have a key that another item has too."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def statistics(texts: pa.Array, model: KneserNey | Known | None = None) -> dict[str, np.ndarray]:
    """Counts of every text, and its log10 probability under ``model``."""
    w = Words(texts)
    docs = len(w.of) - 1
    salt = np.arange(1, docs + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
    doc_of = w.doc_index()
    character = (w.raw & 0xC0) != 0x80  # first bytes of code points
    seen = np.concatenate([[0], np.cumsum(character)])
    out = {"n_words": w.counts(),
           "word_chars": np.bincount(doc_of, seen[w.ends] - seen[w.starts], minlength=docs).astype(np.int64)}

    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    so_far = np.concatenate([[0], np.cumsum(symbol[w.raw])])
    out["n_symbols"] = np.diff(so_far[w.offsets])

    start, end = spans(w.raw != 0x0A, w.offsets)
    filled = np.searchsorted(w.starts, end) > np.searchsorted(w.starts, start)
    start, end = start[filled], end[filled]
    line_doc = np.searchsorted(w.offsets, start, side="right") - 1
    key = span_hashes(w.raw, start, end) ^ salt[line_doc]
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = (np.bincount(line_doc, minlength=docs)
                          - np.bincount(line_doc[first], minlength=docs)).astype(np.int64)

    at, h = windows(w.hash, w.of, REPEAT_WORDS)
    at = at[repeated(h ^ salt[doc_of[at]])]
    covered = np.zeros(len(w.hash), bool)
    for j in range(REPEAT_WORDS):
        covered[at + j] = True
    out["n_repeat_words"] = np.bincount(doc_of[covered], minlength=docs).astype(np.int64)

    if model is not None:
        logp = model.log10(ngram_codes(w.raw, w.offsets, model.order))
        so_far = np.concatenate([[0.0], np.cumsum(logp)])
        out["log10_prob"] = np.diff(so_far[units_before(w.raw)[w.offsets]])
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score(docs: DataFrame, model: KneserNey | DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **more: str) -> DataFrame:
    """doc_id, further columns ``more``, the counts and log10_prob of every row.
    A model that is a table must have every n-gram of the texts."""
    d = text_or_empty(docs, id_col, text_col, **more)
    kept = [c for c in d.columns if c != "text"]
    types = {c: d.schema[c].dataType.simpleString() for c in d.columns}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", " + ", ".join(f"{c} bigint" for c in COUNTS) + ", log10_prob double"

    def scored(part: pa.RecordBatch, model: KneserNey | Known) -> pa.RecordBatch:
        s = statistics(column(part, "text"), model)
        return pa.RecordBatch.from_arrays(
            [*[column(part, c) for c in kept], *[pa.array(s[c].astype(np.int64)) for c in COUNTS],
             pa.array(s["log10_prob"])], [*kept, *COUNTS, "log10_prob"])

    if isinstance(model, DataFrame):
        return _joined(d, model, scored, schema, types)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield scored(part, shared.value)

    return d.mapInArrow(lean(run), schema)


def _joined(d: DataFrame, model: DataFrame, scored, schema: str, types: dict[str, str], order: int = ORDER) -> DataFrame:
    """``score`` with a table: texts in numbered blocks, stored; the distinct
    n-grams of each block meet the table and come back to the block."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in chunks(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, block))],
                                                 [*part.schema.names, "_block"])
                size += column(part, "text").nbytes
                if size >= BLOCK_BYTES:
                    block, size = block + 1, 0

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = np.zeros(0, _U), None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(held), now)), pa.array(held.view(np.int64))], ["_block", "code"])

        for batch in batches:
            of = column(batch, "_block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)] if len(of) else [0]
            for a, b in zip(cuts, cuts[1:]):
                if now is not None and of[a] != now:
                    yield out()
                    held = held[:0]
                now = of[a]
                held = np.unique(np.concatenate([held, ngram_codes(*buffer_of(column(batch.slice(a, b - a), "text")), order)]))
        if now is not None:
            yield out()

    def meet(rows: pa.Table, found: pa.Table) -> pa.Table:
        keys, first = np.unique(found["code"].to_numpy().view(_U), return_index=True)
        known = Known(keys, found["logp"].to_numpy()[first], order)
        return pa.Table.from_batches([scored(rows.combine_chunks().to_batches()[0], known)])

    blocked = cut_lineage(d.mapInArrow(lean(number), ", ".join(f"`{c}` {t}" for c, t in types.items()) + ", _block bigint"))
    found = (blocked.select("text", "_block").mapInArrow(lean(distinct), "_block bigint, code bigint")
             .join(model, "code").select("_block", "code", "logp"))
    return blocked.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(meet, schema)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          width: float = WIDTH, **more: str) -> DataFrame:
    """Every row's counts, base_failed, perplexity, its language's band and
    ``kept``, beside further columns ``more`` (new name = column). Reads the
    texts twice: to count n-grams and to score. The scored rows hold no text
    (unless ``more`` asks for it) and are stored, as the bands are taken from
    all of them."""
    model = fit(docs, text_col)
    scored = score(docs, model, id_col, text_col, lang=lang_col, **more)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = cut_lineage(scored.withColumn("base_failed", failed)
                         .withColumn("log_ppl", -F.col("log10_prob") / F.greatest(F.col("n_words"), F.lit(1))))
    quarter = F.percentile_approx("log_ppl", [0.25, 0.5, 0.75], 10000)
    # scatter of the mean over n words around the median, as if over 100 words
    passed = scored.filter(~F.col("base_failed"))
    whole = passed.agg(quarter.alias("q")).first()["q"] or [0.0, 0.0, 0.0]
    corpus_mid, corpus_spread = F.lit(whole[1]), F.lit((whole[2] - whole[0]) / 1.349)
    own_mid, own_spread, own = F.col("q")[1], (F.col("q")[2] - F.col("q")[0]) / 1.349, F.col("others") / (F.col("others") + PRIOR)
    variance = (own * own_spread * own_spread + (1 - own) * corpus_spread * corpus_spread
                + own * (1 - own) * (own_mid - corpus_mid) * (own_mid - corpus_mid))
    bands = (passed.groupBy("lang")
             .agg(quarter.alias("q"), (F.count(F.lit(1)) - 1).alias("others"),
                  F.percentile_approx("n_words", 0.5, 10000).alias("mid_words"))
             .select(F.col("lang").alias("band_lang"), (own * own_mid + (1 - own) * corpus_mid).alias("mid"),
                     F.sqrt(variance).alias("spread"), "mid_words"))
    # one row per language: broadcast up to a counted size, as one language may hold most rows
    bands, n = cut_lineage_counted(bands)
    bands = F.broadcast(bands) if n <= SMALL_ROWS else bands
    d = scored.join(bands, scored["lang"].eqNullSafe(bands["band_lang"]), "left").drop("band_lang")
    half = width * F.col("spread") * F.sqrt(F.greatest(F.col("mid_words") / F.greatest(F.col("n_words"), F.lit(1)), F.lit(1.0)))
    d = d.withColumn("ppl_low", F.col("mid") - half).withColumn("ppl_high", F.col("mid") + half)
    inside = F.coalesce(F.col("log_ppl").between(F.col("ppl_low"), F.col("ppl_high")), F.lit(True))
    return d.withColumn("kept", ~F.col("base_failed") & inside).drop("mid", "spread", "mid_words")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              width: float = WIDTH) -> DataFrame:
    """The rows of ``docs`` that pass, with all of their columns. The columns
    ride along with the scores, so no join brings rows and verdicts together."""
    ride = {f"_{i}": c for i, c in enumerate(docs.columns)}
    kept = judge(docs, id_col, text_col, lang_col, width, **ride).filter("kept")
    return kept.select(*[F.col(new).alias(c) for new, c in ride.items()])

"""Secret scan with corpus-wide ownership frequency. DataFrame functions only.

Candidates are assignments to secret-sounding names, access keys, long hex
strings and opaque tokens (long runs of token characters with letters and
digits). Each candidate value's hash is counted over the whole corpus by
distinct repositories (documents) and owners: a value found with several
owners is a widely copied example, one that a single owner holds looks live.

Spans. A pattern's matches are wrapped in control characters that the text
itself cannot hold (it is cleared of them first, code point by code point), so
that splitting there gives the text between and inside the matches, and sums
of their lengths give code point positions. Failing matches still consume
their text, as leftmost non-overlapping search demands.

All assign, access and hex matches are reported; opaque tokens where they
overlap no other span. ``scan`` alone leaves out opaque tokens of more than
``LIVE_OWNERS`` owners. With ``wide``, as the query and ``redact`` call it, it
reports all of them, and a value is an example (not live) only if distinct texts
that hold it number more than ``WIDE[1]`` and have more than ``WIDE[0]`` owners;
copies of one text count once, for the least of their owners. ``redact`` masks
base spans and live ones and leaves opaque examples in the text.

Defined cases: a null or empty text has no spans; a null owner is an owner of
its own; repeated rows of one document are one repository and each get the
spans; a null doc_id is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import text_or_empty
from kpiforge.session import cut_lineage, cut_lineage_counted

KINDS = ["assign", "access", "hex", "opaque"]  # the order among spans of one start
LIVE_OWNERS = 1   # a value of more owners is an example
WIDE = (2, 9)     # owners and distinct texts beyond which a value is widely copied
VALUE_CHARS = 12  # of an assignment
SMALL_ROWS = 200_000
BLOCK = 64        # spans looked through together
TEXT_BLOCK = 4096  # code points of a text cut from together

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
          r"([A-Za-z0-9+/_.=-]+)")
# a match of fewer characters fails, and none can start inside it
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
# what chance leaves in a token: a digit beside a letter, a capital after a small
# letter that begins no word; so many at least, and one in so many characters
CHANGE = "(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]|(?<=[a-z])[A-Z](?![a-z])"
CHANGES, APART = 3, 8
UUID = "[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
OPAQUE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}"

_SPAN = "array<struct<start:int,kind:int,end:int,value:binary>>"


def _unmarked(text: Column) -> Column:
    """The text without the marks' own code points, at unchanged length."""
    return F.when(text.rlike(r"[\x01-\x03]"), F.translate(text, "\x01\x02\x03", "\x04\x04\x04")).otherwise(text)


def _before(sizes: Column, fold: str, use) -> Column:
    """``use(before)`` where ``before(i)`` is the sum (``fold`` "sum") or the greatest
    ("max") of the elements ahead of element i: blocks are folded once, so the work
    grows with the elements, not with their square."""
    def over(part: Column) -> Column:
        if fold == "max":
            return F.coalesce(F.array_max(part), F.lit(0))
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    many = F.floor((F.size(sizes) - 1) / BLOCK).cast("int")
    blocks = F.when(F.size(sizes) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(many, F.lit(0))), lambda k: over(F.slice(sizes, k * BLOCK + 1, F.lit(BLOCK)))))

    def with_blocks(tops: Column) -> Column:
        ahead = F.transform(tops, lambda _, k: over(F.slice(tops, F.lit(1), k)))

        def with_ahead(so_far: Column) -> Column:
            def before(i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                near = over(F.slice(sizes, block * BLOCK + 1, i - block * BLOCK))
                top = F.get(so_far, block)
                return F.greatest(top, near) if fold == "max" else top + near
            return use(before)

        return once(ahead, with_ahead)

    return once(blocks, with_blocks)


def _walk(pieces: Column, step: int, kind: int) -> Column:
    """Spans from the pieces of a marked text: each match is ``step`` - 1 pieces
    behind one piece of plain text."""
    def spans(sizes: Column) -> Column:
        def size(i: Column) -> Column:
            return F.get(sizes, i)

        def located(before) -> Column:
            def span(k: Column) -> Column:
                first = k * step
                start = before(first + 1)
                end = start + size(first + 1) + (size(first + 2) if step == 3 else F.lit(0))
                return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                                F.unhex(F.md5(F.get(pieces, first + step - 1))).alias("value"))

            matches = F.floor((F.size(pieces) - 1) / step).cast("int")
            which = F.slice(F.sequence(F.lit(0), matches), F.lit(1), matches)
            if step == 3:
                which = F.filter(which, lambda k: size(k * step + 2) >= VALUE_CHARS)
            if kind == KINDS.index("opaque"):
                which = F.filter(which, lambda k: _random(F.get(pieces, k * step + 1)))
            return F.transform(which, span)

        return _before(sizes, "sum", located)

    walked = once(F.transform(pieces, lambda p: F.char_length(p)), spans)
    return F.coalesce(walked, F.array().cast(_SPAN))


def _random(token: Column) -> Column:
    """Whether a token looks like chance."""
    changes = F.regexp_count(token, F.lit(CHANGE))
    return (changes >= CHANGES) & (changes * APART >= F.char_length(token)) & ~token.rlike(f"^{UUID}$")


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: inside another function's
    lambda Spark would work it out again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(text: Column, pattern: str, kind: int, groups: bool = False) -> Column:
    marked = F.regexp_replace(text, pattern, "\x01$1\x02$2\x03" if groups else "\x01$0\x02")
    found = once(F.split(marked, r"[\x01-\x03]"), lambda pieces: _walk(pieces, 3 if groups else 2, kind))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPAN))


def _apart(spans: Column, base: Column) -> Column:
    """The spans that overlap none of ``base``, which is sorted: only the blocks
    of it that reach into a span are looked through."""
    def block(i: Column) -> Column:
        part = F.slice(base, i * BLOCK + 1, F.lit(BLOCK))
        return once(part, lambda p: F.struct(F.get(p, F.lit(0))["start"].alias("start"),
                                             F.array_max(F.transform(p, lambda b: b["end"])).alias("end"), p.alias("spans")))

    def meets(a: Column, b: Column) -> Column:
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    many = F.floor((F.size(base) - 1) / BLOCK).cast("int")
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(once(
        F.transform(F.sequence(F.lit(0), F.greatest(many, F.lit(0))), block),
        lambda blocks: F.filter(spans, lambda o: ~F.exists(
            blocks, lambda k: meets(o, k) & F.exists(k["spans"], lambda b: meets(o, b))))))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               owner_col: str = "source") -> DataFrame:
    """(doc_id, key, owner, base, opaque): the spans of every row, with the
    hashes of their values; key is the text's MD5. One scan of the texts."""
    d = text_or_empty(docs, id_col, text_col, owner=owner_col)
    d = d.withColumn("key", F.unhex(F.md5("text"))).withColumn("text", _unmarked(F.col("text")))
    text = F.col("text")
    d = d.select("doc_id", "key", F.coalesce("owner", F.lit("")).alias("owner"),
                 _matches(text, ASSIGN, 0, groups=True).alias("assign"), _matches(text, ACCESS, 1).alias("access"),
                 _matches(text, HEX, 2).alias("hex"), _matches(text, OPAQUE, 3).alias("opaque"))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    d = d.select("doc_id", "key", "owner", "opaque", base.alias("base"))
    return d.select("doc_id", "key", "owner", "base", once(F.struct("opaque", "base"), lambda x: _apart(x["opaque"], x["base"])).alias("opaque"))


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_owners, n_docs, text_owners, n_texts): distinct owners and
    repositories of every candidate value, and the same over distinct texts, by
    partial sums over ever coarser keys."""
    spans = found.select("doc_id", "key", "owner", F.explode(F.concat("base", "opaque")).alias("s"))
    by_doc = spans.groupBy(F.col("s.value").alias("value"), "owner", "doc_id", "key").agg(F.lit(1).alias("one"))
    by_owner = by_doc.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    rows = by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_docs"))
    by_text = by_doc.groupBy("value", "key").agg(F.min("owner").alias("owner"))
    by_owner = by_text.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    texts = by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("text_owners"), F.sum("n").alias("n_texts"))
    return rows.join(texts, "value")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         live_owners: int = LIVE_OWNERS, wide: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, key and spans of every row: array of (start, kind, end, n_owners,
    n_docs, live) by start and kind, positions in code points. ``wide``: the
    owners and texts beyond which a value is an example; opaque ones stay then."""
    found = cut_lineage(candidates(docs, id_col, text_col, owner_col))
    live = F.col("n_owners") <= live_owners
    if wide is not None:
        live = (F.col("text_owners") <= wide[0]) | (F.col("n_texts") <= wide[1])
    judged = ownership(found).select("value", "n_owners", "n_docs", live.alias("live"))
    spans = (found.select("doc_id", "key", F.explode(F.concat("base", "opaque")).alias("s"))
             .select("doc_id", "key", "s.start", "s.kind", "s.end", "s.value").distinct()
             .join(judged, "value")
             .filter((F.col("kind") != KINDS.index("opaque")) | F.col("live") | F.lit(wide is not None)))
    grouped = spans.groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "n_owners", "n_docs", "live"))).alias("spans"))
    grouped = grouped.withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    bare = found.select("doc_id", "key")
    joined = bare.join(grouped, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast(grouped.schema["spans"].dataType)
    return joined.select("doc_id", "key", F.coalesce("spans", none).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with ``mask`` for every span that begins behind all before it;
    what lies between is cut from blocks of the text, never from its start."""
    def cut(blocks: Column, a: Column, b: Column) -> Column:
        """Code points a to b, b exclusive."""
        first, last = F.floor(a / TEXT_BLOCK).cast("int"), F.floor(b / TEXT_BLOCK).cast("int")
        head, tail = F.coalesce(F.get(blocks, first), F.lit("")), F.coalesce(F.get(blocks, last), F.lit(""))
        across = F.concat(F.substring(head, a % TEXT_BLOCK + 1, F.lit(TEXT_BLOCK)),
                          F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                          F.substring(tail, F.lit(1), b % TEXT_BLOCK))
        return F.when(a >= b, "").when(first == last, F.substring(head, a % TEXT_BLOCK + 1, b - a)).otherwise(across)

    def pieces(blocks: Column) -> Column:
        def piece(before):
            return lambda s, i: once(before(i), lambda at: F.when(s["start"] < at, "").otherwise(
                F.concat(cut(blocks, at, s["start"]), F.lit(mask))))
        return once(F.transform(spans, lambda s: s["end"]), lambda ends: F.concat(
            F.array_join(_before(ends, "max", lambda before: F.transform(spans, piece(before))), ""),
            cut(blocks, F.array_max(ends), F.char_length(text))))

    return once(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0)), pieces)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
           chars_col: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every base span and every live opaque one
    replaced by ``mask`` (overlapping spans by one) and ``chars_col``, if there is
    one, brought up to date. Opaque examples stay in the text."""
    secret = F.filter("spans", lambda s: (s["kind"] < KINDS.index("opaque")) | s["live"])
    hit, n = cut_lineage_counted(
        scan(docs, id_col, text_col, owner_col, wide=WIDE)
        .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), secret.alias("_spans"))
        .filter(F.size("_spans") > 0).dropDuplicates(["_id", "_key"]))
    hit = F.broadcast(hit) if n <= SMALL_ROWS else hit
    # the row travels as one struct, so none of its names can clash
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    d = d.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    d = d.join(hit, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    masked = _masked(F.col("text"), F.col("_spans"), mask)
    clean = F.col("_spans").isNull()
    d = d.select("row", clean.alias("clean"), F.when(clean, F.col("text")).otherwise(masked).alias("masked"))
    columns = {c: F.col("row")[c] for c in docs.columns}
    columns[text_col] = F.col("masked")
    if chars_col in columns:
        size = F.char_length("masked").cast(docs.schema[chars_col].dataType)
        columns[chars_col] = F.when(F.col("clean"), columns[chars_col]).otherwise(size)
    return d.select(*[value.alias(c) for c, value in columns.items()])

"""CSV files -> typed raw tables (full replace on every run)."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.schemas import NA_TOKENS, RAW_SCHEMAS
from kpiforge.session import hadoop_fs
from kpiforge.sources.catalog import RAW_DB, ensure_databases, replace_table
from kpiforge.sources.columns import TYPE_OF_KINDS, cast_columns, inferred_types, profile

log = logging.getLogger(__name__)

# Fragments removed from a file name (anywhere in it) to form
# the table name, in this order.
NAME_FRAGMENTS = (".csv", "olist_", "_dataset")


def table_name_for(filename: str) -> str:
    """``olist_order_items_dataset.csv`` -> ``order_items``; names without the
    fragments only lose ``.csv``."""
    name = filename
    for frag in NAME_FRAGMENTS:
        name = name.replace(frag, "")
    return name


def list_csv_files(spark: SparkSession, data_dir: str) -> list[str]:
    """Full paths of ``*.csv`` directly under ``data_dir``, sorted by file name.
    Listed through the Hadoop FileSystem of the path, so local folders, HDFS
    and object stores behave the same. A missing folder lists as empty."""
    path, fs = hadoop_fs(spark, data_dir)
    if not fs.exists(path):
        return []
    files = [s.getPath() for s in fs.listStatus(path) if s.isFile()]
    names = sorted((p.getName(), p.toString()) for p in files if p.getName().endswith(".csv"))
    return [full for _, full in names]


def list_csv_sources(spark: SparkSession, data_dir: str) -> list[tuple[str, str]]:
    """(table, path) for every source under ``data_dir``, sorted by name: each
    ``*.csv`` file, and each sub-folder holding ``*.csv`` part files (one table
    read by many tasks; the folder name is mapped like a file name)."""
    path, fs = hadoop_fs(spark, data_dir)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        p = st.getPath()
        name = p.getName()
        if st.isFile() and name.endswith(".csv"):
            out.append((name, table_name_for(name), p.toString()))
        elif st.isDirectory() and list_csv_files(spark, p.toString()):
            out.append((name, table_name_for(name), p.toString().rstrip("/") + "/*.csv"))
    return [(t, full) for _, t, full in sorted(out)]


def _null_tokens(c: F.Column, tokens=NA_TOKENS) -> F.Column:
    return F.when(c.isin(*tokens) | c.isNull(), F.lit(None)).otherwise(c)


@dataclass(frozen=True)
class Layout:
    """What one scan of the lines of a source tells: whether every line is a
    record, and the files with bytes that are not UTF-8 (with their lines)."""
    lines: bool
    not_utf8: dict[str, int]


def layout(spark: SparkSession, path: str) -> Layout:
    """No quoted field spans lines where every line closes the quotes it opens (a
    doubled quote counts twice); the files can then be read by many tasks each.
    One splittable text scan."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    bad = ~F.is_valid_utf8("value")
    found = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
             .filter((quotes % 2 == 1) | bad)
             .groupBy("file").agg(F.bool_or(quotes % 2 == 1).alias("open"), F.count_if(bad).alias("bad")).collect())
    return Layout(not any(r["open"] for r in found), {r["file"]: r["bad"] for r in found if r["bad"]})


def lines_are_records(spark: SparkSession, path: str) -> bool:
    """Whether no quoted field of the files spans lines."""
    return layout(spark, path).lines


class NotUtf8(ValueError):
    """A source holds bytes that are not UTF-8."""


def _reader(spark: SparkSession, multiline: bool, mode: str):
    return (spark.read.option("header", True).option("multiLine", multiline)
            .option("escape", '"').option("encoding", "UTF-8").option("enforceSchema", False)
            .option("inferSchema", False).option("mode", mode))


def _clean(name: str) -> str:
    return name.lstrip("\ufeff").strip()


def _declared(table: str | None) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in RAW_SCHEMAS.get(table or "", T.StructType([])).fields}


def _typed(df: DataFrame, table: str | None, strict: bool, infer: bool) -> DataFrame:
    """Text columns with their declared types; those that are not declared with
    the type all their values have, if ``infer``."""
    declared = _declared(table)
    others = [c for c in df.columns if c not in declared] if infer else []
    found = inferred_types(df, others) if others else {}
    cols = []
    for c in df.columns:
        v, t = F.col(f"`{c}`"), declared.get(c, found.get(c, T.StringType()))
        if not isinstance(t, T.StringType):
            v = F.trim(v) if c in found else v
            v = v.cast(t) if strict else v.try_cast(t)
        cols.append(v.alias(c))
    return df.select(*cols)


def read_csv(spark: SparkSession, path: str, table: str | None = None,
             strict: bool = True, multiline: bool | None = None,
             rounded: Observation | None = None, infer: bool = True) -> DataFrame:
    """Read one CSV (header, UTF-8, quoted fields may span lines, doubled
    quotes escape) as text, turn the usual missing-value tokens into null, then
    cast the columns of known tables to their declared types.

    ``strict`` fails the job on rows with more or fewer fields than the header,
    on bytes that are not UTF-8 and on malformed values; ``strict=False`` yields
    null instead (``scan_csv`` keeps such rows and columns whole). Part files
    whose headers differ are refused in both. Other columns take the type that
    all of their values have (``sources.columns``: one more scan), unless
    ``infer`` is off: then they stay STRING. Leading zeros are never lost. Files
    are read line-splittable where ``lines_are_records`` proves that safe;
    ``multiline`` overrides the choice. ``rounded`` observes, per money column,
    how many values had more digits than the column keeps.
    """
    if multiline is None:
        found = layout(spark, path)
        multiline = not found.lines
        if strict and found.not_utf8:
            raise NotUtf8("not UTF-8: " + ", ".join(f"{n} lines of {f}" for f, n in sorted(found.not_utf8.items())[:5]))
    raw = _reader(spark, multiline, "FAILFAST" if strict else "PERMISSIVE").csv(path)
    target = _declared(table)
    names = {name: _clean(name) for name in raw.columns}
    money = [n for n, clean in names.items() if isinstance(target.get(clean), T.DecimalType)]
    if rounded is not None:
        exact = {n: F.col(f"`{n}`").try_cast("decimal(38,10)") for n in money}
        raw = raw.observe(rounded, F.lit(0).alias("none"), *[
            F.count_if(exact[n] != exact[n].try_cast(target[names[n]])).alias(names[n]) for n in money])
    text = raw.select(*[_null_tokens(F.col(f"`{n}`")).alias(clean) for n, clean in names.items()])
    return _typed(text, table, strict, infer)


# --- sources that are not clean -------------------------------------------------

_BAD, _FILE = "_bad_record", "_file"
REPLACEMENT = "\ufffd"  # what the reader puts for bytes that are not UTF-8
SURPLUS, UNREADABLE, BYTES = "more fields than the header", "unreadable", "not UTF-8"
REJECT_SCHEMA = "file string, line bigint, rows bigint, reason string, record string"


def field_count(record: Column) -> Column:
    """Fields of one CSV record, quoted ones taken whole."""
    bare = F.regexp_replace(record, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


@dataclass
class CsvScan:
    """A source with its departures set apart. ``rows``: the loadable rows, with
    short ones padded with nulls, in types that all values of a column can take;
    ``rejects``: the other rows (see ``REJECT_SCHEMA``; equal records of a file
    are one row with their number and the first one's line, null where a file's
    records span lines); ``kept_as_text``: declared columns that hold a value
    their type cannot; ``counts`` observes rows padded and rejected once ``rows``
    are written."""
    rows: DataFrame
    rejects: DataFrame
    kept_as_text: list[str]
    counts: Observation


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of every line, the header being line 1. A block of a
    file lies in one partition, in order: its lines count on from those of the
    blocks before it."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    blocks = blocks.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def scan_csv(spark: SparkSession, path: str, table: str | None = None, infer: bool = True,
             found: Layout | None = None) -> CsvScan:
    """Read a source as ``read_csv`` does, but fail on nothing a row or a column
    can be blamed for. Rows with fewer fields than the header are padded; rows
    with more, unreadable ones and, where a source holds bytes that are not
    UTF-8, those with the sign that replaces them, are rejects. One scan tells
    the columns' types; the rejects are read only when asked for."""
    found = found or layout(spark, path)
    multiline = not found.lines
    header = _reader(spark, multiline, "PERMISSIVE").csv(path).columns
    names = [_clean(n) for n in header]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*header, _BAD]])
    raw = (_reader(spark, multiline, "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
           .option("columnPruning", False).schema(schema).csv(path))
    # Spark reads the bad record only together with a column of the file
    fields = field_count(F.coalesce(F.col(_BAD), F.col(f"`{header[0]}`")))
    reason = (F.when(F.col(_BAD).isNotNull() & (fields > len(header)), SURPLUS)
              .when(F.col(_BAD).isNotNull() & (fields == len(header)), UNREADABLE))
    if found.not_utf8:
        odd = F.lit(False)
        for n in header:
            odd = odd | F.coalesce(F.contains(F.col(f"`{n}`"), F.lit(REPLACEMENT)), F.lit(False))
        reason = F.when(odd, BYTES).otherwise(reason)
    marked = raw.select(*[F.col(f"`{n}`") for n in [*header, _BAD]], F.col("_metadata.file_path").alias(_FILE),
                        reason.alias("_reason"))
    counts = Observation()
    kept = marked.observe(counts, F.count_if(F.col("_reason").isNotNull()).alias("rejected"),
                          F.count_if(F.col("_reason").isNull() & F.col(_BAD).isNotNull()).alias("padded"))

    def loadable(df: DataFrame) -> DataFrame:
        return df.filter(F.col("_reason").isNull()).select(
            *[_null_tokens(F.col(f"`{n}`")).alias(clean) for n, clean in zip(header, names)])

    declared = {c: t for c, t in _declared(table).items() if c in names and not isinstance(t, T.StringType)}
    others = [c for c in names if c not in _declared(table)] if infer else []
    seen = profile(loadable(marked), others, declared)
    types = {c: TYPE_OF_KINDS.get(seen[c], T.StringType()) for c in others}
    as_text = [c for c in declared if seen[c]]
    types |= {c: t for c, t in declared.items() if c not in as_text}

    # rejects: (file, record, reason) with their number, then the first line of each
    record = F.coalesce(F.col(_BAD), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in header])))
    by_record = marked.filter(F.col("_reason").isNotNull()).select(
        F.col(_FILE).alias("file"), record.alias("record"), F.col("_reason").alias("reason"))
    keys = ["file", "record", "reason"]
    if multiline:
        rejects = by_record.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn("line", F.lit(None).cast("bigint"))
    else:
        lines = _numbered_lines(spark, path).filter(F.col("line") > 1)
        odd_lines = ~F.is_valid_utf8("value") | F.contains("value", F.lit(REPLACEMENT))
        bad = by_record.filter(F.col("reason") != BYTES).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        first = lines.join(bad.select("file", F.col("record").alias("value")), ["file", "value"], "left_semi").groupBy(
            "file", F.col("value").alias("record")).agg(F.min("line").alias("line"))
        rejects = bad.join(first, ["file", "record"], "left").select(*keys, "rows", "line")
        if found.not_utf8:
            rejects = rejects.unionByName(lines.filter(odd_lines).groupBy(
                "file", F.make_valid_utf8("value").alias("record")).agg(
                F.count(F.lit(1)).alias("rows"), F.min("line").alias("line")).withColumn("reason", F.lit(BYTES)))
    rejects = rejects.select("file", "line", "rows", "reason", "record")
    return CsvScan(cast_columns(loadable(kept), types), rejects, as_text, counts)


class Ingested(dict):
    """Rows loaded per table, in name order; besides them, where a table had any:
    ``padded`` and ``rejected`` rows, and declared columns ``kept_as_text``."""

    def __init__(self, rows=()):
        super().__init__(rows)
        self.padded: dict[str, int] = {}
        self.rejected: dict[str, int] = {}
        self.kept_as_text: dict[str, list[str]] = {}


MODES = ("strict", "padded", "quarantine")


def rejects_db(db: str) -> str:
    """The database of the rows that tables of ``db`` could not take."""
    return f"{db}_rejects"


def _load(spark: SparkSession, path: str, table: str, db: str, mode: str, out: Ingested) -> int:
    """Replace ``db.table`` with the rows of ``path``; the rows written."""
    rounded = Observation()
    found = layout(spark, path)
    clean = not found.not_utf8
    if not clean and mode != "quarantine":
        read_csv(spark, path, table)  # raises, with the files' names
    try:
        if not clean:
            raise NotUtf8(path)
        # a clean source takes one pass: whatever is wrong fails it
        rows = replace_table(read_csv(spark, path, table, multiline=not found.lines, rounded=rounded), db, table, keep=1)
    except Exception as departure:
        if mode == "strict":
            raise
        scan = scan_csv(spark, path, table, found=found)
        if mode == "padded":
            surplus = scan.rejects.limit(1).collect()
            if surplus:
                raise departure
        rows = replace_table(scan.rows, db, table, keep=1)
        counts = scan.counts.get
        if not (counts["padded"] or counts["rejected"] or scan.kept_as_text):
            log.warning("%s: loaded at the second attempt (%s)", table, str(departure).splitlines()[0][:200])
        if counts["padded"]:
            out.padded[table] = counts["padded"]
            log.warning("%s: %d short rows padded with nulls", table, counts["padded"])
        if scan.kept_as_text:
            out.kept_as_text[table] = scan.kept_as_text
            log.warning("%s: text kept, as some value has no declared type: %s", table, ", ".join(scan.kept_as_text))
        if counts["rejected"]:
            out.rejected[table] = counts["rejected"]
            ensure_databases(spark, rejects_db(db))
            replace_table(scan.rejects, rejects_db(db), table, keep=1)
            log.warning("%s: %d rows rejected, see %s.%s", table, counts["rejected"], rejects_db(db), table)
        return rows
    for column, n in rounded.get.items():
        if n:
            log.warning("%s.%s: %d values rounded to the column's digits", table, column, n)
    return rows


def ingest_directory(spark: SparkSession, data_dir: str, db: str = RAW_DB,
                     mode: str = "padded", parallelism: int = 4) -> Ingested:
    """Load every CSV source of ``data_dir`` (files, or folders of part files)
    into ``db.<table>``, up to ``parallelism`` tables at a time; returns rows
    per table in name order. Each table switches to its new content only once
    the content is complete (only the newest version is kept). Of several
    sources of one table the last by name is loaded, as if they replaced one
    another in that order. An empty folder logs a warning and loads nothing.

    ``mode`` says what a row or value may do that does not fit. ``strict``:
    nothing, the run fails. ``padded``: a short row gets nulls, and a column with
    a value that its declared type cannot take stays text as a whole; surplus
    fields and bytes that are not UTF-8 fail the run. ``quarantine``: such rows
    go to ``<db>_rejects.<table>`` with file, line and reason, the others load.
    Clean sources are parsed once in every mode. Rounded money values are logged.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode}: one of {', '.join(MODES)}")
    found = list_csv_sources(spark, data_dir)
    if not found:
        log.warning("no CSV file found in %s", data_dir)
        return Ingested()
    sources = dict(found)  # in name order: the last source of a table stays
    for table, path in found:
        if sources[table] != path:
            log.warning("%s is replaced by %s: both are table %s", path, sources[table], table)
    ensure_databases(spark, db)
    out = Ingested()

    def one(src):
        table, path = src
        # a failed load leaves the previous version of the table intact
        return table, _load(spark, path, table, db, mode, out)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(sources)))) as pool:
        out.update(pool.map(one, sources.items()))
    return out

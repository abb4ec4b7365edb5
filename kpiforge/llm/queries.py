"""The driver queries of this package: each applies its operator to the whole
intended table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm import (bpe, brown_lm, byte_bpe, cotraining, fingerprints, language_id, order_minhash,
                          packing, periodic_runs, quality_rules, secret_scan, tool_calls, whitening)
from kpiforge.llm.common import remainder_of_id
from kpiforge.session import cut_lineage


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score(table(spark, sf_dir, "documents"), held_out=remainder_of_id("doc_id", 7) == 2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                       "doc_tokens", "sequence_id", "offset")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_of_id("doc_id", 3) == 1
    found = language_id.identify(docs, language_id.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "log_ppl", "ppl_low", "ppl_high")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_rows")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"), wide=secret_scan.WIDE)
    base = F.filter("spans", lambda s: s["kind"] < secret_scan.KINDS.index("opaque"))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(secret_scan.KINDS[:3])],
                        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
                        secret_scan.spans_text(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"))


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumn("good", F.col("score") >= 0.5)


# the tools that the turns of a conversation stand for: short turns ask, long ones tell
TURN_TOOLS = {"ask": {"text": ("string", True), "words": ("integer", True)},
              "tell": {"text": ("string", True), "title": ("string", True), "words": ("integer", True)}}


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as a call (a long one with its first line as title, if it
    has several) that uses the result of the call two turns before; every
    assistant turn as the result of the call one turn before."""
    turns = table(spark, sf_dir, "conversations")

    def call_id(back: int):
        return F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"),
                        (F.col("turn") - back).cast("string"))

    words = F.size(F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != ""))
    name = F.when(words < 40, "ask").otherwise("tell")
    title = F.when((words >= 40) & F.contains("text", F.lit("\n")), F.split_part("text", F.lit("\n"), F.lit(1)))
    calls = turns.filter("role = 'user'").select(
        "conv_id", "turn", call_id(0).alias("call_id"), name.alias("name"),
        F.to_json(F.struct("text", title.alias("title"), words.alias("words"))).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call_id(2))).otherwise(F.array().cast("array<string>")).alias("uses"))
    results = turns.filter("role = 'assistant'").select("conv_id", "turn", call_id(1).alias("call_id"),
                                                        F.col("text").alias("content"))
    content = F.to_json(F.to_variant_object(F.struct(F.col("text").alias("content"))))
    linked = tool_calls.link(calls, results, TURN_TOOLS)
    others = {"kind": F.lit("turn"), "conv_id": F.col("conv_id"), "turn": F.col("turn"), "name": F.col("role"),
              "cyclic": F.lit(False), "problems": F.array(), "unknown_uses": F.array(), "n_results": F.lit(0), "json": content}
    linked = linked.unionByName(turns.filter("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        *[others.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in linked.schema.fields]))
    return linked.select("kind", "conv_id", "call_id", "turn", "name", "position", "cyclic",
                         F.array_join("problems", ";").alias("problems"),
                         F.array_join("unknown_uses", ";").alias("unknown_uses"),
                         "result_turn", "n_results", "json")


OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, text,
         len(regexp_extract_all(text, '[^ \t-\r]+')) AS words
  FROM conversations),
c AS (
  SELECT conv_id, turn, 'call-' || conv_id || '-' || turn AS call_id, text, words,
         CASE WHEN words < 40 THEN 'ask' ELSE 'tell' END AS name,
         CASE WHEN words >= 40 AND contains(text, chr(10)) THEN split_part(text, chr(10), 1) END AS title,
         CASE WHEN turn >= 2 THEN 'call-' || conv_id || '-' || (turn - 2) END AS uses
  FROM t WHERE role = 'user'),
r AS (
  SELECT conv_id, turn AS result_turn, 'call-' || conv_id || '-' || (turn - 1) AS call_id, text AS content
  FROM t WHERE role = 'assistant'),
p AS (
  SELECT c.*, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
         uses IS NOT NULL AND uses NOT IN (SELECT call_id FROM c) AS lost
  FROM c)
SELECT 'call' AS kind, conv_id, call_id, turn, name, position, FALSE AS cyclic,
       CASE WHEN name = 'tell' AND title IS NULL THEN 'missing title' ELSE '' END AS problems,
       CASE WHEN lost THEN uses ELSE '' END AS unknown_uses,
       result_turn, CASE WHEN result_turn IS NULL THEN 0 ELSE 1 END::BIGINT AS n_results,
       '{"arguments":{"text":' || to_json(text)::VARCHAR
         || CASE WHEN title IS NULL THEN '' ELSE ',"title":' || to_json(title)::VARCHAR END
         || ',"words":' || words || '},"content":' || coalesce(to_json(content)::VARCHAR, 'null')
         || ',"id":"' || call_id || '","name":"' || name || '","position":' || position
         || ',"uses":[' || coalesce('"' || uses || '"', '') || ']}' AS json
FROM p LEFT JOIN r USING (conv_id, call_id)
UNION ALL
SELECT 'orphan', conv_id, call_id, NULL, NULL, NULL, FALSE, '', '', result_turn, 1,
       '{"content":' || to_json(content)::VARCHAR || '}'
FROM r WHERE call_id NOT IN (SELECT call_id FROM c)
UNION ALL
SELECT 'turn', conv_id, NULL, turn, role, NULL, FALSE, '', '', NULL, 0,
       '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || '}'
FROM t WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """One document in ten (crc32 of the id written as decimal, h % 10 = 0) with
    its words from number a on replaced by a repetition of p of them:
    g = floor(h / 10), a = g % n, p = 1 + floor((n - a) / (3 + g % 8)). Documents
    without words or without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", h.alias("h"))
    chosen = (F.col("h") % 10 == 0) & (F.size("words") > 0)
    d = d.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    d = d.withColumn("a", F.when(chosen, (g % n).cast("int")))
    d = d.withColumn("p", F.when(chosen, (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")))
    tail = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return d.select("doc_id", F.when(chosen, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(with_periodic_tails(table(spark, sf_dir, "documents")))

    def better(a, b):
        """The run of greater length / period; of equals the one that starts, then repeats, earlier."""
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (x > y) | ((x == y) & ((a["start"] < b["start"])
                                      | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))

    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)),
                       lambda a, b: F.when(better(b, a), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                               r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    white = cut_lineage(whitening.apply(vectors, model))
    error = whitening.identity_error(white, len(model.scaled))
    rows = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                       F.col("deviation").try_cast("bigint").alias("deviation"), "whitened",
                       F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_brown_lm": op2_brown_lm,
    "op3_packing": op3_packing,
    "op4_language_id": op4_language_id,
    "op5_bpe": op5_bpe,
    "op6_cotraining": op6_cotraining,
    "op7_tool_calls": op7_tool_calls,
    "op8_quality_rules": op8_quality_rules,
    "op9_order_minhash": op9_order_minhash,
    "op10_secret_scan": op10_secret_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {"op7_tool_calls": OP7_SQL}

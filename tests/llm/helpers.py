"""Small fixtures and brute-force versions shared by the operator tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside; rows must pass through them unharmed
CLASHING = ["key", "node", "bucket", "values", "spans", "kept", "score", "head", "before", "block", "label", "_id", "_n"]

VOCABULARY = {
    "en": "the of and to in is was for on that with by this from are be river stone bridge garden winter summer "
          "morning evening letter paper window market street village harbour".split(),
    "fr": "le la les des une dans pour avec sur pas plus fleuve pierre pont jardin hiver matin soir lettre papier "
          "fenêtre marché rue village forêt été château élève".split(),
    "de": "der die das und ist nicht mit ein für auf dem fluß stein brücke garten winter sommer morgen abend brief "
          "papier fenster markt straße dorf hafen schön".split(),
}


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sentence(rng: random.Random, lang: str, n: int) -> str:
    out = [rng.choice(VOCABULARY[lang]) for _ in range(n)]
    for i in range(0, n, 9):
        out[i] = out[i].capitalize()
        out[i - 1] += "."
    return "\n".join(" ".join(out[i:i + 30]) for i in range(0, n, 30))


def corpus(seed: int = 5, n: int = 90) -> list[tuple]:
    """Rows in three languages, with exact and near copies."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "fr", "de")[i % 3]
        text = sentence(rng, lang, rng.randint(60, 200))
        rows.append((i, text, lang, f"s{i % 5}", len(text)))
    for i in range(0, 12, 2):  # a copy with one word changed, and an exact copy
        w = rows[i][1].split(" ")
        w[len(w) // 2] = "changed"
        text = " ".join(w)
        rows.append((n + i, text, rows[i][2], "s1", len(text)))
        rows.append((n + i + 1, rows[i][1], rows[i][2], "s2", rows[i][4]))
    return rows


ODD = [
    (1000, None, "en", "s0", None), (1001, "", None, None, 0), (1002, " \n\t ", "en", "s0", 4),
    (1003, "one", "en", "s1", 3), (1003, "one", "en", "s1", 3), (None, "no id here at all", "en", None, 17),
    (1004, "x" * 30000, "en", "s2", 30000), (1005, "long text " * 4000, "en", "s2", 40000),
    (1006, "😀 é́ Ⅷ ชื่อ   \x1c\x85 <|endoftext|>", None, "s3", 20), (1007, "1234 5678 !!", "fr", "s3", 12),
]


def frame(spark, rows, clashing: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        for c in CLASHING:
            df = df.withColumn(c, F.lit("x"))
    return df


def shingle_set(text: str | None, k: int = 5) -> set:
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0

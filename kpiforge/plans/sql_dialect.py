"""KPI files written for PostgreSQL, read as Spark SQL.

Spark parses, plans and runs the text; this is one pass over its tokens that
puts the few forms which Spark refuses, or takes in another sense without a
word, into forms that keep theirs. What cannot be kept exact is refused.

=================================  ===========================================
in the file                        read as
=================================  ===========================================
``x::numeric``, ``AS numeric``     DECIMAL(28,12): 16 digits before the point
                                   and 12 behind it; more digits before it
                                   raise. Spark's own reading has none behind it
``1.5::numeric``                   the exact literal
``x::int`` and the like            rounded half away from zero, not cut off
``x::timestamp``, ``timestamp ''`` TIMESTAMP_NTZ (no zone, no daylight saving)
``::text ::float8 ...``            the Spark type of the same range
``EXTRACT(EPOCH FROM a - b)``      exact seconds, DECIMAL(20,6)
``DATE_TRUNC(unit, x)``            TIMESTAMP_NTZ in, TIMESTAMP_NTZ out
``AS "name"``, ``t."name"``        a name in back ticks
``ORDER BY x``                     nulls last; with DESC nulls first
=================================  ===========================================

Refused: zoned timestamps, ``DOW`` (counted from 0 there, from 1 here) and
``EXTRACT(EPOCH ...)`` of anything but an interval. Two things stay as Spark has
them: ``/`` between two integers keeps its fraction, and a backslash in a quoted
text escapes. Numbers with too many digits for an operation raise, as the
session runs with ANSI arithmetic and without precision loss.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession

EPOCH, TRUNC = "kpiforge_epoch", "kpiforge_date_trunc"

# session functions in plain SQL; Spark inlines them into the plan
FUNCTIONS = (
    f"CREATE OR REPLACE TEMPORARY FUNCTION {EPOCH}(x INTERVAL DAY TO SECOND) RETURNS DECIMAL(20,6) RETURN "
    "extract(DAY FROM x) * 86400 + extract(HOUR FROM x) * 3600 + extract(MINUTE FROM x) * 60 + extract(SECOND FROM x)",
    f"CREATE OR REPLACE TEMPORARY FUNCTION {TRUNC}(unit STRING, x TIMESTAMP_NTZ) RETURNS TIMESTAMP_NTZ "
    "RETURN CAST(date_trunc(unit, x) AS TIMESTAMP_NTZ)",
)

# fixed values: type names and their Spark types
TYPES = {
    "numeric": "DECIMAL(28,12)", "decimal": "DECIMAL(28,12)",
    "timestamp": "TIMESTAMP_NTZ", "timestamp without time zone": "TIMESTAMP_NTZ",
    "text": "STRING", "varchar": "STRING", "character varying": "STRING",
    "float": "DOUBLE", "float8": "DOUBLE", "double precision": "DOUBLE", "float4": "FLOAT",
    "bool": "BOOLEAN",
}
INTEGERS = {"smallint": "SMALLINT", "int2": "SMALLINT", "int": "INT", "integer": "INT", "int4": "INT",
            "bigint": "BIGINT", "int8": "BIGINT"}
REFUSED_TYPES = {"timestamptz", "timestamp with time zone", "interval", "money"}
_WHOLE = "DECIMAL(38,0)"  # a cast to it rounds half away from zero

_TOKEN = re.compile(r"""
    (?P<gap>\s+|--[^\n]*|/\*.*?\*/)
  | (?P<text>'(?:[^'\\]|\\.|'')*')
  | (?P<quoted>"(?:[^"\\]|\\.)*"|`[^`]*`)
  | (?P<number>(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?(?!\w))
  | (?P<word>\w+)
  | (?P<sign>::|.)
""", re.S | re.X)

# words after which an ORDER BY list is over
_AFTER_ORDER = {"limit", "offset", "fetch", "rows", "range", "groups", "union", "except", "intersect"}


class UnsupportedSql(ValueError):
    """A form whose meaning Spark SQL would change."""


class Token(str):
    """A token's text with its kind."""
    kind: str

    @classmethod
    def all_of(cls, sql: str) -> list[Token]:
        out = []
        for m in _TOKEN.finditer(sql):
            t = cls(m[0])
            t.kind = m.lastgroup
            out.append(t)
        return out


def to_spark(sql: str, table: Callable[[str], str] | None = None) -> str:
    """``sql`` as Spark SQL. ``table`` gives the name to read in place of
    ``raw.<name>``."""
    full = Token.all_of(sql)
    at = [i for i, t in enumerate(full) if t.kind != "gap"]
    tokens = [full[i] for i in at]
    gaps = ["".join(full[a + 1:b]) for a, b in zip([-1, *at], [*at, len(full)])]  # before each token, and the last
    out: list[str] = []
    opened: list[list] = []     # per open bracket: the word before it, what follows its end, the list around it
    order: dict | None = None  # the ORDER BY list being read

    def low(i: int) -> str:
        return tokens[i].lower() if 0 <= i < len(tokens) else ""

    def put(i: int, text: str) -> None:
        out.append(gaps[i] + text)

    def open_bracket(before: str) -> None:
        nonlocal order
        opened.append([before, "", order])
        order = None

    def end_item() -> None:
        if order and order["open"] and not order["nulls"]:
            out.append(" NULLS FIRST" if order["desc"] else " NULLS LAST")

    def type_at(i: int) -> tuple[str, int]:
        """(name, tokens) of the type at ``i``, in the words it has there."""
        for n in (4, 2, 1):
            name = " ".join(low(i + k) for k in range(n))
            if name in TYPES or name in INTEGERS or name in REFUSED_TYPES:
                return name, n
        return low(i), 1

    i = 0
    while i < len(tokens):
        word, t = low(i), tokens[i]
        cast = t == "::"
        if cast or (word == "as" and opened and opened[-1][0] in ("cast", "try_cast")):
            name, n = type_at(i + 1)
            if name in REFUSED_TYPES or (name == "timestamp" and low(i + 1 + n) == "("):
                raise UnsupportedSql(f"cast to {name}: not kept by Spark")
            sized = low(i + 1 + n) == "("
            if cast and name in ("numeric", "decimal") and not sized and i and tokens[i - 1].kind == "number":
                out.append("BD")
                i += 1 + n
                continue
            if name in INTEGERS:
                put(i, f"{t}{'' if cast else ' '}{_WHOLE}")
                if cast:
                    out.append(f"::{INTEGERS[name]}")
                else:
                    opened[-1][1] = f"::{INTEGERS[name]}"
                i += 1 + n
                continue
            if name in TYPES and not sized:
                put(i, f"{t}{'' if cast else ' '}{TYPES[name]}")
                i += 1 + n
                continue
        if word == "extract" and low(i + 1) == "(":
            field = low(i + 2)
            if field == "dow":
                raise UnsupportedSql("EXTRACT(DOW ...) counts from 1 in Spark; use ISODOW")
            if field == "epoch" and low(i + 3) == "from":
                put(i, EPOCH + "(")
                open_bracket(word)
                i += 4
                continue
            if field == "isodow":
                put(i, "extract(DOW_ISO")
                open_bracket(word)
                i += 3
                continue
        if word == "date_part" and [low(i + k) for k in (1, 2, 3)] == ["(", "'epoch'", ","]:
            put(i, EPOCH + "(")
            open_bracket(word)
            i += 4
            continue
        if word == "date_trunc" and low(i + 1) == "(":
            put(i, TRUNC)
        elif word == "timestamp" and i + 1 < len(tokens) and tokens[i + 1].kind == "text":
            put(i, "TIMESTAMP_NTZ")
        elif t.kind == "quoted" and t[0] == '"' and (low(i - 1) in ("as", ".")):
            put(i, "`" + t[1:-1] + "`")
        elif table and word.strip("`") == "raw" and low(i - 1) != "." and low(i + 1) == "." and i + 2 < len(tokens):
            put(i, table(tokens[i + 2].strip('`"')))
            i += 2
        elif t == "(":
            put(i, t)
            open_bracket(low(i - 1))
        elif t == ")" and opened:
            end_item()
            _, after, order = opened.pop()
            put(i, t + after)
        else:
            if word == "by" and low(i - 1) == "order":
                within = [low(i - k) for k in (2, 3, 4)] == ["(", "group", "within"]
                order = None if within else {"open": False, "desc": False, "nulls": False}
            elif order and (t == "," or t == ";" or word in _AFTER_ORDER):
                end_item()
                order = {"open": False, "desc": False, "nulls": False} if t == "," else None
            elif order:
                order["open"] = True
                order["desc"] |= word == "desc"
                order["nulls"] |= word == "nulls"
            put(i, t)
        if order and t == ")":
            order["open"] = True
        i += 1
    end_item()
    return "".join(out) + gaps[-1]


def define_functions(spark: SparkSession) -> None:
    """The session functions that ``to_spark`` may name, once per session."""
    for name, text in zip((EPOCH, TRUNC), FUNCTIONS):
        if not spark.catalog.functionExists(name):
            spark.sql(text)

"""Presentation helpers for second-level metrics (labels shown on cards)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiforge.functions.exprs import _c

# A cased letter: upper, lower or title case. Python's str.title() starts a new
# word after any character that is not one of these (digits, apostrophes ...).
_CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"


def python_title(x) -> Column:
    """Python ``str.title()``: a cased letter is upper-cased when the character
    before it is not a cased letter, and lower-cased otherwise ("2nd" -> "2Nd",
    unlike Spark's initcap). The four Unicode title-case digraphs (U+01C4..)
    come out upper-cased where Python title-cases them."""
    chars = F.split(_c(x), "")
    out = F.transform(
        chars,
        lambda ch, i: F.when(
            (i == 0) | ~F.regexp_like(F.get(chars, i - 1), F.lit(_CASED)), F.upper(ch)
        ).otherwise(F.lower(ch)))
    return F.when(_c(x).isNull(), F.lit(None)).otherwise(F.array_join(out, ""))


def category_label(x="categoria") -> Column:
    """Category code as shown on the cards: underscores to spaces, title case."""
    return python_title(F.translate(_c(x), "_", " "))


def month_label(x="mes") -> Column:
    """``%b/%Y`` month label, e.g. ``Jan/2018``."""
    return F.date_format(_c(x), "MMM/yyyy")


def number_label(x, decimals: int, prefix: str = "", suffix: str = "") -> Column:
    """``f"{prefix}{x:.Nf}{suffix}"``: rounding half-even on the exact binary
    value (what format_number does; format_string rounds half-up on the
    shortest decimal form), without grouping separators."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.format_number(_c(x), decimals), ",", ""), F.lit(suffix))


def count_label(x) -> Column:
    """``f"{x:,}"`` of a whole number."""
    return F.format_number(_c(x), 0)


def pct_label(x, decimals: int = 1) -> Column:
    """``f"{x:.1f}%"``."""
    return number_label(x, decimals, suffix="%")

"""Types of text columns, decided for whole columns.

A value's kind is a bit; the kinds of a column are the bits of its values
combined, so partial results merge in any order and one aggregate over the
table, a row per task, decides every column. A column is cast only if all of its
values can be: one that cannot leaves the column's text as it is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER, DECIMAL, TIMESTAMP, BOOLEAN, TEXT = 1, 2, 4, 8, 16

# kinds of all values of a column -> its type; every other combination is text
TYPE_OF_KINDS = {
    INTEGER: T.LongType(), DECIMAL: T.DoubleType(), INTEGER | DECIMAL: T.DoubleType(),
    TIMESTAMP: T.TimestampNTZType(), BOOLEAN: T.BooleanType(),
}

# A number that would not come back as it was written is text: leading zeros
# (codes), a leading plus (phone numbers), more digits than a BIGINT holds.
_CODE = r"^[+-]?0\d|^\+"
_INTEGER = r"^-?\d{1,18}$"
_LONG_INTEGER = r"^-?\d{19,}$"
_DECIMAL = r"^-?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^-?[iI]nf(inity)?$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"


def _name(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def kind(value: Column) -> Column:
    """The kind of a text value; 0 for null. Blanks around a number don't count."""
    v = F.trim(value)
    return (F.when(value.isNull(), 0)
            .when(v.rlike(_CODE) | v.rlike(_LONG_INTEGER), TEXT)
            .when(v.rlike(_INTEGER), INTEGER)
            .when(v.rlike(_DECIMAL), DECIMAL)
            .when(v.rlike(_TIMESTAMP) & v.try_cast("timestamp_ntz").isNotNull(), TIMESTAMP)
            .when(F.lower(v).isin("true", "false"), BOOLEAN)
            .otherwise(TEXT))


def profile(df: DataFrame, infer: list[str], declared: Mapping[str, T.DataType]) -> dict[str, int]:
    """One pass over text columns: the combined kinds of those in ``infer``, and
    how many values of those in ``declared`` cannot be cast to their type."""
    aggs = [F.coalesce(F.bit_or(kind(_name(c))), F.lit(0)).cast("bigint").alias(f"k{i}")
            for i, c in enumerate(infer)]
    aggs += [F.count_if(_name(c).isNotNull() & _name(c).try_cast(t).isNull()).alias(f"d{i}")
             for i, (c, t) in enumerate(declared.items())]
    if not aggs:
        return {}
    row = df.agg(*aggs).first()
    return dict(zip([*infer, *declared], row))


def inferred_types(df: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    """Type of each text column by its values; columns of nulls stay text."""
    kinds = profile(df, columns, {})
    return {c: TYPE_OF_KINDS.get(kinds[c], T.StringType()) for c in columns}


def castable(df: DataFrame, declared: Mapping[str, T.DataType]) -> dict[str, T.DataType]:
    """``declared`` with text in place of every type that some value of the
    column cannot take."""
    bad = profile(df, [], declared)
    return {c: T.StringType() if bad[c] else t for c, t in declared.items()}


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """``df`` with the named text columns cast; numbers may have blanks around."""
    def one(c: str) -> Column:
        t = types.get(c, T.StringType())
        return _name(c) if isinstance(t, T.StringType) else F.trim(_name(c)).cast(t).alias(c)
    return df.select(*[one(c) for c in df.columns])


def with_numeric_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every text column whose values are all numbers as DOUBLE, but for those
    in ``keep``; the others stay as they are."""
    text = {c: T.DoubleType() for c, t in df.dtypes if t == "string" and c not in keep}
    types = castable(df, text)
    return df.select(*[_name(c).cast(types[c]).alias(c) if c in types else _name(c) for c in df.columns])

"""Typed reads of loosely typed source columns. All take a frame and a column name, because the
right conversion depends on the type the file delivered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what a plain decimal number is spelled with. The cast alone would also read type
# suffixes (5d), hexadecimal floats, NaN and Infinity.
NUMBER_CHARACTERS = "0123456789+-.eE \t\r\n"

UNKNOWN_ID = "UNK"
UNKNOWN_NAME = "Unknown"

_FLOATING = (T.FloatType, T.DoubleType, T.DecimalType)


def whole_key(df: DataFrame, name: str) -> Column:
    """A join key as long. Floats round half-even, text must be a whole number; a float that is no number
    or too large for a key is null."""
    kind = df.schema[name].dataType
    if isinstance(kind, _FLOATING):
        return _rounded(F.col(name).cast("double"))
    return F.col(name).cast("long")


def numeric_key_or_null(df: DataFrame, name: str) -> Column:
    """Like :func:`whole_key`, but text that is no number becomes null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return _rounded(number_or_null(df, name))
    return whole_key(df, name)


def _rounded(number: Column) -> Column:
    whole = F.rint(number)
    return F.when(~F.isnan(whole), whole.try_cast("long"))


def number_or_null(df: DataFrame, name: str) -> Column:
    """A double, or null where text is not a plain number (``5d`` and ``1_000`` are not)."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        only_number_characters = F.translate(col, NUMBER_CHARACTERS, "") == ""
        return F.when(only_number_characters, col.try_cast("double"))
    return col.cast("double")


def date_or_null(df: DataFrame, name: str) -> Column:
    """A date, or null where text is not a full ISO date."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(F.col(name), "yyyy-MM-dd")
    return F.col(name).cast("date")


def typed(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """A column brought to another type by the conversion of its kind; what cannot be read is null, but a whole
    number that a key is spelled with must be one."""
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return whole_key(df, name).cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number_or_null(df, name).cast(kind)
    if isinstance(kind, T.DateType):
        return date_or_null(df, name)
    if isinstance(kind, T.StringType):
        return F.col(name).cast(kind)
    return F.col(name).try_cast(kind)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def id_or_unknown(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(UNKNOWN_ID))


def name_or_unknown(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(UNKNOWN_NAME))

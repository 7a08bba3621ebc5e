"""Text fields to numbers and codes. Bad text gives null or 0, never an error."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType

_LONG_RANGE = float(2**63)

# TCP control bits by the letter flow exporters print.
TCP_FLAG_BITS = {"F": 1, "S": 2, "R": 4, "P": 8, "A": 16, "U": 32, "E": 64, "C": 128}

# IP protocol numbers of the two named transports.
TCP, UDP = 6, 17


def number_from_text(text: Column, dtype: DataType) -> Column:
    """Typed number from CSV text; a fraction is cut off for whole types.

    The plain cast answers almost every row, the pattern runs for the others only.
    """
    if isinstance(dtype, DoubleType):
        return text.try_cast("double")
    whole = F.regexp_extract(F.trim(text), r"^([+-]?[0-9]+)[.][0-9]*$", 1)
    value = F.coalesce(text.try_cast("bigint"), whole.try_cast("bigint"))
    return value.try_cast("int") if isinstance(dtype, IntegerType) else value


def floor_long(value: Column) -> Column:
    """Whole part of a double as a long; null when it does not fit."""
    return F.when(F.abs(value) < F.lit(_LONG_RANGE), F.floor(value))


def coerce_number(value: Column) -> Column:
    """Whole number from any text: fraction cut off, blank or unreadable is 0."""
    return F.coalesce(value.cast("string").try_cast("double").try_cast("bigint"), F.lit(0))


def duration_to_ms(seconds: Column) -> Column:
    """Seconds as text or number to whole milliseconds, exact to the microsecond."""
    return F.floor(seconds.cast("string").try_cast("decimal(24,6)") * F.lit(1000)).cast("bigint")


def protocol_number(text: Column) -> Column:
    """Protocol name or number to its number; blank or unknown is 0."""
    name = F.upper(text.cast("string"))
    return (
        F.when(F.contains(name, F.lit("TCP")), TCP)
        .when(F.contains(name, F.lit("UDP")), UDP)
        .otherwise(coerce_number(text).try_cast("int"))
    )


# The bits that an int column holds without its sign.
_INT_BITS = 0x7FFFFFFF


def decode_tcp_flags(text: Column) -> Column:
    """Flag text (letters such as ``.AP.SF``, ``0x1b`` or a decimal) to its bit mask, cut to
    31 bits."""
    flags = F.upper(F.trim(text.cast("string")))
    letters = sum(
        (F.when(F.contains(flags, F.lit(letter)), bit).otherwise(0)
         for letter, bit in TCP_FLAG_BITS.items()),
        F.lit(0),
    )
    return (
        F.when(flags.rlike("^0X[0-9A-F]{1,8}$"),
               F.conv(F.substring(flags, 3, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(_INT_BITS))
               .cast("int"))
        .when(flags.rlike("^[0-9]+$"), flags.try_cast("bigint").bitwiseAND(F.lit(_INT_BITS)).cast("int"))
        .otherwise(letters)
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in which no column (of ``columns``, if given) is null or NaN.

    One condition per column, not one over all of them: the optimizer rewrites
    each condition once per computed column it mentions, which for a single wide
    condition over n computed columns would be 2^n rewrites.
    """
    kept = df.columns if columns is None else columns
    conditions = []
    for field in df.select(*[f"`{c}`" for c in kept]).schema.fields:
        value = F.col(f"`{field.name}`")
        conditions.append(value.isNotNull())
        if isinstance(field.dataType, DoubleType | FloatType):
            conditions.append(~F.isnan(value))
    return df.filter(reduce(and_, conditions)) if conditions else df

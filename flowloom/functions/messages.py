"""JSON messages: decode, parse, split off what cannot be read, encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from flowloom.functions.fields import floor_long
from flowloom.schemas import ALERT_COLUMNS, LEGACY_MESSAGE_DDL, MESSAGE, MESSAGE_WIRE


def decode_value(messages: DataFrame) -> DataFrame:
    """Message bytes to text, in column ``json``; other columns stay."""
    others = [c for c in messages.columns if c != "value"]
    return messages.select(F.col("value").cast("string").alias("json"), *others)


def is_json_object(text: Column) -> Column:
    """True only for text that is one complete JSON object."""
    return F.json_object_keys(text).isNotNull()


def _typed_fields(parsed: str) -> list[Column]:
    columns = []
    for field, wire in zip(MESSAGE.fields, MESSAGE_WIRE.fields, strict=True):
        value = F.col(f"{parsed}.{field.name}")
        if isinstance(field.dataType, LongType) and isinstance(wire.dataType, DoubleType):
            value = floor_long(value)
        columns.append(value.alias(field.name))
    return columns


def parse_flow_json(texts: DataFrame, column: str = "json") -> DataFrame:
    """Text column to the 24 typed message fields; other columns stay.

    An unreadable field is null, an unreadable document a row of nulls.
    """
    others = [c for c in texts.columns if c != column]
    parsed = texts.select(F.from_json(column, MESSAGE_WIRE).alias("_parsed"), *others)
    return parsed.select(*_typed_fields("_parsed"), *others)


def parse_legacy_json(texts: DataFrame, column: str = "json") -> DataFrame:
    """Text column to the five fields of the earlier message format."""
    others = [c for c in texts.columns if c != column]
    parsed = texts.select(F.from_json(column, LEGACY_MESSAGE_DDL).alias("_parsed"), *others)
    return parsed.select("_parsed.*", *others)


def flag_readable(texts: DataFrame, column: str = "json") -> DataFrame:
    """Texts with a true or false ``readable`` column."""
    return texts.withColumn("readable", is_json_object(F.col(column)))


def split_malformed(texts: DataFrame, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """(readable, rejected) documents. A readable document is a JSON object; a bad
    field inside one does not reject it. Texts already flagged are not read again."""
    flagged = texts if "readable" in texts.columns else flag_readable(texts, column)
    keep = [c for c in texts.columns if c != "readable"]
    return (
        flagged.filter(F.col("readable")).select(*keep),
        flagged.filter(~F.col("readable")).select(*keep),
    )


def encode_alert(scored: DataFrame, *keep: str) -> DataFrame:
    """The ten alert fields as one JSON ``value``, beside the columns to keep."""
    return scored.select(*keep, F.to_json(F.struct(*ALERT_COLUMNS)).alias("value"))


def encode_row(rows: DataFrame, source_file: Column | None = None) -> DataFrame:
    """All columns as one JSON ``value``, with the originating file if given."""
    fields = [F.col(f"`{c}`") for c in rows.columns]
    if source_file is not None:
        fields.append(source_file.alias("source_file"))
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))

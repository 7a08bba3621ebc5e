"""Canonical flows to the rows a model trains on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from flowloom.functions.fields import drop_incomplete, number_from_text
from flowloom.functions.hashing import percent_bucket
from flowloom.functions.labels import binary_label
from flowloom.schemas import CANONICAL_19, FEATURE_GROUPS, RAW_41

IDENTIFIERS = ["flow_id", "src_ip", "dst_ip", "src_ip_int", "dst_ip_int", "flow_start_time"]
# Fixed value: the target column, as models saved by earlier jobs name it.
TARGET = "Label_Binaire"


def drop_identifiers(flows: DataFrame) -> DataFrame:
    return flows.drop(*IDENTIFIERS)


def drop_any_null(df: DataFrame) -> DataFrame:
    return drop_incomplete(df)


def add_target(flows: DataFrame) -> DataFrame:
    """Target from the attack type, which then leaves the table."""
    return flows.withColumn(TARGET, binary_label(F.col("attack_type"))).drop("attack_type")


def select_features(df: DataFrame, features: Sequence[str] = CANONICAL_19) -> DataFrame:
    """Features in their pinned order, then the target if there is one."""
    target = [TARGET] if TARGET in df.columns else []
    return df.select(*features, *target)


def training_set(flows: DataFrame) -> DataFrame:
    return (
        flows.transform(drop_identifiers)
        .transform(drop_any_null)
        .transform(add_target)
        .transform(select_features)
    )


def training_set_with_id(flows: DataFrame) -> DataFrame:
    """The same rows with ``flow_id`` in front, for splits and samples by id."""
    checked = [c for c in flows.columns if c not in IDENTIFIERS]
    return drop_incomplete(flows, checked).select(
        "flow_id", *CANONICAL_19, binary_label(F.col("attack_type")).alias(TARGET)
    )


def raw_features(raw: DataFrame, *keep: str | Column) -> DataFrame:
    """The 41 raw measures as doubles, in the wide model's order."""
    return raw.select(*keep, *[number_from_text(F.col(c), DoubleType()).alias(c) for c in RAW_41])


def feature_group(df: DataFrame, group: str, *keep: str) -> DataFrame:
    return df.select(*keep, *FEATURE_GROUPS[group])


def split_train_test(
    df: DataFrame, keys: Sequence[str] = ("flow_id",), train_percent: int = 80, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Disjoint, exhaustive split by key hash: a row's side never depends on how
    the data is partitioned. No shuffle."""
    bucket = percent_bucket([F.col(k) for k in keys], seed)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)

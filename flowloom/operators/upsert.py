"""Primary-key write semantics: the last write per key wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed_upsert(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``newest_by`` (end it with an id to break ties).

    Spark applies the rank limit before the shuffle as well, so each map task sends
    at most one row per key, however many copies a key has.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in newest_by])
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )


def merge_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """``existing``, unique by key, with ``incoming`` written over it."""
    latest = keyed_upsert(incoming, keys, newest_by)
    written = latest.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return existing.join(written, same, "left_anti").unionByName(latest)

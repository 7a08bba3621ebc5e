"""Features for a stream of flows: an interval join of two streams with bounded state."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.schemas import FIVE_TUPLE

# Microseconds that no record's time is in reach of.
_NEVER = -(1 << 62)


def _nearest(reach: int) -> Column:
    """Function of the times of flows and the ascending times of records: for each flow the
    position of the nearest record in reach, the earlier of two, the last of those at one time."""

    def places(flows: np.ndarray, records: np.ndarray) -> np.ndarray:
        if not len(records):
            return np.full(len(flows), None)
        last = np.searchsorted(records, records, "right") - 1
        after = np.searchsorted(records, flows, "right")
        before, after = np.maximum(after - 1, 0), last[np.minimum(after, len(records) - 1)]
        back, ahead = np.abs(flows - records[before]), np.abs(records[after] - flows)
        place = np.where(back <= ahead, last[before], after)
        return np.where(np.minimum(back, ahead) <= reach, place, None)

    def nearest(flows: pd.Series, records: pd.Series) -> pd.Series:
        return pd.Series([places(f, r) for f, r in zip(flows, records, strict=True)], dtype=object)

    # Not deterministic for the optimizer only, which else moves it into the lambda that uses it.
    return F.pandas_udf(nearest, "array<int>").asNondeterministic()


def enrich_stream(
    flows: DataFrame, features: DataFrame, row_key: Sequence[str] = ("flow_id",),
    time: str = "flow_start_time", within: int = 60, delay: str = "10 minutes",
) -> DataFrame:
    """Streamed flows with the features of their 5-tuple that are nearest in time, at most
    ``within`` seconds away (of two equally near the earlier); flows without stay.

    Both sides carry ``time`` and may be late by ``delay``. Rows meet in bins of a 5-tuple, as long
    as the range: a flow in its own, a record in its own and, as the last before or the first
    after, in the two beside it. So work and state grow with the rows, not with the pairs in range.
    A bin is out once both watermarks have passed the range of its flows, when no feature in time
    can come any more; then its state goes, so state holds what ``delay`` and ``within`` span,
    whatever the stream's age. Later rows than that are dropped. Rows that agree in ``time`` and
    ``row_key`` are one flow, so a message that is delivered twice gives one row. The output order
    of columns is that of the flows, then the features. On tables instead of streams the result is
    the same, of all rows.
    """
    measures = [c for c in features.columns if c not in (*FIVE_TUPLE, time)]
    seconds = max(int(within), 1)
    keys, width = (time, *row_key), F.lit(seconds * 1_000_000)
    at = F.unix_micros(F.col(time))
    own = F.floor(at / width)

    def until(number: Column) -> Column:
        """When no record in reach of a bin's flows can come any more."""
        return F.timestamp_micros((number + 2) * width)

    found = F.struct(*measures)
    left = flows.select(
        *FIVE_TUPLE, until(own).alias("_until"), F.struct(*flows.columns).alias("_flow"),
    ).withWatermark("_until", f"{delay} {2 * seconds} seconds")
    within_bin = set(FIVE_TUPLE) <= set(row_key)
    if not within_bin:
        named = [f"_key_{i}" for i in range(len(keys))]
        left = left.withColumns({n: F.col("_flow")[c] for n, c in zip(named, keys, strict=True)})
        left = left.dropDuplicates(["_until", *named]).drop(*named)
    right = features.filter(F.col(time).isNotNull()).select(
        *FIVE_TUPLE, at.alias("_at"), own.alias("_own"), found.alias("_measures"),
        F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_step"),
    ).select(
        *FIVE_TUPLE, until(F.col("_own") + F.col("_step")).alias("_until"), "_step",
        F.struct("_at", "_measures").alias("_record"),
    ).withWatermark("_until", f"{delay} {3 * seconds} seconds")

    def edge(step: int, sign: int) -> Column:
        """The last record of the bin before, or the first of the bin after; of several at that
        time the one with the greatest features."""
        best = F.max(F.when(F.col("_step") == step, F.struct(
            (F.col("_record._at") * sign).alias("_at"), F.col("_record._measures").alias("_measures")
        )))
        return F.when(best.isNotNull(), F.struct(
            (best["_at"] * sign).alias("_at"), best["_measures"].alias("_measures")
        ))

    bins = left.unionByName(right, allowMissingColumns=True).groupBy("_until", *FIVE_TUPLE).agg(
        F.collect_list("_flow").alias("_flows"),
        F.collect_list(F.when(F.col("_step") == 0, F.col("_record"))).alias("_inside"),
        edge(1, 1).alias("_before"), edge(-1, -1).alias("_after"),
    ).filter(F.size("_flows") > 0)
    if within_bin:
        bins = _once_each(bins, keys)
    ranked = bins.withColumn("_records", F.array_sort(
        F.concat("_inside", F.array_compact(F.array("_before", "_after")))
    ))
    near = ranked.select("_flows", "_records", _nearest(int(within) * 1_000_000)(
        F.transform("_flows", lambda f: F.coalesce(F.unix_micros(f[time]), F.lit(_NEVER))),
        F.transform("_records", lambda r: r["_at"]),
    ).alias("_near"))
    rows = near.select(F.explode(F.transform("_flows", lambda f, i: F.struct(
        f.alias("flow"), F.get("_records", F.get("_near", i))["_measures"].alias("found")
    ))).alias("_row"))
    return rows.select(
        *[F.col(f"_row.flow.{c}").alias(c) for c in flows.columns],
        *[F.col(f"_row.found.{c}").alias(c) for c in measures],
    )


def _once_each(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One of the ``_flows`` for each value of the keys."""
    ranked = bins.withColumn("_ranked", F.array_sort(F.transform("_flows", lambda f, i: F.struct(
        F.struct(*[f[c].alias(f"key_{n}") for n, c in enumerate(keys)]).alias("key"), i.alias("at")
    ))))
    firsts = F.filter(
        "_ranked",
        lambda r, i: ~r["key"].eqNullSafe(F.get("_ranked", i - 1)["key"]),
    )
    return ranked.withColumn(
        "_flows", F.transform(firsts, lambda r: F.get("_flows", r["at"]))
    ).drop("_ranked")

"""Flow records joined with extractor features, without hot-key stragglers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.operators.upsert import keyed_upsert
from flowloom.schemas import FIVE_TUPLE

# A key is hot when it holds more than one row in SHARE of the left side, so there
# are fewer than SHARE hot keys whatever the data: their list is safe to broadcast.
HOT_SHARE = 1000
MOST_SHARE = 10_000
KEY_CELLS = 1 << 16
SALTS = 64


def key_cell(keys: Sequence[Column]) -> Column:
    """One of KEY_CELLS cells, by the hash of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_CELLS))


def heavy_cells(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> list[int]:
    """Cells of keys that hold more than 1/share of all rows: fewer than ``share`` numbers.

    One pass; rows of a cell combine before the shuffle.
    """
    if not 0 < share <= MOST_SHARE:
        raise ValueError(f"share must be between 1 and {MOST_SHARE}")
    cells = df.groupBy(key_cell([F.col(k) for k in keys]).alias("cell")).count().collect()
    total = sum(r["count"] for r in cells)
    return sorted(r["cell"] for r in cells if r["count"] * share > total)


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys with more than 1/share of all rows: fewer than ``share`` of them.

    Only rows in a cell that is heavy itself are counted by key.
    """
    heavy = heavy_cells(df, keys, share)
    total = df.count() if heavy else 0
    within = key_cell([F.col(k) for k in keys]).isin(heavy)
    counts = df.filter(within).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") * share > total).drop("_n")


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], salts: int = SALTS,
    share: int = HOT_SHARE, condition: Column | None = None,
) -> DataFrame:
    """``left`` left-joined with ``right`` on null-safe equality of ``keys``.

    ``right`` must hold one row per key at most, or one per key that meets ``condition``, which
    names its columns with the prefix ``_right_``. The left side is read twice, for its heavy
    cells and for the join. Rows of heavy cells are spread over ``salts`` tasks; only the right
    rows of these cells, a share of KEY_CELLS each, are copied to each.
    """
    heavy = heavy_cells(left, keys, share)

    def is_heavy(df: DataFrame) -> Column:
        # The left side's types, as the hash of a number depends on its width.
        return key_cell([F.col(k).cast(left.schema[k].dataType) for k in keys]).isin(heavy)

    if heavy:
        # The salt repeats when a task is retried, and the partition number in it spreads
        # even identical rows.
        salt = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.lit(salts))
        zero, last = F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")
        copies = F.when(is_heavy(right), F.sequence(zero, last)).otherwise(F.array(zero))
        left = left.withColumn("_salt", F.when(is_heavy(left), salt).otherwise(zero))
        right = right.withColumn("_salt", F.explode(copies))
    matched = _same([*keys, "_salt"] if heavy else keys, "_right_")
    if condition is not None:
        matched = matched & condition
    joined = left.join(_prefixed(right, "_right_"), matched, "left")
    extra = [
        F.col("_right_" + c).alias(c) for c in right.columns if c not in (*keys, "_salt")
    ]
    return joined.select(*[c for c in left.columns if c != "_salt"], *extra)


def enrich_flows_with_features(
    flows: DataFrame,
    features: DataFrame,
    time: str = "flow_start_time",
    slice: str = "60 seconds",
    latest_by: Sequence[str] | None = None,
) -> DataFrame:
    """Flows with the extractor's features for their 5-tuple; flows without stay.

    When both sides carry ``time``, they must fall in the same slice, as both
    assemblers cut flows on it. One feature record, the latest, counts per key.
    """
    timed = time in flows.columns and time in features.columns
    keys = [*FIVE_TUPLE, "_slice"] if timed else list(FIVE_TUPLE)
    if timed:
        cut = F.window(time, slice).start
        flows = flows.withColumn("_slice", cut)
        features = features.withColumn("_slice", cut)
    measures = [c for c in features.columns if c not in (*keys, time)]
    order = list(latest_by or [*([time] if time in features.columns else []), *measures])
    unique = keyed_upsert(features, keys, order).select(*keys, *measures)
    return salted_left_join(flows, unique, keys).drop("_slice")


# Feature records of a key are put in order within chunks of so many tolerances, with the
# records next to a chunk's ends copied to the neighbour, so that a hot key is split by time.
CHUNK = 60


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def nearest_spans(
    features: DataFrame, time: str = "flow_start_time", within: int = 60
) -> DataFrame:
    """Feature records with ``_from`` and ``_to``, the times (microseconds, both included) whose
    nearest record of the 5-tuple they are, at most ``within`` seconds away.

    Spans of a 5-tuple do not overlap; the middle between two records goes to the earlier. One
    record counts per 5-tuple and time, and those without a time do not.
    """
    measures = [c for c in features.columns if c not in (*FIVE_TUPLE, time)]
    dated = features.filter(F.col(time).isNotNull())
    unique = keyed_upsert(dated, [*FIVE_TUPLE, time], measures) if measures else dated.distinct()
    reach = within * 1_000_000
    chunk = CHUNK * reach

    def chunk_of(at: Column) -> Column:
        return F.floor(at / chunk)

    placed = unique.withColumn("_at", _micros(time)).withColumn("_chunk", F.explode(
        F.array_distinct(F.array(*[chunk_of(F.col("_at") + d) for d in (-2 * reach, 0, 2 * reach)]))
    ))
    order = Window.partitionBy(*FIVE_TUPLE, "_chunk").orderBy("_at")
    before, after = F.lag("_at").over(order), F.lead("_at").over(order)
    middle_before = F.floor((before + F.col("_at")) / 2) + 1
    return placed.withColumns({
        # greatest() and least() skip the null of a record without a neighbour.
        "_from": F.greatest(F.col("_at") - reach, middle_before),
        "_to": F.least(F.col("_at") + reach, F.floor((F.col("_at") + after) / 2)),
    }).filter(F.col("_chunk") == chunk_of(F.col("_at"))).drop("_chunk", "_at")


def enrich_flows_in_range(
    flows: DataFrame, features: DataFrame, time: str = "flow_start_time", within: int = 60
) -> DataFrame:
    """Flows with the features of their 5-tuple that are nearest in time, at most ``within``
    seconds away; of two equally near the earlier. Flows without stay.

    A band join by equality: spans lie in bins of ``within`` seconds, three at most, and a flow
    looks into its own bin, where one span at most holds its time.
    """
    reach = within * 1_000_000
    spans = nearest_spans(features, time, within)
    measures = [c for c in features.columns if c not in (*FIVE_TUPLE, time)]
    binned = spans.withColumn("_bin", F.explode(F.sequence(
        F.floor(F.col("_from") / reach), F.floor(F.col("_to") / reach)
    ))).select(*FIVE_TUPLE, "_bin", "_from", "_to", *measures)
    timed = flows.withColumn("_at", _micros(time)).withColumn("_bin", F.floor(F.col("_at") / reach))
    joined = salted_left_join(
        timed, binned, [*FIVE_TUPLE, "_bin"],
        condition=F.col("_at").between(F.col("_right__from"), F.col("_right__to")),
    )
    return joined.select(*flows.columns, *measures)

"""Samples and batch limits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.hashing import HASH_SPACE, hash_rank

# Documented bound on the labelled rows a detector is trained on.
TRAINING_CAP = 80_000

# Cells that one step of a rank search counts for each class, and rows of a cell that it may
# count by value.
CELLS = 4096
LAST_ROWS = 10_000
# Classes that one search holds: their cells are counted on the driver.
MOST_CLASSES = 500
ROW_SPACE = 1 << 60


@dataclass(frozen=True)
class Threshold:
    """The n-th smallest value, rows below it and rows that have it; no value: take all rows."""

    value: int | None
    below: int = 0
    equal: int = 0


def _thresholds(
    df: DataFrame, group: str, column: str, wanted: dict[object, int], space: int
) -> dict[object, Threshold]:
    """The threshold of every class for its wanted number of smallest values, 0 to space.

    Each step counts rows in equal cells, all classes in one scan, and goes on in the cells that
    hold the wanted ranks: two scans where cells then hold LAST_ROWS rows or less. No row is
    sorted, and the driver sees a bounded number of counts.
    """
    spark, value = df.sparkSession, F.col(column)
    kind = dict(df.dtypes)[group]
    found: dict[object, Threshold] = {}
    low = {g: 0 for g in wanted}
    high = {g: space - 1 for g in wanted}
    below = {g: 0 for g in wanted}
    width = {g: (space - 1) // CELLS + 1 for g in wanted}
    while left := [g for g in wanted if g not in found]:
        bounds = F.broadcast(spark.createDataFrame(
            [(g, low[g], high[g], width[g]) for g in left],
            f"_group {kind}, _low bigint, _high bigint, _width bigint",
        ))
        inside = df.join(bounds, F.col(group).eqNullSafe(F.col("_group"))).filter(
            value.between(F.col("_low"), F.col("_high"))
        )
        cell = F.expr(f"({column} - _low) div _width")
        counted: dict[object, list] = {g: [] for g in left}
        for row in inside.groupBy("_group", cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
        ).collect():
            counted[row["_group"]].append(row)
        for g in left:
            for row in sorted(counted[g], key=lambda r: r["cell"]):
                if below[g] + row["n"] >= wanted[g]:
                    break
                below[g] += row["n"]
            else:
                found[g] = Threshold(None)
                continue
            low[g], high[g] = row["low"], row["high"]
            if low[g] == high[g]:
                found[g] = Threshold(low[g], below[g], row["n"])
            # A small cell is counted by value.
            width[g] = 1 if row["n"] <= LAST_ROWS else (high[g] - low[g]) // CELLS + 1
    return found


def _taken(df: DataFrame, group: str, column: str, found: dict[object, Threshold]) -> DataFrame:
    """df with ``_side``: -1 below its class's threshold (or without one), 0 on it, 1 above."""
    kind = dict(df.dtypes)[group]
    limits = F.broadcast(df.sparkSession.createDataFrame(
        [(g, t.value) for g, t in found.items()], f"_group {kind}, _value bigint"
    ))
    side = F.when(F.col("_value").isNull(), -1).otherwise(
        F.signum(F.col(column) - F.col("_value")).cast("int")
    )
    joined = df.join(limits, F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("_side", side).drop("_group", "_value")


def class_sample(
    df: DataFrame, column: str, wanted: Mapping[object, int],
    keys: Sequence[str] = ("flow_id",), seed: int = 42,
) -> DataFrame:
    """Of every class, a value of ``column``, the wanted number of rows with the smallest key
    hash, all if there are fewer: random, yet the same on every run. Classes that are not named
    give no rows, and a null class is one of its own.

    Each scan serves all classes, MOST_CLASSES at most: two for the hashes, and only if a class
    ends among rows of one hash, two more of those rows by their whole content. Only rows equal
    in every column are counted off. ``df`` is read several times: store it first if it holds
    generated values.
    """
    asked = {g: n for g, n in wanted.items() if n > 0}
    if len(asked) > MOST_CLASSES:
        raise ValueError(f"at most {MOST_CLASSES} classes")
    if not asked:
        return df.limit(0)
    ranked = df.withColumns({
        "_class": F.col(column), "_rank": hash_rank([F.col(k) for k in keys], seed).cast("bigint"),
    })
    found = _thresholds(ranked, "_class", "_rank", asked, HASH_SPACE)
    sided = _taken(ranked, "_class", "_rank", found)
    split = {
        g: asked[g] - t.below for g, t in found.items()
        if t.value is not None and t.below + t.equal > asked[g]
    }
    whole = F.col("_side") < 0
    if len(split) < len(found):
        whole = whole | ((F.col("_side") == 0) & ~_one_of("_class", split))
    taken = sided.filter(whole)
    if split:
        content = F.shiftright(F.xxhash64(*df.columns), 4) + F.lit(ROW_SPACE // 2)
        tied = sided.filter((F.col("_side") == 0) & _one_of("_class", split)).withColumn(
            "_row", content
        ).drop("_side")
        ends = _thresholds(tied, "_class", "_row", split, ROW_SPACE)
        placed = _taken(tied, "_class", "_row", ends)
        taken = taken.unionByName(placed.filter("_side < 0").drop("_row"))
        rest = F.broadcast(df.sparkSession.createDataFrame(
            [(g, split[g] - t.below) for g, t in ends.items()],
            f"_of {dict(ranked.dtypes)['_class']}, _n bigint",
        ))
        # The rank limit is applied in the tasks first, so equal rows do not meet in one.
        number = F.row_number().over(Window.partitionBy("_class").orderBy("_row"))
        equal = placed.filter("_side = 0").withColumn("_number", number).filter(
            F.col("_number") <= max(split[g] - t.below for g, t in ends.items())
        ).join(rest, F.col("_class").eqNullSafe(F.col("_of"))).filter("_number <= _n")
        taken = taken.unionByName(equal.select(taken.columns))
    return taken.select(*df.columns)


def _one_of(column: str, classes: Iterable[object]) -> Column:
    return reduce(or_, [F.col(column).eqNullSafe(F.lit(g)) for g in classes], F.lit(False))


def hash_sample(
    df: DataFrame, n: int = TRAINING_CAP, keys: Sequence[str] = ("flow_id",), seed: int = 42,
) -> DataFrame:
    """The ``n`` rows with the smallest key hash, all if there are fewer: random, yet the
    same on every run.

    class_sample() of one class: the result is a filter by the n-th smallest hash, on as many
    tasks as the input. Rows of one key rank by their whole content; only rows equal in every
    column are counted off. ``df`` is read several times: store it first if it holds generated
    values.
    """
    if n <= 0:
        return df.limit(0)
    one = df.withColumn("_one", F.lit(1))
    return class_sample(one, "_one", {1: n}, keys, seed).drop("_one")


def limit_batch(df: DataFrame, n: int, order: Sequence[str | Column] = ()) -> DataFrame:
    """At most ``n`` messages of a bounded read, the first by ``order`` if given."""
    return (df.orderBy(*order) if order else df).limit(n)

"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs.

Growing needs one small sample per tree: Spark draws them by row hash and grows the
trees in parallel groups. Scoring broadcasts the forest, whose size is bounded by
trees x (2 x sample - 1) nodes whatever the data, and walks it over Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.fields import drop_incomplete
from flowloom.functions.hashing import HASH_SPACE, hash_rank
from flowloom.schemas import CANONICAL_19

_NODE = "tree int, node int, feature int, threshold double, left int, right int, path double, rows int"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` keys in a binary tree."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


@dataclass(frozen=True)
class IsolationForest:
    features: list[str]
    sample: int
    depth: int
    # One row per tree, one column per node.
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray

    @property
    def trees(self) -> int:
        return len(self.feature)


def tree_samples(
    df: DataFrame, features: Sequence[str], trees: int, sample: int, keys: Sequence[str], seed: int
) -> DataFrame:
    """``sample`` rows for each tree, drawn by hash: the sample size is the algorithm's own.

    About 2 x sample x trees rows with the smallest hashes leave the scan, whatever the
    input's size; every tree ranks that bounded pool by a hash of its own.
    """
    rows = drop_incomplete(
        df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    )
    total = max(rows.count(), 1)
    wanted = 2 * sample * trees
    key_columns = [F.col(k) for k in keys]
    threshold = math.ceil(HASH_SPACE * min(1.0, wanted / total))
    pool = rows.filter(hash_rank(key_columns, seed) < threshold)
    drawn = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "_draw", F.xxhash64("tree", *keys, F.lit(seed))
    )
    within = Window.partitionBy("tree").orderBy("_draw", *keys)
    return (
        drawn.withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= sample)
        .select("tree", *features)
    )


def _grow(points: np.ndarray, depth: int, rng: np.random.Generator) -> list[list[float]]:
    """Node rows (feature, threshold, left, right, path, rows) of one random tree, root first."""
    nodes: list[list[float]] = []
    todo = [(points, 0, -1, 0)]
    while todo:
        rows, level, parent, side = todo.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = here
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if level >= depth or len(rows) <= 1 or not len(usable):
            nodes.append([-1, 0.0, here, here, level + average_path(len(rows)), len(rows)])
            continue
        column = int(rng.choice(usable))
        cut = float(rng.uniform(low[column], high[column]))
        # A draw equal to the lower end would leave one side empty.
        cut = cut if cut > low[column] else float(high[column])
        nodes.append([column, cut, 0, 0, 0.0, len(rows)])
        below = rows[:, column] < cut
        todo.append((rows[~below], level + 1, here, 1))
        todo.append((rows[below], level + 1, here, 0))
    return nodes


def train_isolation_forest(
    df: DataFrame, features: Sequence[str] = CANONICAL_19, trees: int = 100, sample: int = 256,
    keys: Sequence[str] = ("flow_id",), seed: int = 42,
) -> IsolationForest:
    names = list(features)
    depth = max(1, math.ceil(math.log2(sample)))

    def grow(key: tuple[int], rows: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, int(key[0])])
        points = rows[names].to_numpy(dtype=float)
        points = points[np.lexsort(points.T)]
        grown = pd.DataFrame(
            _grow(points, depth, rng),
            columns=["feature", "threshold", "left", "right", "path", "rows"],
        )
        grown.insert(0, "node", range(len(grown)))
        grown.insert(0, "tree", int(key[0]))
        return grown

    samples = tree_samples(df, names, trees, sample, keys, seed)
    nodes = samples.groupBy("tree").applyInPandas(grow, _NODE).toPandas()
    if nodes.empty:
        raise ValueError("no complete rows to train on")
    grown = sorted(nodes["tree"].unique())
    width = int(nodes["node"].max()) + 1
    row = nodes["tree"].map({t: i for i, t in enumerate(grown)}).to_numpy()
    column = nodes["node"].to_numpy()

    def table(name: str, dtype: type) -> np.ndarray:
        values = np.zeros((len(grown), width), dtype=dtype)
        values[row, column] = nodes[name].to_numpy()
        return values

    return IsolationForest(
        names, int(nodes["rows"].max()), depth, table("feature", np.int32), table("threshold", float),
        table("left", np.int32), table("right", np.int32), table("path", float),
    )


def _mean_path(forest: IsolationForest, points: np.ndarray) -> np.ndarray:
    rows = np.arange(len(points))
    total = np.zeros(len(points))
    for t in range(forest.trees):
        node = np.zeros(len(points), dtype=np.int32)
        for _ in range(forest.depth):
            feature = forest.feature[t, node]
            # Leaves point at themselves, so a walk that has arrived stays put.
            below = points[rows, np.maximum(feature, 0)] < forest.threshold[t, node]
            node = np.where(below, forest.left[t, node], forest.right[t, node])
        total += forest.path[t, node]
    return total / forest.trees


def score_isolation_forest(
    df: DataFrame, forest: IsolationForest, threshold: float = 0.6
) -> DataFrame:
    """Adds ``anomaly_score`` = 2^(-mean path / average path) in (0, 1] and
    ``is_anomaly``; rows with a missing feature are left out, as for the classifier."""
    shared = df.sparkSession.sparkContext.broadcast(forest)
    norm = average_path(forest.sample) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        grown = shared.value
        for batch in batches:
            points = batch.to_numpy(dtype=float)
            yield pd.Series(np.power(2.0, -_mean_path(grown, points) / norm))

    inputs = F.struct(*[F.col(c).cast("double").alias(c) for c in forest.features])
    return (
        drop_incomplete(df, forest.features)
        .withColumn("anomaly_score", score(inputs))
        .withColumn("is_anomaly", (F.col("anomaly_score") >= threshold).cast("int"))
    )

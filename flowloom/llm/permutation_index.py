"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Each shard of the index holds up to
SHARD_ROWS vectors (by hash of their id), picks its own pivots among them and posts every vector
in the inverted files of its nearest pivots, with the pivot's place in the vector's order. A
query walks the files of its own nearest pivots, which gives the footrule distance of the orders
for every vector met; the best by footrule are ranked again by the exact distance.

Shards keep the posting lists of a pivot bounded however many vectors crowd around it, and give
every query block and shard one independent task.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.texts import table
from flowloom.session import run_dir

SHARD_ROWS = 16_384
QUERY_BLOCK = 1_024
PIVOTS = 512
#: Pivots are the farthest-first choice among so many sampled vectors for each pivot.
SAMPLED = 3
#: Nearest pivots that represent a vector.
ORDER = 96
#: Share of a shard, the best by footrule distance, that is ranked by the exact distance for
#: each query: 1 / so many, at any size, but not fewer vectors than the second number.
CANDIDATE_SHARE, LEAST_CANDIDATES = 8, 128
#: Share of the largest footrule distance up to which all vectors are ranked exactly: copies and
#: near copies of the query, however many, whose orders hardly tell them apart.
CROWD = 0.1
NEIGHBOURS = 10

INDEX = "dim int, shard int, vec_ids binary, vectors binary, pivots binary, postings binary"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vector and dim of the rows that can take part.

    Left out: null ids, null or empty vectors, null or non-finite components, and all zeros.
    """
    v = F.col(vector_column)
    sound = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_column).isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"),
        F.size(v).alias("dim"),
    )


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate(column.to_list()).astype(np.float64).reshape(len(column), dim)


def _spread(rows: np.ndarray) -> np.ndarray:
    """PIVOTS rows of a sample, each the farthest from those before it.

    A dense crowd of near copies then gets few pivots, however much of the shard it is.
    """
    sample = np.random.default_rng(7).permutation(len(rows))[:SAMPLED * PIVOTS]
    rows = rows[np.sort(sample)]
    chosen, away = [0], np.full(len(rows), np.inf)
    while len(chosen) < min(PIVOTS, len(rows)):
        away = np.minimum(away, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(away.argmax()))
    return rows[chosen]


def _nearest_pivots(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Each row's ORDER nearest pivots, nearest first; ties to the earlier pivot."""
    kept = min(ORDER, len(pivots))
    orders = np.empty((len(rows), kept), dtype=np.int32)
    squares = (pivots * pivots).sum(axis=1)
    for start in range(0, len(rows), 4096):
        block = rows[start:start + 4096]
        far = squares[None, :] - 2.0 * (block @ pivots.T)
        orders[start:start + 4096] = np.argsort(far, axis=1, kind="stable")[:, :kept]
    return orders


def _post(orders: np.ndarray, n_pivots: int) -> bytes:
    """Inverted files: bounds of each pivot's list, then rows and places, both by pivot."""
    flat = orders.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    bounds = np.searchsorted(flat[by_pivot], np.arange(n_pivots + 1))
    rows = (by_pivot // orders.shape[1]).astype("<i4")
    places = (by_pivot % orders.shape[1]).astype("<u1")
    return struct.pack("<I", n_pivots) + bounds.astype("<i8").tobytes() + rows.tobytes(
    ) + places.tobytes()


def _posted(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (n_pivots,) = struct.unpack_from("<I", data)
    bounds = np.frombuffer(data, "<i8", n_pivots + 1, 4)
    at = 4 + bounds.nbytes
    rows = np.frombuffer(data, "<i4", int(bounds[-1]), at)
    return bounds, rows, np.frombuffer(data, "<u1", int(bounds[-1]), at + rows.nbytes)


def build_index(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """The index of all usable vectors: one row per shard, to be written and kept.

    Pivots come from a sample of SAMPLED * PIVOTS vectors of the shard; every vector is posted.
    Vectors of different lengths go to different shards and never meet. Rows with a null id, and
    vectors that are null, empty, all zeros or hold null or non-finite components, take no part;
    repeated rows and ids are posted each. An empty table gives no shard. Other columns are ignored.
    """
    rows = usable(vectors, id_column, vector_column)
    shards = max(1, -(-rows.count() // SHARD_ROWS))

    def build(key, part: pd.DataFrame) -> pd.DataFrame:
        dim = int(key[0])
        part = part.sort_values("vec_id", kind="stable")
        matrix = _matrix(part["vector"], dim)
        pivots = _spread(np.unique(matrix, axis=0))
        return pd.DataFrame({
            "dim": [dim], "shard": [int(key[1])],
            "vec_ids": [part["vec_id"].to_numpy("<i8").tobytes()],
            "vectors": [matrix.astype("<f8").tobytes()],
            "pivots": [pivots.astype("<f8").tobytes()],
            "postings": [_post(_nearest_pivots(matrix, pivots), len(pivots))],
        })

    # The vector is hashed too, so that an id that many rows share is split.
    return rows.withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    ).groupBy("dim", "shard").applyInPandas(build, INDEX)


def _footrule(bounds, rows, places, order, n, kept) -> np.ndarray:
    """Induced footrule distance to all n vectors, up to a constant.

    A pivot in one order only counts as if it stood behind the other's last place.
    """
    score = np.zeros(n, dtype=np.int64)
    for place, pivot in enumerate(order):
        at = slice(bounds[pivot], bounds[pivot + 1])
        met, theirs = rows[at], places[at].astype(np.int64)
        score[met] += np.abs(theirs - place) + theirs + place - 2 * kept
    return score


def _search_shard(queries: pd.DataFrame, shard: pd.Series, dim: int, k: int) -> Iterator[tuple]:
    ids = np.frombuffer(shard["vec_ids"], "<i8")
    matrix = np.frombuffer(shard["vectors"], "<f8").reshape(-1, dim)
    pivots = np.frombuffer(shard["pivots"], "<f8").reshape(-1, dim)
    bounds, rows, places = _posted(shard["postings"])
    asked = _matrix(queries["vector"], dim)
    orders = _nearest_pivots(asked, pivots)
    n = len(ids)
    arrival = np.arange(n)
    for query_id, vector, order in zip(
        queries["vec_id"].to_numpy(), asked, orders, strict=True
    ):
        score = _footrule(bounds, rows, places, order, n, orders.shape[1])
        # Ties go to smaller ids: rows are in the order of their ids.
        ranked = score * n + arrival
        ranked[ids == query_id] = np.iinfo(np.int64).max
        wanted = min(n, max(LEAST_CANDIDATES, -(-n // CANDIDATE_SHARE)))
        # Equal orders have the distance 0, which is -most before the constant is added.
        most = orders.shape[1] * (orders.shape[1] + 1)
        close = max(wanted, int((score <= (CROWD - 1) * most).sum()))
        near = np.argpartition(ranked, close - 1)[:close] if close < n else arrival
        near = near[ids[near] != query_id]
        far = np.sqrt(((matrix[near] - vector) ** 2).sum(axis=1))
        best = np.lexsort((ids[near], far))[:k]
        for i in best:
            yield int(query_id), int(ids[near[i]]), float(far[i])


def search(
    index: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k nearest of each query: query_id, rank (from 1), vec_id, score (Euclidean distance).

    A query never finds its own id. Ties go to smaller ids; fewer candidates than k give fewer
    rows. Unusable queries give no rows, and a query id that repeats is asked once, with the
    smallest of its vectors. An empty index or query table gives no rows. Other columns are
    ignored.
    """
    least = F.min(F.struct("vector", "dim")).alias("least")
    asked = usable(queries, id_column, vector_column).groupBy("vec_id").agg(least).select(
        "vec_id", "least.vector", "least.dim"
    )
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    # Queries in bounded blocks against shards of bounded size.
    places = index.select(F.col("dim").alias("of_dim"), F.col("shard").alias("of_shard"))
    per_shard = asked.join(places, F.col("dim") == F.col("of_dim"))
    blocks_of = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(key, some: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(some):
            for _, shard in shards.iterrows():
                found += _search_shard(some, shard, int(key[0]), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    near = per_shard.groupBy("of_dim", "of_shard", "block").cogroup(
        blocks_of.groupBy("dim", "shard", "block")
    ).applyInPandas(find, "query_id long, vec_id long, score double")
    by_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(by_query)).where(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    path = run_dir(spark, "permutation-index")
    build_index(vectors).write.parquet(path)
    return search(spark.read.parquet(path), vectors.where(F.col("vec_id") % 100 == 0))

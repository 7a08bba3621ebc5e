"""Embedding whitening by FEAST contour integration.

The covariance of all distinct vectors is summed over the partitions; only that matrix, of the
vectors' length squared, comes to the driver. Its leading eigenvalues are enclosed in intervals by
inertia: the pivots of a shifted matrix tell by their signs how many eigenvalues lie below the
shift. For every interval a circle is drawn around it, and the integral of the resolvent along
that circle, a quadrature of complex shifted solves, projects a random basis onto the interval's
eigenvectors. The solves are independent and run as rows of a Spark job. Rayleigh-Ritz extracts
the pairs, and an interval is done when it gave as many as its inertia counts promise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.texts import table
from flowloom.session import run_dir

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Products beyond this stay there, so that every finite entry has an integer.
LARGEST = float(2**61)
COMPONENTS = 16
#: Quadrature nodes on the upper half of a circle; the lower half is its mirror image.
NODES = 8
#: An interval is halved while it holds more eigenvalues.
PER_INTERVAL = 6
#: Eigenvalues of at most this share of the trace count as zero.
NO_VARIANCE = 1e-12
#: Largest residual of a pair, as a share of the spectrum's bound.
RESIDUAL = 1e-14
#: Rounds after which the basis of an interval that is not done gets wider.
ROUNDS = 4


@dataclass(frozen=True)
class Whitening:
    """What one length of vectors was fitted to; scaled holds a component over sqrt(e) a column."""

    n: int
    #: Exact integers, as Python's own.
    sums: np.ndarray
    values: np.ndarray
    scaled: np.ndarray
    trace: float
    identity_error: float | None = None

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - (self.sums / self.n).astype(np.float64)) @ self.scaled

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sums) squared; null where a long cannot hold one."""
        most = self.n * float(np.abs(x).max(initial=0)) + float(np.abs(self.sums).max())
        if most < 2**62:
            away = self.n * x - self.sums.astype(np.int64)
            if float(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 2**62:
                return (away * away).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - self.sums) ** 2).sum(axis=1)
        return [value if value < 2**63 else None for value in exact]


def quantized(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, dim and the integers x of the rows whose vectors are whole and finite."""
    v = F.col(vector_column)
    sound = F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )

    def integer(c):
        scaled = c.cast("double") * float(SCALE)
        return F.floor(F.least(F.greatest(scaled, F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT

    return vectors.where(sound & (F.size(v) > 0)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.size(v).alias("dim"),
        F.transform(v, integer).alias("x"),
    )


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length in a batch."""
    lists = batch.column("x")
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        yield dim, rows, flat[starts[rows][:, None] + np.arange(dim)]


def _second_moments(rows: DataFrame, project) -> DataFrame:
    """dim, i, j, total: sums of products of project(dim, x)'s columns, i <= j, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                y = project(dim, x)
                sums[dim] = sums.get(dim, 0.0) + y.T @ y
        for dim, total in sums.items():
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)),
                    pa.array(j.astype(np.int32)), pa.array(total[i, j]),
                ],
                ["dim", "i", "j", "part"],
            )

    return rows.select("x").mapInArrow(run, "dim int, i int, j int, part double").groupBy(
        "dim", "i", "j"
    ).agg(F.sum("part").alias("total"))


def _matrices(moments: DataFrame) -> dict[int, np.ndarray]:
    """The symmetric matrix of each length."""
    found = moments.toArrow().to_pandas()
    matrices = {}
    for dim, part in found.groupby("dim"):
        size = int(part["j"].max()) + 1
        matrices[int(dim)] = whole = np.zeros((size, size))
        whole[part["i"], part["j"]] = whole[part["j"], part["i"]] = part["total"]
    return matrices


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared side diagonal of a similar tridiagonal matrix, by reflections."""
    a = matrix.copy()
    side = np.zeros(max(0, len(a) - 1))
    for k in range(len(a) - 1):
        x = a[k + 1:, k]
        side[k] = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(side[k], x[0])
        length = np.linalg.norm(v)
        if length:
            v /= length
            w = a[k + 1:, k + 1:] @ v
            w -= (v @ w) * v
            a[k + 1:, k + 1:] -= 2.0 * (np.outer(v, w) + np.outer(w, v))
    return a.diagonal().copy(), side * side


def below(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues lie below a shift: the negative pivots of the shifted form."""
    diagonal, squares = form
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = 0, 1.0
    for d, s in zip((diagonal - shift).tolist(), [0.0, *squares.tolist()], strict=True):
        pivot = d - s / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def intervals(
    form: tuple[np.ndarray, np.ndarray], floor: float, bound: float, wanted: int
) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) from the top, until they hold so many or reach the floor.

    Edges stand clear of eigenvalues: both sides of an edge give the same count.
    """
    def edge(low: float, high: float) -> float | None:
        for share in (0.5, 0.41, 0.59, 0.33, 0.67, 0.24, 0.76):
            at, clear = low + share * (high - low), 1e-3 * (high - low)
            if below(form, at - clear) == below(form, at + clear):
                return at
        return None

    found, held = [], 0
    stack = [(floor, bound)]
    while stack and held < wanted:
        low, high = stack.pop()
        inside = below(form, high) - below(form, low)
        # A cluster that no edge can part stays whole.
        part = edge(low, high) if inside > PER_INTERVAL and high - low > 1e-9 * bound else None
        if part is not None:
            stack += [(low, part), (part, high)]
        elif inside:
            found.append((low, high, inside))
            held += inside
    return found


def _solves(
    spark: SparkSession, matrix: np.ndarray, jobs: list[tuple[int, float, float]],
    bases: dict[int, np.ndarray],
) -> dict[int, np.ndarray]:
    """Each interval's basis under the quadrature of the resolvent around it.

    One row, and so at most one task, for each interval and node.
    """
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = 0.5 * np.pi * (1.0 - nodes)
    rows = [
        (i, 0.5 * (low + high), 0.5 * (high - low), float(angle), float(weight))
        for i, low, high in jobs
        for angle, weight in zip(angles, weights, strict=True)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                turn = row["radius"] * np.exp(1j * row["angle"])
                shifted = (row["centre"] + turn) * np.eye(len(matrix)) - matrix
                solved = np.linalg.solve(shifted, bases[row["interval"]])
                part = 0.5 * row["weight"] * (turn * solved).real
                yield pa.RecordBatch.from_pydict(
                    {"interval": pa.array([row["interval"]], pa.int32()), "part": [part.tobytes()]}
                )

    frame = spark.createDataFrame(
        rows, "interval int, centre double, radius double, angle double, weight double"
    ).repartition(min(len(rows), spark.sparkContext.defaultParallelism))
    total = {i: np.zeros(bases[i].shape) for i, _, _ in jobs}
    for found in frame.mapInArrow(run, "interval int, part binary").collect():
        total[found["interval"]] += np.frombuffer(found["part"]).reshape(
            total[found["interval"]].shape
        )
    return total


def rayleigh_ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, falling, and vectors of the space that the basis spans."""
    left, sizes, _ = np.linalg.svd(basis, full_matrices=False)
    space = left[:, sizes > 1e-14 * sizes[0]]
    values, turned = np.linalg.eigh(space.T @ matrix @ space)
    return values[::-1], (space @ turned)[:, ::-1]


def leading_pairs(
    spark: SparkSession, matrix: np.ndarray, wanted: int
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above the floor, falling, at most so many, and unit eigenvectors."""
    dim = len(matrix)
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    none = np.zeros(0), np.zeros((dim, 0))
    if not bound > 0:
        return none
    form = tridiagonal(matrix)
    todo = dict(enumerate(
        intervals(form, NO_VARIANCE * float(np.trace(matrix)), bound, min(wanted, dim))
    ))
    random = np.random.default_rng(12)
    bases = {
        i: random.standard_normal((dim, min(dim, inside + inside // 2 + 4)))
        for i, (_, _, inside) in todo.items()
    }
    done, turns = [], 0
    while todo:
        projected = _solves(
            spark, matrix, [(i, low, high) for i, (low, high, _) in todo.items()], bases
        )
        turns += 1
        for i, (low, high, inside) in list(todo.items()):
            values, vectors = rayleigh_ritz(matrix, projected[i])
            held = (values >= low) & (values < high)
            own = vectors[:, held]
            residual = np.linalg.norm(matrix @ own - own * values[held], axis=0)
            if held.sum() == inside and residual.max() <= RESIDUAL * dim * bound:
                done.append(own)
                del todo[i]
            elif turns % ROUNDS or vectors.shape[1] == dim:
                bases[i] = vectors
            else:  # A wider space always gets there: that of all vectors is exact.
                more = random.standard_normal((dim, min(dim, 2 * vectors.shape[1])))
                bases[i] = np.concatenate([vectors, more], axis=1)[:, :dim]
        if turns > 20 * ROUNDS:
            raise ArithmeticError("inertia counts and extracted components do not agree")
    if not done:
        return none
    values, vectors = rayleigh_ritz(matrix, np.concatenate(done, axis=1))
    return values[:wanted], vectors[:, :wanted]


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each length of quantized() vectors, fitted to each distinct one once.

    Copies meet in the map tasks already (distinct combines before it shuffles). Three scans of
    the distinct vectors: sums, covariance, and the covariance of what was whitened. A length
    whose vectors do not vary has no components and is left out.
    """
    spark = rows.sparkSession
    path = run_dir(spark, "fit-list")
    rows.select("dim", "x").distinct().write.parquet(path)
    listed = spark.read.parquet(path)
    summed = listed.select("dim", F.posexplode("x")).groupBy("dim", "pos").agg(
        F.count("*").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("total")
    ).orderBy("dim", "pos").collect()
    counts: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for row in summed:
        counts[row["dim"]] = row["n"]
        sums.setdefault(row["dim"], []).append(int(row["total"]))
    means = {dim: np.array([t / counts[dim] for t in totals]) for dim, totals in sums.items()}
    models = {}
    moments = _matrices(_second_moments(listed, lambda dim, x: x - means[dim]))
    for dim, total in moments.items():
        n, covariance = counts[dim], total / counts[dim]
        values, vectors = leading_pairs(spark, covariance, components)
        if len(values):
            models[dim] = Whitening(
                n, np.array(sums[dim], dtype=object), values, vectors / np.sqrt(values),
                float(np.trace(covariance)),
            )
    varied = listed.where(F.col("dim").isin(sorted(models)))
    white = _matrices(_second_moments(varied, lambda dim, x: models[dim].whiten(x)))
    return {
        dim: replace(model, identity_error=float(
            np.abs(white[dim] / model.n - np.eye(len(model.values))).max()
        ))
        for dim, model in models.items()
    }


def whiten(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """One row for each quantized() row and component; rows of a length without a model give none.

    The models are in every task: matrices of a vector's length times the components.
    """
    names = [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, places, x in _by_length(batch):
                if dim not in models:
                    continue
                model, kept = models[dim], len(models[dim].values)
                ids = batch.column("vec_id").take(pa.array(np.repeat(places, kept)))
                deviations = pa.array(model.deviations(x), pa.int64())
                size = len(places) * kept
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(places))),
                        pa.array(np.full(size, model.n)),
                        deviations.take(pa.array(np.repeat(np.arange(len(places)), kept))),
                        pa.array(model.whiten(x).ravel()),
                        pa.array(np.tile(model.values / model.trace, len(places))),
                        pa.array(np.full(size, model.identity_error)),
                    ],
                    names,
                )

    return rows.select("vec_id", "x").mapInArrow(
        run,
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    )


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Whitened components of all rows whose vectors are whole and finite.

    Left out are null and empty vectors and those with null or non-finite entries. Repeated rows
    and ids, and null ids, each give their own rows. Vectors of different lengths are fitted
    apart. Components are those whose eigenvalue is above 1e-12 of the trace, so vectors that
    are all equal, a single one, and an empty table give no rows. A deviation that a long cannot
    hold is null. Other columns are ignored. The vectors' length is the only size that the
    driver's part grows with, by its square in memory.
    """
    rows = quantized(vectors, id_column, vector_column)
    return whiten(rows, fit(rows, components))


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))

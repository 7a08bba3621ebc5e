"""Whitening against numpy's own eigenvectors and plain integer sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import whitening
from flowloom.llm.texts import table


def integers(vectors):
    return [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]


def check(found, rows):
    """rows: (vec_id, vector) of one length; found: the operator's rows for them."""
    x = integers(v for _, v in rows)
    fit_list = sorted(set(map(tuple, x)))
    n, d = len(fit_list), len(fit_list[0])
    sums = [sum(v[k] for v in fit_list) for k in range(d)]
    centred = np.array([[v[k] - sums[k] / n for k in range(d)] for v in fit_list])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(16, int((values > 1e-12 * values.sum()).sum()))
    wanted = sorted(
        (i is not None, i or 0, sum((n * a - s) ** 2 for a, s in zip(v, sums)))
        for (i, _), v in zip(rows, x, strict=True)
    )
    assert len(found) == len(rows) * kept
    for component in range(1, kept + 1):
        own = [r for r in found if r.component == component]
        assert sorted((r.vec_id is not None, r.vec_id or 0, r.deviation) for r in own) == wanted
        for r in own:
            assert r.n == n
            assert abs(r.explained - values[component - 1] / values.sum()) < 1e-9 * r.explained
            assert r.identity_error < 1e-6
        # Up to the sign, and apart from others only if its eigenvalue is.
        gaps = np.abs(np.delete(values, component - 1) - values[component - 1])
        if len(gaps) and gaps.min() < 1e-6 * values[0]:
            continue
        axis = vectors[:, component - 1] / math.sqrt(values[component - 1])
        plain = {}
        for (i, _), v in zip(rows, x, strict=True):
            plain.setdefault(i, []).append((np.array(v) - np.array(sums) / n) @ axis)
        got = {}
        for r in own:
            got.setdefault(r.vec_id, []).append(r.whitened)
        best = min(
            max(
                abs(a - b) for i in plain
                for a, b in zip(sorted(sign * y for y in plain[i]), sorted(got[i]), strict=True)
            )
            for sign in (1, -1)
        )
        assert best < 1e-6


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    check(whitening.op12_feast_whitening(spark, sf_dir).collect(), rows)


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 17, 40):
        half = rng.standard_normal((d, max(1, d // 2)))
        for matrix in (half @ half.T, np.diag(rng.integers(-2, 3, d).astype(float)), np.eye(d)):
            form = whitening.tridiagonal(matrix)
            values = np.linalg.eigvalsh(matrix)
            for shift in rng.uniform(-3, 3 + d, 30):
                assert whitening.below(form, shift) == (values < shift).sum()


@pytest.mark.parametrize("kind", ["clustered", "steep", "low rank", "identity"])
def test_leading_pairs(spark, kind):
    rng = np.random.default_rng(1)
    axes = np.linalg.qr(rng.standard_normal((48, 48)))[0]
    values = {
        "clustered": np.array([5.0] * 9 + [5.0 + 1e-9] * 4 + [1.0] * 35),
        "steep": 10.0 ** -np.arange(48),
        "low rank": np.array([3.0, 2.0, 1.0] + [0.0] * 45),
        "identity": np.ones(48),
    }[kind]
    matrix = axes * values @ axes.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_pairs(spark, matrix, 16)
    wanted = np.sort(values)[::-1]
    wanted = wanted[wanted > 1e-12 * wanted.sum()][:16]
    assert len(found) == len(wanted)
    assert np.abs(found - wanted).max() < 1e-12 * wanted[0] * 48
    assert np.abs(vectors.T @ vectors - np.eye(len(wanted))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    good += [good[0], good[1], (None, good[2][1]), (3, [1e3, -1e3, 0.0, 0.5, 0.25])]
    short = [(100 + i, [float(i), -0.0]) for i in range(3)]
    lone = [(200, [1.0, 2.0, 3.0]), (201, [1.0, 2.0, 3.0])]
    bad = [(300, None), (301, []), (302, [1.0, None, 2.0, 0.0, 0.0]), (303, [nan] * 5),
           (304, [inf, 0.0, 0.0, 0.0, 0.0])]
    rows = good + short + lone + bad
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *(F.lit("x").alias(c) for c in ("x", "dim", "component", "n"))
    ).repartition(5)
    found = whitening.whitened(df).collect()
    assert not {r.vec_id for r in found} & {200, 201, 300, 301, 302, 303, 304}
    check([r for r in found if r.vec_id is not None and 100 <= r.vec_id < 103], short)
    check([r for r in found if r.vec_id is None or r.vec_id < 100], good)
    assert whitening.whitened(df.limit(0)).collect() == []
    huge = spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whitened(huge).collect()] == [None, None]

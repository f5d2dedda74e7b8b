"""Whitening against exact fractions, and its edge cases."""

import math
from fractions import Fraction

import numpy as np
import pytest

from assaymill.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(vectors):
    """Distinct quantised vectors, their sums and covariance by the definition, in fractions."""
    xs = sorted({tuple(math.floor(256 * c) for c in v) for v in vectors})
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    v = [
        [float(sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in xs) / n) for j in range(d)]
        for i in range(d)
    ]
    return n, sums, np.array(v)


def vectors_of(rng, rows, dims):
    return [[float(np.float32(c)) for c in rng.normal(0, [1 + 3 * i for i in range(dims)])] for _ in range(rows)]


def test_against_fractions(spark):
    vectors = vectors_of(np.random.default_rng(1), 60, 5)
    rows = [(i, v) for i, v in enumerate(vectors + vectors[:20])]  # copies count once in the fit
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    n, sums, v = brute(vectors)
    model = whitening.fit(df)
    assert (model.n, list(model.sums)) == (n, sums)
    assert np.allclose(model.vectors @ np.diag(model.values) @ model.vectors.T, v, rtol=1e-13, atol=1e-10)
    values, basis = np.linalg.eigh(v)
    found = whitening.whitened_components(df).collect()
    assert len(found) == 4 * len(rows)
    for r in found:
        x = [math.floor(256 * c) for c in rows[r.vec_id][1]]
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        e = values[-r.component]
        z = (np.array(x) - np.array(sums) / n) @ basis[:, -r.component] / math.sqrt(e)
        assert abs(abs(r.whitened) - abs(z)) < 1e-9
        assert abs(r.explained / (e / np.trace(v)) - 1) < 1e-9
        assert r.identity_error < 1e-9
    # One sign for all rows.
    signs = {r.component: set() for r in found}
    for r in found:
        x = [math.floor(256 * c) for c in rows[r.vec_id][1]]
        z = (np.array(x) - np.array(sums) / n) @ basis[:, -r.component]
        signs[r.component].add(np.sign(z) * np.sign(r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_query(spark, sf_dir):
    found = queries.op12_whitening(spark, sf_dir)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    n, sums, v = brute([r.embedding for r in source])
    rows = found.collect()
    assert len(rows) == 4 * len(source)
    exact = {
        r.vec_id: sum((n * math.floor(256 * c) - s) ** 2 for c, s in zip(r.embedding, sums)) for r in source
    }
    assert all(r.deviation == exact[r.vec_id] and r.n == n for r in rows)
    assert max(r.identity_error for r in rows) < 1e-9


def test_dropped_rows_and_clashing_names(spark):
    good = vectors_of(np.random.default_rng(2), 12, 3)
    rows = [(i, v) for i, v in enumerate(good)]
    rows += [(90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 0.0]), (93, [float("inf")] * 3)]
    rows += [(94, []), (95, [1.0, 2.0]), (None, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' AS deviation", "1 AS _x", "2 AS x")
    found = whitening.transform(df, whitening.fit(df))
    assert found.columns == ["vec_id", "embedding", "_x", "x", "deviation", "whitened"]
    kept = found.collect()
    assert {r.vec_id for r in kept} == {*range(12), None}
    assert all(len(r.whitened) == 3 and type(r.deviation) is int for r in kept)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    found = whitening.whitened_components(spark.createDataFrame(rows, SCHEMA))
    assert found.collect() == [] and "whitened" in found.columns


def test_no_variance(spark):
    one = whitening.whitened_components(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened) for r in sorted(one)] == [
        (1, 1, 1, 0, None), (1, 2, 1, 0, None), (2, 1, 1, 0, None), (2, 2, 1, 0, None)
    ]
    flat = spark.createDataFrame([(i, [float(i), 3.0]) for i in range(5)], SCHEMA)
    found = whitening.whitened_components(flat).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in found)


def test_wide_values_stay_exact(spark):
    rng = np.random.default_rng(3)
    schema = "vec_id bigint, embedding array<double>"
    for scale in (1e6, 1e11, 1e15, 1e300):
        vectors = [[float(c) for c in rng.normal(0, scale, 3)] for _ in range(9)]
        df = spark.createDataFrame(list(enumerate(vectors)), schema)
        ends = (-(1 << 63), (1 << 63) - 1)
        xs = [[min(max(math.floor(256 * Fraction(c)), ends[0]), ends[1]) for c in v] for v in vectors]
        model = whitening.fit(df)
        distinct = sorted(set(map(tuple, xs)))
        n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
        assert (model.n, list(model.sums)) == (n, sums)
        exact = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in enumerate(xs)}
        for r in whitening.transform(df, model).collect():
            assert r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None)
        v = [[float(sum(Fraction((n * x[i] - sums[i]) * (n * x[j] - sums[j]), n**3) for x in distinct)) for j in range(3)] for i in range(3)]
        rebuilt = model.vectors @ np.diag(model.values) @ model.vectors.T
        assert np.allclose(rebuilt, v, rtol=1e-12, atol=1e-12 * np.abs(v).max())

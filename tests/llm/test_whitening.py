"""Whitening against a plain eigendecomposition of the covariance."""

import numpy as np
import pytest
from fringeframe.llm import whitening
from pyspark.sql import functions as F

S = "vec_id long, embedding array<float>"
NAN, INF = float("nan"), float("inf")


def check(df):
    """Compare all columns; returns the number of rows."""
    data = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    data = [(i, [int(np.floor(256 * c)) for c in e]) for i, e in data if e is not None and all(c is not None and np.isfinite(c) for c in e)]
    dim = max((len(e) for _, e in data), default=0)
    data = [(i, e + [0] * (dim - len(e))) for i, e in data]
    fit = np.array(sorted({tuple(e) for _, e in data}))
    got = [r.asDict() for r in whitening.whiten(df).collect()]
    if len(fit) < 2 or dim == 0:
        assert got == []
        return 0
    n, sums = len(fit), fit.sum(0)
    cov = (fit - sums / n).T @ (fit - sums / n) / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(4, int((e > 1e-20 * e[0]).sum())) if len(fit) > dim else min(4, len(fit) - 1)
    assert len(got) == k * len(data)
    for c in range(1, k + 1):
        mine = sorted((-1 if g["vec_id"] is None else g["vec_id"], abs(g["whitened"]), g["deviation"]) for g in got if g["component"] == c)
        plain = sorted((-1 if i is None else i, abs(float((np.array(x) - sums / n) @ u[:, c - 1] / np.sqrt(e[c - 1]))), sum((n * a - int(b)) ** 2 for a, b in zip(x, sums))) for i, x in data)
        assert [m[0::2] for m in mine] == [p[0::2] for p in plain]
        assert np.allclose([m[1] for m in mine], [p[1] for p in plain], atol=1e-8)
        assert {g["explained"] for g in got if g["component"] == c}.pop() == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
    assert {g["n"] for g in got} == {n} and len({g["identity_error"] for g in got}) == 1 and got[0]["identity_error"] < 1e-8
    return len(got)


def test_given_table(spark, sf):
    assert check(spark.read.parquet(f"{sf}/embeddings.parquet")) > 0


def test_spread_of_variances(spark):
    r = np.random.default_rng(0)
    scale = [1e3, 30, 5, 0.5, 0.05]
    assert check(spark.createDataFrame([(i, [float(v) for v in r.normal(size=5) * scale]) for i in range(300)], S)) == 1200


def test_awkward_rows(spark):
    rows = [(1, [0.1, 0.2, 5.0]), (2, None), (3, [NAN, 1.0, 1.0]), (4, [None, 1.0, 2.0]), (5, [0.5, 0.2, 1.0]), (5, [0.5, 0.2, 1.0]), (6, [INF, 0.0, 0.0]), (7, []), (None, [3.0, -0.001]),
            (8, [-0.0, 2.0, -7.5]), (9, [0.5, 0.2, 1.0])]
    df = spark.createDataFrame(rows, S)
    assert check(df) == 3 * 7
    for c in ("x", "c", "component", "n", "whitened"):
        df = df.withColumn(c, F.lit("x"))
    assert check(df) == 3 * 7


def test_few_distinct_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        assert check(spark.createDataFrame(rows, S)) == 0


def test_exhausted_spectrum_starts_again(spark):
    """Repeated and constant dimensions: the bidiagonalisation meets zeros before all dimensions are seen."""
    assert check(spark.createDataFrame([(i, [float(i % 3), float(i % 5), 1.0, float(i % 3)]) for i in range(40)], S)) == 80


def test_equal_variances(spark):
    """Four equal eigenvalues: any basis, so only the whitening itself is fixed."""
    rows = [(2 * i + s, [float((1 - 2 * s) * (i == j)) for j in range(4)]) for i in range(4) for s in range(2)]
    got = whitening.whiten(spark.createDataFrame(rows, S)).collect()
    assert len(got) == 32 and got[0]["identity_error"] < 1e-9 and all(g["explained"] == pytest.approx(0.25) for g in got)


def test_deviation_beyond_64_bits(spark):
    got = whitening.whiten(spark.createDataFrame([(1, [1e12, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 3.0])], S)).collect()
    assert {g["vec_id"]: g["deviation"] for g in got} == {1: None, 2: None, 3: None}
    got = whitening.whiten(spark.createDataFrame([(1, [3e6, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 3.0])], S)).collect()
    x = [[768_000_000, 0], [0, 256], [256, 768]]
    s = [sum(c) for c in zip(*x)]
    assert {g["vec_id"]: g["deviation"] for g in got} == {i + 1: sum((3 * a - b) ** 2 for a, b in zip(r, s)) for i, r in enumerate(x)}


def test_partition_counts_agree(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r.normal(size=6) * [9, 7, 5, 3, 2, 1]]) for i in range(200)]
    a, b = (sorted((g["vec_id"], g["component"], round(abs(g["whitened"]), 9)) for g in whitening.whiten(spark.createDataFrame(rows, S).repartition(p)).collect()) for p in (1, 7))
    assert a == b

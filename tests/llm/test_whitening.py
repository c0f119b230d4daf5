"""Whitening against NumPy on small tables, its eigenvectors against known ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm import queries, whitening
from gazette.llm.whitening import WIDE

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        *(T.StructField(c, T.StringType()) for c in ("x", "whitened", "place", "task", "n")),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA)


def whole(rows):
    """The kept rows as (vec_id, whole components)."""
    return [
        (i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]


def vectors(n=300, dims=12, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims)) + rng.standard_normal(dims)
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    rows += [(3, rows[8][1]), (None, rows[5][1]), (n, None), (n + 1, [None] * dims), *rows[:2]]
    return [*rows, (n + 2, [math.nan] * dims), (n + 3, [math.inf] + [0.0] * (dims - 1))]


def matrix(values, seed=0):
    """A symmetric matrix in extended precision with the given eigenvalues."""
    n = len(values)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))[0].astype(WIDE)
    basis = whitening._orthonormal(basis)
    a = (basis * np.array(values, WIDE)) @ basis.T
    return (a + a.T) / 2, basis


CASES = {
    "spread": np.linspace(1, 40, 40),
    "graded": 10.0 ** np.linspace(-12, 2, 40),
    "close to single precision": np.r_[3 + np.arange(20) * 1e-7, np.linspace(4, 9, 20)],
    "far below single precision": np.r_[3 + np.arange(20) * 1e-11, np.linspace(4, 9, 20)],
    "equal": np.r_[np.full(20, 3.0), np.linspace(4, 9, 20)],
    "some zero": np.r_[np.zeros(20), np.linspace(4, 9, 20)],
    "three clusters": np.r_[1 + np.arange(9) * 1e-12, 2 + np.arange(9) * 1e-6, 7 + np.arange(9) * 1e-9],
    "identity": np.ones(8),
    "one": np.array([2.0]),
}


@pytest.mark.parametrize("name", CASES)
def test_eigenvectors_beyond_double_precision(name):
    values = np.sort(CASES[name].astype(WIDE))[::-1]
    a, _ = matrix(values)
    got, x, turns = whitening.eigen(a)
    size = np.abs(a).max()
    assert np.abs(got - values).max() < 1e-17 * size * len(a)
    assert np.abs(a @ x - x * got).max() < 1e-17 * size * len(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17
    assert turns <= whitening.ITERATIONS


def test_close_eigenvectors_are_told_apart():
    """Their directions follow the matrix, not the basis that single precision gave."""
    values = np.r_[5.0, 3 + 1e-9, 3.0, 1.0].astype(WIDE)
    a, basis = matrix(values, 4)
    _, x, _ = whitening.eigen(a)
    assert np.abs(np.abs(np.einsum("ij,ij->j", basis, x)) - 1).max() < 1e-15
    coarse = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert np.abs(np.abs(np.einsum("ij,ij->j", basis, coarse)) - 1).max() > 1e-9


def test_empty_matrices():
    values, x, _ = whitening.eigen(np.zeros((0, 0), WIDE))
    assert len(values) == 0 and x.shape == (0, 0)
    values, x, _ = whitening.eigen(np.zeros((3, 3), WIDE))
    assert (values == 0).all() and (x == np.eye(3)).all()


@pytest.mark.parametrize("reach", [1000, 1 << 22, 1 << 40])
def test_products_are_exact(reach):
    rng = random.Random(reach)
    z = [[rng.randint(-reach, reach) for _ in range(5)] for _ in range(700)]
    high, low = whitening.exact_product(np.array(z, np.int64))
    want = [[sum(r[i] * r[j] for r in z) for j in range(5)] for i in range(5)]
    assert ((high.astype(object) << 31) + low.astype(object)).tolist() == want


@pytest.mark.parametrize("partitions", [1, 7])
def test_moments_are_exact(spark, partitions):
    rows = whole(vectors())
    found = whitening.moments(
        whitening.whole_vectors(frame(spark, vectors()).repartition(partitions), 64, 1_000_000)
    )
    n, dims = len(rows), 12
    sums = [sum(v[d] for _, v in rows) for d in range(dims)]
    assert found.n == n and found.sums == sums
    spread = [
        [sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for _, v in rows) // n for j in range(dims)]
        for i in range(dims)
    ]
    assert found.spread.tolist() == spread


def test_whitened_is_numpy(spark):
    rows = whole(vectors())
    n, dims = len(rows), 12
    x = np.array([v for _, v in rows], float)
    centred = x - x.mean(0)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    want = centred @ (basis / np.sqrt(values))
    sums = [sum(v[d] for _, v in rows) for d in range(dims)]
    got = whitening.whitened(frame(spark, vectors()).repartition(5)).collect()
    assert len(got) == n * dims
    parts = {}
    for r in got:
        parts.setdefault(r["component"], []).append(r)
    assert sorted(parts) == list(range(1, dims + 1))
    for k, of in parts.items():
        assert sum(r["whitened"] for r in of) == pytest.approx(0, abs=1e-9)
        assert {r["n"] for r in of} == {n}
        assert of[0]["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
        ours = sorted((str(r["vec_id"]), round(abs(r["whitened"]), 6)) for r in of)
        theirs = sorted((str(i), round(abs(w), 6)) for (i, _), w in zip(rows, want[:, k - 1], strict=True))
        assert [a[0] for a in ours] == [b[0] for b in theirs]
        assert np.allclose([a[1] for a in ours], [b[1] for b in theirs], atol=2e-6)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    apart = sorted((str(i), sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in rows)
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in parts[1]) == apart


def test_signs_hold_for_all_rows(spark):
    got = whitening.whitened(frame(spark, vectors())).where("component <= 2")
    pairs = got.groupBy("vec_id").pivot("component", [1, 2]).agg(F.avg("whitened"))
    assert abs(pairs.agg(F.covar_pop("1", "2")).first()[0]) < 0.05


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((200, 3))
    wide = np.concatenate([base, base, np.zeros((200, 2))], axis=1)
    got = whitening.whitened(frame(spark, [(i, v.tolist()) for i, v in enumerate(wide)]))
    assert {r[0] for r in got.select("component").distinct().collect()} == {1, 2, 3}
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9


def test_odd_tables(spark):
    columns = queries.op13_whitened_vectors(spark, SF).columns
    for rows in ([], [(1, None)], [(1, [0.5] * 4)], [(i, [0.5] * 4) for i in range(9)]):
        got = whitening.whitened(frame(spark, rows))
        assert got.columns == columns and got.count() == 0
    one = whitening.whitened(frame(spark, [(1, [0.0]), (2, [1.0])])).collect()
    assert sorted((r["vec_id"], abs(r["whitened"])) for r in one) == [(1, 1.0), (2, 1.0)]
    for rows in ([(1, [0.5] * 4), (2, [0.5] * 5)], [(1, [1e30] * 4)]):
        with pytest.raises(ValueError):
            whitening.whitened(frame(spark, rows))


def test_whole_query(spark):
    got = queries.op13_whitened_vectors(spark, SF)
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert got.count() == 32 * n
    row = got.agg(F.max("identity_error"), F.sum("explained") / n, F.min("deviation")).first()
    assert row[0] < 1e-10 and 0 < row[1] <= 1 and row[2] > 0

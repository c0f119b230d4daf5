"""Codes of vectors against plain k-means steps, and the trie against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from gazette.llm import codes

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *(T.StructField(c, T.StringType()) for c in ("code", "x", "error", "of", "salt")),
    ]
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA)


def plain(rows, parts, entries, rounds, scale=256):
    """Codes, errors and codebooks by the definition, in Python's whole numbers."""
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    books = [[k[1][p * width : (p + 1) * width] for k in kept[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [k[1][p * width : (p + 1) * width] for k in kept]
            at = [near(part, book)[1] for part in own]
            for j in range(len(book)):
                some = [part for part, a in zip(own, at, strict=True) if a == j]
                if some:
                    book[j] = [sum(c) // len(some) for c in zip(*some, strict=True)]
    out, totals = [], {}
    for i, v, label in kept:
        found = [near(v[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((i, "".join(f"{j:02x}" for _, j in found), error, label))
        totals[label] = totals.get(label, 0) + error
    text = ",".join(str(c) for book in books for e in book for c in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, totals[k], sha) for i, c, e, k in out), key=str)


def vectors(n, dims=32, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # few values, so that parts repeat, share prefixes and lie equally near
        v = [rng.choice([-0.5, -0.25, 0.0, 0.125, 0.25]) for _ in range(dims)]
        rows.append((i, v, rng.choice([0, 0, 0, 1, None])))
    rows += [(7, rows[9 % n][1], 1), (7, rows[3][1], 0), (None, rows[4][1], 1), (n, None, 1)]
    rows += [(n + 1, [None] + [0.1] * (dims - 1), 1), (n + 2, [math.nan] + [0.1] * (dims - 1), 0)]
    rows += [(n + 3, [-math.inf] + [0.1] * (dims - 1), 0), *rows[:3]]
    return rows


@pytest.mark.parametrize(("n", "entries"), [(200, 12), (5, 64)])
def test_compressed_is_brute_force(spark, n, entries, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_VECTORS", 37)
    monkeypatch.setattr(codes, "SUBTREE", 5)
    rows = vectors(n)
    got = codes.compressed(frame(spark, rows).repartition(3), 16, entries, 2)
    want = plain(rows, 16, entries, 2)
    assert sorted(map(tuple, got.collect()), key=str) == want


@pytest.mark.parametrize("subtree", [1, 4, 100, 10_000])
def test_trie_is_all_distances(subtree, monkeypatch):
    monkeypatch.setattr(codes, "SUBTREE", subtree)
    rng = np.random.default_rng(1)
    parts = np.unique(rng.integers(-4, 4, (900, 4)), axis=0)
    book = rng.integers(-4, 4, (20, 4))
    trie = codes.Trie(parts, book)
    all_of = ((parts[:, None] - book[None]) ** 2).sum(2)
    assert (trie.nearest == all_of.argmin(1)).all() and (trie.distance == all_of.min(1)).all()
    prefixes = sum(len(np.unique(parts[:, :d], axis=0)) for d in range(1, 5))
    # a prefix is shared; only one that a cut between subtrees divides is worked out again
    assert prefixes <= trie.nodes <= prefixes + 4 * (1 + 2 * len(parts) // subtree)
    if subtree >= len(parts):
        assert trie.nodes == prefixes < parts.size


def test_sums_are_weighted_by_repeats():
    parts = np.array([[1, 1], [5, 5], [1, 1], [0, 1], [1, 1]])
    near, apart, totals = codes.assigned(parts, np.array([[1, 1], [5, 6], [1, 1]]))
    assert near.tolist() == [0, 1, 0, 0, 0] and apart.tolist() == [0, 1, 0, 1, 0]
    assert totals.tolist() == [[3, 4, 4], [5, 5, 1], [0, 0, 0]]
    assert codes.moved(np.array([[9, 9], [9, 9], [-7, 9]]), totals).tolist() == [[0, 1], [5, 5], [-7, 9]]
    # floors go down
    assert codes.moved(np.array([[0, 0]]), np.array([[-3, 3, 2]])).tolist() == [[-2, 1]]


def test_decoded_is_as_far_as_the_error(spark):
    df = frame(spark, vectors(60))
    whole = codes.whole_vectors(df, 256)
    books = codes.fit(whole, 8, 10, 2)
    back = codes.decoded(codes.coded(whole, books), books).collect()
    exact = {}
    for r in whole.collect():
        exact.setdefault(r["vec_id"], []).append(np.array(r["x"]))
    for r in back:
        apart = [((v - 256 * np.array(r["embedding"])) ** 2).sum() for v in exact[r["vec_id"]]]
        assert r["error"] in [round(a) for a in apart]


def test_odd_tables(spark):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    for rows in ([], [(1, None, 0)]):
        empty = codes.compressed(frame(spark, rows))
        assert empty.columns == columns and empty.count() == 0
    same = codes.compressed(frame(spark, [(i, [0.5] * 16, None) for i in range(100)])).collect()
    assert {r["code"] for r in same} == {"00" * 16} and {r["label_error"] for r in same} == {0}
    for rows in ([(1, [0.1] * 17, 0)], [(1, [0.1] * 16, 0), (2, [0.1] * 32, 0)], [(1, [1e30] * 16, 0)]):
        with pytest.raises(ValueError):
            codes.compressed(frame(spark, rows))

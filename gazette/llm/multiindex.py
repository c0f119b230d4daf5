"""Embedding near-dedup with an inverted multi-index.

The halves of each vector have a codebook each; a pair of centroids is a cell
of the grid. A vector stands in the cell of its nearest centroids, and asks the
cells nearest to it, in the order of the multi-sequence traversal, as many as
reach the target recall at the threshold. Vectors met in a cell are verified by
their exact cosine. Equal vectors are merged first, crowded cells are dealt in
blocks, and links leave a task as a forest and as counts, never as all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.chunks import ids_of
from gazette.llm.components import smallest_reachable
from gazette.llm.simhash import forest
from gazette.session import shared_dir

#: At most this many vectors are fetched to fit the codebooks and the traversal.
SAMPLE = 16_384
CELL_ROWS = 32
BLOCK_ROWS = 1024
TASK_ROWS = 50_000
VALID = "vec_id long, label int, sign binary, embedding array<{}>"


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat components, offsets, and which lists can be compared."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    sizes = np.asarray(column.value_lengths().fill_null(0))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    # a null component has become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    full = np.concatenate(([0], np.cumsum(values != 0)))
    ends, starts = offsets[1:], offsets[:-1]
    return values, offsets, (bad[ends] == bad[starts]) & (full[ends] > full[starts])


def _comparable(kind: str):
    """Rows that can be linked, with a signature of label and components (float or double)."""
    exact = {"float": "<f4", "double": "<f8"}[kind]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets, good = _vectors(batch.column(2))
            good &= np.asarray(batch.column(0).is_valid()) & np.asarray(batch.column(1).is_valid())
            rows = np.flatnonzero(good)
            labels = batch.column(1).to_pylist()
            values = values.astype(exact) + np.zeros(1, exact)  # one zero only
            signs = [
                hashlib.blake2b(
                    b"%d:" % labels[i] + values[offsets[i] : offsets[i + 1]].tobytes(), digest_size=16
                ).digest()
                for i in rows
            ]
            own = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.array(signs, pa.binary()), own.column(2)],
                ["vec_id", "label", "sign", "embedding"],
            )

    return signed


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)


def _centres(rows: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(rows, centres).argmin(1)
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


@dataclass
class MultiIndex:
    """Codebooks of the two halves, and how many cells a vector asks."""

    left: np.ndarray
    right: np.ndarray
    visits: int = 1

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.left.shape[1]
        return _distances(unit[:, :at], self.left), _distances(unit[:, at:], self.right)

    def home(self, unit: np.ndarray) -> np.ndarray:
        left, right = self.halves(unit)
        return left.argmin(1) * len(self.right) + right.argmin(1)

    def rank(self, unit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The cells that the traversal of each vector meets before the given one."""
        left, right = self.halves(unit)
        out = np.empty(len(unit), np.int64)
        for v, (x, y) in enumerate(zip(left, right, strict=True)):
            a, b = divmod(int(cells[v]), len(y))
            # rows of the grid are counted in the sorted other half, none is listed
            limit = x[a] + y[b] - x
            limit[a] = y[b]
            out[v] = np.searchsorted(np.sort(y), limit, side="left").sum()
        return out

    def nearest(self, unit: np.ndarray, visits: int) -> np.ndarray:
        """The first cells of the multi-sequence traversal of each vector.

        A cell of the i-th and j-th nearest centroids comes after all i * j cells
        of nearer ones, so only those with i * j <= visits can be among the first.
        """
        left, right = self.halves(unit)
        by_left, by_right = left.argsort(1, kind="stable"), right.argsort(1, kind="stable")
        i = np.arange(min(left.shape[1], visits))
        widths = np.minimum(visits // (i + 1), right.shape[1])
        i = np.repeat(i, widths)
        j = np.arange(len(i)) - np.repeat(np.cumsum(widths) - widths, widths)
        a, b = by_left[:, i], by_right[:, j]
        total = np.take_along_axis(left, a, 1) + np.take_along_axis(right, b, 1)
        first = total.argsort(1, kind="stable")[:, :visits]
        return np.take_along_axis(a * right.shape[1] + b, first, 1)


def fit(sample: np.ndarray, rows: int, threshold: float, recall: float) -> MultiIndex:
    """An index for `rows` vectors of one label from a sample of any.

    The number of visits is the rank, in the traversal of sampled vectors, of the
    cell of a random neighbour just at the threshold, at the target recall.
    """
    unit = _unit(sample)
    k = min(len(unit), max(2, math.isqrt(max(1, rows // CELL_ROWS))))
    at = max(1, unit.shape[1] // 2)
    index = MultiIndex(_centres(unit[:, :at], k), _centres(unit[:, at:], k))
    tried = unit[:2048]
    turn = np.random.default_rng(0).standard_normal(tried.shape)
    turn -= (turn * tried).sum(1, keepdims=True) * tried
    length = np.linalg.norm(turn, axis=1, keepdims=True)
    turn = np.divide(turn, length, out=np.zeros_like(turn), where=length > 1e-9)
    near = _unit(threshold * tried + math.sqrt(1 - threshold**2) * turn)
    ranks = index.rank(tried, index.home(near))
    index.visits = min(k * k, int(np.quantile(ranks, recall, method="higher")) + 1)
    return index


def linked(
    embeddings: DataFrame, threshold: float = 0.98, recall: float = 0.99, sample: int = SAMPLE
) -> DataFrame:
    """Links between vectors (vec_id, embedding, label) of one label by cosine.

    Returns vec_id, n_links (other vectors linked directly, equal ones included),
    component_id (smallest vec_id reachable) and kept (it is its own). Vectors
    that are null, zero or hold null or non-finite components, or whose vec_id or
    label is null, link with nothing, nor do vectors of different lengths. Rows
    with one vec_id are separate vectors (a component's id is the smallest vec_id of its
    vectors). Components are compared as given, float or double. Other columns are not read. The index is
    fitted on `sample` vectors at most, chosen by a hash; every vector is indexed.
    """
    shared_dir(embeddings.sparkSession)
    given = embeddings.schema["embedding"].dataType
    kind = "float" if given == T.ArrayType(T.FloatType(), given.containsNull) else "double"
    rows = embeddings.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("int"),
        F.col("embedding").cast(f"array<{kind}>"),
    )
    signed = rows.mapInArrow(_comparable(kind), VALID.format(kind))
    merged = (
        signed.groupBy("sign")
        .agg(
            F.min("vec_id").alias("least"),
            F.count("*").alias("copies"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("size", F.size("embedding"))
        # numbered by their smallest vec_id, so that the smallest node has the smallest id
        .orderBy("least", "sign")
        .withColumn("node", F.monotonically_increasing_id())
        .checkpoint()
    )
    indexes = {}
    for size, count in _sizes(merged):
        some = merged.where(F.col("size") == size).orderBy(F.xxhash64("sign"), "sign").limit(sample)
        taken = some.select("embedding").toArrow()["embedding"].combine_chunks()
        vectors = _vectors(taken)[0].reshape(-1, size)
        indexes[size] = fit(vectors, count, threshold, recall)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once as a member of its cell, and once for each cell it asks."""
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, len(b), 1000)):
            sizes = np.asarray(batch["size"])
            values, offsets, _ = _vectors(batch["embedding"])
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                index = indexes[int(size)]
                unit = _unit(values[offsets[own][:, None] + np.arange(size)])
                home = index.home(unit)
                asked = np.concatenate(
                    [home[:, None], index.nearest(unit, index.visits)], 1
                )
                # the home cell is always asked, once
                asked[:, 1:][asked[:, 1:] == home[:, None]] = -1
                row, column = np.nonzero(asked >= 0)
                at = np.concatenate([own, own[row]])
                base = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([0, 1], [len(own), len(row)]), pa.int32()),
                        base["label"],
                        base["size"],
                        pa.array(np.concatenate([home, asked[row, column]]), pa.int64()),
                        base["node"],
                        base["copies"],
                        base["embedding"],
                    ],
                    ["asks", "label", "size", "cell", "node", "copies", "embedding"],
                )

    columns = f"label int, size int, cell long, node long, copies long, embedding array<{kind}>"
    source = merged.select("label", "size", "node", "copies", "embedding")
    stands = source.mapInArrow(dealt, f"asks int, {columns}")
    cell = ["label", "size", "cell"]
    crowded = (
        stands.groupBy(*cell)
        .agg(F.sum(1 - F.col("asks")).alias("members"), F.sum("asks").alias("queries"))
        .where(F.greatest("members", "queries") > BLOCK_ROWS)
        .select(
            *cell,
            F.ceil(F.col("members") / BLOCK_ROWS).alias("m"),
            F.ceil(F.col("queries") / BLOCK_ROWS).alias("q"),
        )
        .checkpoint()
    )
    stands = stands.join(crowded, cell, "left").na.fill(1, ["m", "q"])
    asks = F.col("asks") == 1
    own_parts, other_parts = F.when(asks, F.col("q")).otherwise(F.col("m")), F.when(
        asks, F.col("m")
    ).otherwise(F.col("q"))
    stands = (
        stands.withColumn("own", F.pmod(F.xxhash64("node"), own_parts))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), other_parts - 1)))
        .withColumn("m", F.when(asks, F.col("other")).otherwise(F.col("own")))
        .withColumn("q", F.when(asks, F.col("own")).otherwise(F.col("other")))
    )
    visits = max((i.visits for i in indexes.values()), default=1)
    tasks = max(8, math.ceil(merged.count() * (1 + visits) / TASK_ROWS))
    stands = stands.withColumn("task", F.pmod(F.xxhash64(*cell, "m", "q"), F.lit(tasks)))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _compare(table, threshold)

    found = (
        stands.select("task", "asks", *cell, "m", "q", "node", "copies", "embedding")
        .groupBy("task")
        .applyInArrow(compare, "a long, b long, n long")
        .checkpoint()
    )
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    reach = smallest_reachable(found.where("b is not null").select("a", "b"))
    roots = merged.select(F.col("node").alias("root"), F.col("least").alias("root_id"))
    reach = reach.join(roots, F.col("component") == F.col("root")).select("node", "root_id")
    nodes = (
        merged.select("sign", "node", "copies", "least")
        .join(counts, merged["node"] == counts["a"], "left")
        .join(reach.withColumnRenamed("node", "v"), F.col("node") == F.col("v"), "left")
        .select(
            "sign",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root_id", "least").alias("component_id"),
        )
        .checkpoint()
    )
    good = signed.select("vec_id", "sign").join(nodes, "sign").drop("sign")
    bad = rows.mapInArrow(_others, "vec_id long").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _sizes(merged: DataFrame) -> list[tuple[int, int]]:
    """Lengths of the vectors, with the rows of their largest label."""
    by_label = merged.groupBy("size", "label").count()
    return [tuple(r) for r in by_label.groupBy("size").agg(F.max("count")).collect()]


def _others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that _comparable leaves out."""
    for batch in batches:
        good = _vectors(batch.column(2))[2]
        good &= np.asarray(batch.column(0).is_valid()) & np.asarray(batch.column(1).is_valid())
        own = batch.take(pa.array(np.flatnonzero(~good)))
        yield pa.RecordBatch.from_arrays([own.column(0)], ["vec_id"])


def _pairs(near: np.ndarray, rows: np.ndarray, columns: np.ndarray):
    """The pairs of a block, some rows at a time, so that a dense one stays small."""
    for first in range(0, len(rows), 64):
        i, j = np.nonzero(near[first : first + 64])
        if len(i):
            yield rows[first + i], columns[j]


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """Counts (a, n) and a forest of links (a, b) from the blocks of one task."""
    names = ["label", "size", "cell", "m", "q"]
    keys = [table[n].to_numpy() for n in names]
    asks = table["asks"].to_numpy()
    node, copies = ids_of(table["node"]), table["copies"].to_numpy()
    values, offsets, _ = _vectors(table["embedding"])
    order = np.lexsort((asks, *keys))
    change = np.zeros(len(order), bool)
    change[:1] = True
    for key in keys:
        change[1:] |= key[order][1:] != key[order][:-1]
    edges = np.append(np.flatnonzero(change), len(order))
    counted, links = [], []
    for a, b in zip(edges, edges[1:], strict=False):
        unit = order[a:b]
        split = a + np.count_nonzero(asks[unit] == 0)
        members, queries = order[a:split], order[split:b]
        if not len(members) or not len(queries):
            continue
        step = np.arange(int(keys[1][unit[0]]))
        left = _unit(values[offsets[queries][:, None] + step])
        right = _unit(values[offsets[members][:, None] + step])
        near = left @ right.T >= threshold
        near &= node[queries][:, None] != node[members]
        if not near.any():
            continue
        total = near @ copies[members]
        some = np.flatnonzero(total)
        counted.append((node[queries[some]], total[some]))
        ids, place = np.unique(np.concatenate([node[queries], node[members]]), return_inverse=True)
        root = forest(len(ids), _pairs(near, place[: len(queries)], place[len(queries) :]))
        moved = np.flatnonzero(root != np.arange(len(ids)))
        links.append((ids[moved], ids[root[moved]]))
    none = np.zeros(0, np.int64)
    a, n = (np.concatenate(c) for c in zip(*counted, strict=True)) if counted else (none, none)
    x, y = (np.concatenate(c) for c in zip(*links, strict=True)) if links else (none, none)
    return pa.table(
        {
            "a": pa.array(np.concatenate([a, x]), pa.int64()),
            "b": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(y, pa.int64())]),
            "n": pa.concat_arrays([pa.array(n, pa.int64()), pa.nulls(len(x), pa.int64())]),
        }
    )

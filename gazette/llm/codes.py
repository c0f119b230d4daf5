"""Vectors as codes of their parts, assigned along a trie of the distinct parts.

Components become whole numbers; a vector is cut into equal parts, and every
place of a part has its own codebook. To assign parts, the distinct ones of a
block are sorted and seen as a trie whose levels are the dimensions of the part.
A node's vector of distances to all entries is that of its parent plus one
dimension, so parts with a common prefix share it; it is worked out depth first,
one subtree of bounded size after the other. A leaf takes the nearest entry and
adds its components to it as often as the part occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.session import run_dir

#: Vectors whose parts share a trie, and leaves that a subtree may have at once.
BLOCK_VECTORS, SUBTREE = 1 << 15, 1 << 12
#: Components may not be larger, so that every sum of squares fits 64 bits.
LARGEST = 1 << 24
#: Rows of one label are joined in so many groups.
SALT = 32
VALID = "vec_id long, label int, part_values binary"
CODED = "vec_id long, label int, code binary, error long"


class Trie:
    """Distances and nearest entries of sorted distinct parts.

    parts: (n, dims) whole numbers in lexicographic order, without repeats.
    book: (entries, dims). `nodes` counts the vectors of distances that were
    worked out, one for each distinct prefix of a subtree.
    """

    def __init__(self, parts: np.ndarray, book: np.ndarray):
        self.parts, self.book, self.nodes = parts, book, 0
        n, dims = parts.shape
        self.nearest, self.distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
        #: begins[d][i]: part i has another prefix of d + 1 values than the part before
        self.begins = np.ones((dims, n), bool)
        if n:
            self.begins[:, 1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1).T
            self._descend(0, 0, n, np.zeros(len(book), np.int64))

    def _step(self, depth: int, values: np.ndarray, above: np.ndarray) -> np.ndarray:
        self.nodes += len(values)
        return above + (values[:, None] - self.book[:, depth]) ** 2

    def _descend(self, depth: int, first: int, last: int, above: np.ndarray) -> None:
        """The leaves first to last, which share the prefix whose distances are `above`."""
        dims = self.parts.shape[1]
        if last - first <= SUBTREE or depth == dims:
            self._level_by_level(depth, first, last, above)
            return
        starts = first + np.flatnonzero(self.begins[depth, first:last])
        starts[0] = first
        ends = np.append(starts[1:], last)
        sizes, at = ends - starts, 0
        while at < len(starts):
            # children that are small together make one subtree of their parent
            stop = at + 1
            while stop < len(starts) and sizes[at : stop + 1].sum() <= SUBTREE:
                stop += 1
            if stop == at + 1 and sizes[at] > SUBTREE:
                own = self._step(depth, self.parts[starts[at] : starts[at] + 1, depth], above)[0]
                self._descend(depth + 1, starts[at], ends[at], own)
            else:
                self._level_by_level(depth, starts[at], ends[stop - 1], above)
            at = stop

    def _level_by_level(self, depth: int, first: int, last: int, above: np.ndarray) -> None:
        node, known = np.zeros(last - first, np.int64), above[None, :]
        for d in range(depth, self.parts.shape[1]):
            new = self.begins[d, first:last].copy()
            new[0] = True
            starts = np.flatnonzero(new)
            known = self._step(d, self.parts[first + starts, d], known[node[starts]])
            node = np.cumsum(new) - 1
        best = known.argmin(1)  # the lowest index of equal ones
        self.nearest[first:last] = best[node]
        self.distance[first:last] = known[np.arange(len(best)), best][node]


def assigned(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry and distance of each part, and per entry the sums and count of its parts.

    parts: (n, dims), in any order and with repeats. The last array has one row
    per entry: dims sums, then the count.
    """
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(1)
    starts = np.flatnonzero(new)
    distinct, times = ranked[starts], np.diff(np.append(starts, len(parts)))
    back = np.empty(len(parts), np.int64)
    back[order] = np.cumsum(new) - 1
    trie = Trie(distinct, book)
    totals = np.zeros((len(book), parts.shape[1] + 1), np.int64)
    weighted = np.concatenate([distinct * times[:, None], times[:, None]], axis=1)
    np.add.at(totals, trie.nearest, weighted)
    return trie.nearest[back], trie.distance[back], totals


def moved(book: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Each entry at the floor of the mean of its parts; unused ones stay."""
    used = totals[:, -1] > 0
    means = totals[:, :-1] // np.maximum(totals[:, -1:], 1)
    return np.where(used[:, None], means, book)


def whole_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and the components as whole numbers floor(scale * x).

    Rows whose embedding is null or holds null or non-finite components are left out.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("int"),
        F.col("embedding").cast("array<double>"),
    )
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    kept = rows.where(F.coalesce(usable, F.lit(False)))
    # far beyond what is refused later, so that nothing overflows before
    end = F.lit(4.0 * LARGEST)
    scaled = F.transform("embedding", lambda x: F.greatest(F.least(x * F.lit(float(scale)), end), -end))
    return kept.select("vec_id", "label", F.transform(scaled, lambda x: F.floor(x)).alias("x"))


def _first(whole: DataFrame, entries: int) -> np.ndarray:
    """The vectors with the smallest vec_ids (null last), equal ids by components."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    taken = [r["x"] for r in whole.select("vec_id", "x").orderBy(*order).limit(entries).collect()]
    return np.array(taken, np.int64).reshape(len(taken), len(taken[0]) if taken else 0)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    """ids, labels and components of some vectors at a time."""
    waiting: list[pa.RecordBatch] = []

    def joined():
        table = pa.Table.from_batches(waiting).combine_chunks()
        lists = table["x"].combine_chunks()
        values = lists.flatten().to_numpy().astype(np.int64).reshape(-1, dims)
        return table["vec_id"], table["label"], values

    for batch in batches:
        for i in range(0, len(batch), BLOCK_VECTORS):
            piece = batch.slice(i, BLOCK_VECTORS)
            if sum(map(len, waiting)) + len(piece) > BLOCK_VECTORS:
                yield joined()
                waiting = []
            waiting.append(piece)
    if any(map(len, waiting)):
        yield joined()


def _totals(whole: DataFrame, books: list[np.ndarray], dims: int) -> np.ndarray:
    """Sums and counts per place of a part and entry, over all vectors."""
    places, width = len(books), books[0].shape[1]

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((places, len(books[0]), width + 1), np.int64)
        for _, _, values in _blocks(batches, dims):
            for p, book in enumerate(books):
                sums[p] += assigned(values[:, p * width : (p + 1) * width], book)[2]
        flat = sums.reshape(-1)
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(flat[used], pa.int64())], ["at", "n"]
        )

    found = whole.mapInArrow(act, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(places * len(books[0]) * (width + 1), np.int64)
    flat[found["at"].to_numpy()] = found["n"].to_numpy()
    return flat.reshape(places, len(books[0]), width + 1)


class Codebooks:
    """One array (entries, dims of a part) for each place of a part."""

    def __init__(self, books: list[np.ndarray], dims: int):
        self.books, self.dims = books, dims

    def sha256(self) -> str:
        text = ",".join(str(v) for book in self.books for v in book.reshape(-1).tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def fit(whole: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks of whole vectors (vec_id, x): the first vectors, moved in each round.

    All vectors have the length of the first one, a multiple of `parts`; others
    are an error. The driver holds the codebooks and, in a round, one sum for
    each of their components.
    """
    books = _first(whole, entries)
    dims = books.shape[1]
    if len(books) and (dims == 0 or dims % parts):
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    split = np.split(books, parts, axis=1) if len(books) else []
    for _ in range(rounds if split else 0):
        totals = _totals(whole, split, dims)
        split = [moved(book, t) for book, t in zip(split, totals, strict=True)]
    return Codebooks(split, dims)


def coded(whole: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (one byte per part) and error of each vector, in the scan."""
    split, dims = books.books, books.dims
    width = dims // len(split) if split else 0

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, values in _blocks(batches, dims):
            code = np.zeros((len(values), len(split)), np.uint8)
            error = np.zeros(len(values), np.int64)
            for p, book in enumerate(split):
                near, apart, _ = assigned(values[:, p * width : (p + 1) * width], book)
                code[:, p] = near
                error += apart
            flat = code.tobytes()
            step = len(split)
            pieces = [flat[i : i + step] for i in range(0, len(flat), step)]
            yield pa.RecordBatch.from_arrays(
                [ids.combine_chunks(), labels.combine_chunks(), pa.array(pieces, pa.binary()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return whole.mapInArrow(act, CODED)


def decoded(codes: DataFrame, books: Codebooks, scale: int = 256) -> DataFrame:
    """codes with the vector that each code stands for, as `embedding`."""
    step = len(books.books)
    entries = np.stack(books.books, 1) if step else np.zeros((0, 0, 0), np.int64)

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, step)
            values = entries[code, np.arange(step)].reshape(len(code), -1) / scale
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.reshape(-1)), books.dims)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists.cast(pa.list_(pa.float64()))],
                [*batch.schema.names, "embedding"],
            )

    schema = ", ".join(f"`{c}` {kind}" for c, kind in codes.dtypes)
    return codes.mapInArrow(act, f"{schema}, embedding array<double>")


def compressed(
    embeddings: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
) -> DataFrame:
    """Codes of vectors (vec_id, embedding, label) by codebooks fitted on all of them.

    Returns vec_id, code (hex, two digits a part), error (squared distance of the
    whole vector to what its code stands for), label_error (its sum over the rows
    of one label, nulls together) and codebooks_sha256. Rows whose embedding is
    null or holds null or non-finite components are dropped; a null vec_id comes
    after all others. Rows that share a vec_id are separate vectors. Fewer vectors
    than entries make smaller codebooks; an empty table gives no rows. Ties go to
    the entry with the lower index. Vectors of different lengths, of a length that
    cannot be cut, or with components of LARGEST or more are an error. Other
    columns are not read.

    The table is scanned once for the first entries, once a round and once for the
    codes; only sums per entry are shuffled. Codes are written to the shared folder.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte, so 1 to 256 entries")
    spark = embeddings.sparkSession
    whole = whole_vectors(embeddings, scale)
    sizes = whole.agg(
        F.min(F.size("x")), F.max(F.size("x")),
        F.max(F.aggregate("x", F.lit(0).cast("long"), lambda m, v: F.greatest(m, v, -v))),
    ).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} components")
    if (sizes[2] or 0) >= LARGEST:
        raise ValueError(f"a component is {sizes[2]}, {LARGEST} or more after scaling")
    books = fit(whole, parts, entries, rounds)
    path = f"{run_dir(spark, 'codes')}/coded"
    coded(whole, books).write.parquet(path)
    codes = spark.read.parquet(path)
    # one label may hold most rows: its sum meets them in several groups
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    salted = sums.select(
        F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    )
    group = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALT)).cast("int")
    joined = codes.join(salted, F.col("label").eqNullSafe(F.col("of")) & (group == F.col("salt")))
    return joined.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )

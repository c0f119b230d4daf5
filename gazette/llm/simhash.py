"""SimHash near-dedup: fingerprints of word shingles, searched by pivot distances.

Fingerprints within `radius` bits agree in at least two of radius + 2 blocks of
their bits, so each pair of blocks is a table whose keys deal fingerprints to
tasks without losing a link. In a key, Hamming distances to fixed reference
fingerprints (pivots) are coordinates: a pair whose coordinates differ by more
than `radius` anywhere is discarded, the survivors are verified. Crowded keys
are dealt further by a grid of their pivot distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.llm.chunks import as_ids, ids_of, spread, string_parts
from gazette.llm.components import smallest_reachable
from gazette.llm.hashing import mix
from gazette.session import shared_dir

SEED = 42
PIVOTS = mix(np.arange(1, 17, dtype=np.uint64))
#: Rows of a key that are compared together; more are dealt by the grid.
CROWDED = 1024
GRID_PIVOTS, GRID_STEP = 6, 4
#: Rows that one task searches, about.
SEARCH_ROWS = 50_000
_SLICE = 1 << 16


def fingerprint(text: bytes, size: int) -> int:
    """Bits set in over half of the hashes of the shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    first, last = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for i in range(0, len(first), _SLICE):
        hashes = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(first[i : i + _SLICE], last[i : i + _SLICE], strict=True)]
        )
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, rows: bool = False) -> DataFrame:
    """doc_id and fingerprint (long, signed) of each row of (doc_id, text).

    With `rows` a third column, row, holds all columns as given.
    """

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = string_parts(batch.column(1))
            data = memoryview(body)
            marks = [
                fingerprint(bytes(data[a:b]), size)
                for a, b in zip(offsets, offsets[1:], strict=False)
            ]
            signed = np.array(marks, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [as_ids(ids_of(batch.column(0))), pa.array(signed), *batch.columns[2:]],
                ["doc_id", "fingerprint", *batch.schema.names[2:]],
            )

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    schema = T.StructType().add("doc_id", "long").add("fingerprint", "long")
    if rows:
        columns.append(F.struct(*docs.columns).alias("row"))
        schema = schema.add("row", docs.schema)
    return docs.select(*columns).mapInArrow(act, schema)


def pivot_distances(marks: np.ndarray, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    return np.bitwise_count(marks[:, None] ^ pivots).astype(np.int16)


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest number that each of n nodes reaches over the pairs."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            apart = label[a] != label[b]
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            low = np.minimum(label[a], label[b])
            high = np.maximum(label[a], label[b])
            np.minimum.at(label, high, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def close_pairs(key: np.ndarray, marks: np.ndarray, radius: int):
    """Pairs of rows with one key (rows sorted by it) whose fingerprints are close."""
    table = pivot_distances(marks)
    order = np.lexsort((table[:, 0], key))
    key, marks, table = key[order], marks[order], table[order]
    left = np.arange(len(key))
    for step in range(1, len(key)):
        left = left[left + step < len(key)]
        right = left + step
        # rows are sorted by key and first coordinate: what lies further is further
        left = left[(key[left] == key[right]) & (table[right, 0] - table[left, 0] <= radius)]
        if not len(left):
            return
        a = left
        for p in range(1, len(PIVOTS)):
            a = a[np.abs(table[a, p] - table[a + step, p]) <= radius]
        a = a[np.bitwise_count(marks[a] ^ marks[a + step]) <= radius]
        if len(a):
            yield order[a], order[a + step]


def links(marks: DataFrame, radius: int = 2) -> DataFrame:
    """Links a, b between distinct fingerprints (column fingerprint), a forest per key.

    Every two fingerprints within `radius` bits are connected by the result, which
    holds no more rows than the tables.
    """
    blocks = np.array_split(np.arange(64), radius + 2)
    tables = list(combinations(range(radius + 2), 2))
    masks = [sum(1 << int(b) for i in pair for b in blocks[i]) for pair in tables]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            keys = [
                mix((own & np.uint64(m)) + np.uint64(i)) ^ np.uint64(i) for i, m in enumerate(masks)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.tile(own, len(masks)).view(np.int64)),
                ],
                ["key", "fingerprint"],
            )

    rows = marks.select("fingerprint").mapInArrow(keyed, "key long, fingerprint long")
    crowded = rows.groupBy("key").count().where(F.col("count") > CROWDED).select("key")
    crowded = crowded.checkpoint()
    single = rows.join(crowded, "key", "left_anti")
    several = rows.join(crowded, "key", "left_semi").mapInArrow(
        lambda batches: _gridded(batches, radius), "key long, fingerprint long"
    )
    count = marks.count() * len(masks)
    n = max(32, -(-count // SEARCH_ROWS))

    def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = spread(mix(batch.column(0).to_numpy().view(np.uint64)), n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int32()), *batch.columns], ["bucket", "key", "fingerprint"]
            )

    def search(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy()
        own = table["fingerprint"].to_numpy().view(np.uint64)
        root = forest(len(key), close_pairs(key, own, radius))
        moved = np.flatnonzero(root != np.arange(len(key)))
        return pa.table(
            {
                "a": pa.array(own[moved].view(np.int64)),
                "b": pa.array(own[root[moved]].view(np.int64)),
            }
        )

    dealt = single.unionByName(several).mapInArrow(
        bucketed, "bucket int, key long, fingerprint long"
    )
    return dealt.groupBy("bucket").applyInArrow(search, "a long, b long")


def _gridded(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows under a key of their cell in the grid of pivot distances.

    A row stands in the cells of its distances and of those up to `radius` larger,
    so two rows whose distances differ by no more meet in the upper one's cell.
    """
    for batch in batches:
        own = batch.column(1).to_numpy().view(np.uint64)
        distances = pivot_distances(own, PIVOTS[:GRID_PIVOTS])
        row, cell = np.arange(len(own)), mix(batch.column(0).to_numpy().view(np.uint64))
        for p in range(GRID_PIVOTS):
            low = distances[row, p] // GRID_STEP
            high = (distances[row, p] + radius) // GRID_STEP
            more = np.flatnonzero(high > low)
            level = np.concatenate([low, high[more]]).astype(np.uint64)
            row, cell = np.concatenate([row, row[more]]), np.concatenate([cell, cell[more]])
            cell = mix(cell + level + np.uint64(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell.view(np.int64)), pa.array(own[row].view(np.int64))],
            ["key", "fingerprint"],
        )


def groups(own: DataFrame, radius: int = 2) -> DataFrame:
    """The group of each distinct fingerprint of rows (doc_id, fingerprint).

    Returns fingerprint, first (smallest doc_id with it), root (the group's smallest
    fingerprint as a signed number) and component_id (the group's smallest doc_id).
    """
    marks = own.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).checkpoint()
    reach = smallest_reachable(links(marks, radius))
    linked = marks.join(reach, marks["fingerprint"] == reach["node"])
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    moved = linked.join(least, "component").select("fingerprint", "component", "least")
    return (
        marks.join(moved, "fingerprint", "left")
        .select(
            "fingerprint",
            "first",
            F.coalesce("component", "fingerprint").alias("root"),
            F.coalesce("least", "first").alias("component_id"),
        )
        .checkpoint()
    )


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """The group of near copies of each document (doc_id, text).

    Returns doc_id, fingerprint (16 hex digits) and component_id: the smallest
    doc_id reachable over fingerprints at `radius` or fewer differing bits, itself
    included. Shingles are `size` words of the text with A-Z in lower case; a
    shorter text is one shingle, a text without words (or null) has fingerprint 0
    and is linked like any other. A null doc_id is never the smallest; a group of
    such rows alone has a null component_id. Rows with one doc_id are separate
    rows. Other columns are not read.
    """
    shared_dir(docs.sparkSession)
    own = fingerprints(docs, size).checkpoint()
    roots = groups(own, radius).select("fingerprint", "component_id")
    return own.join(roots, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each_group(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """The documents, all columns, that stay when one of each group of near copies does.

    Groups are those of `near_duplicates`. The row with the smallest doc_id stays, a
    null one only where the group has no other; of rows with that doc_id the one with
    the smallest fingerprint, then text. Texts without words are one group, and so is
    a repeated row: of rows equal in doc_id and text any one stays. Rows with one
    doc_id in two groups are judged apart.
    """
    shared_dir(docs.sparkSession)
    marked = groups(fingerprints(docs, size).checkpoint(), radius)
    order = F.struct(F.col("first").isNull(), "first", "fingerprint")
    chosen = marked.groupBy("root").agg(F.min_by("fingerprint", order).alias("fingerprint"))
    # the group limit leaves a task one row of a fingerprint before the shuffle
    by = Window.partitionBy("fingerprint").orderBy(F.asc_nulls_last("doc_id"), "row.text")
    rows = fingerprints(docs, size, rows=True).withColumn("place", F.row_number().over(by))
    kept = rows.where("place = 1").join(chosen.select("fingerprint"), "fingerprint", "left_semi")
    return kept.select("row.*")

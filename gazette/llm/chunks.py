"""Texts dealt to chunks, and questions that chunks ask of hash buckets.

A chunk holds some megabytes of texts. It sends the sorted, distinct hashes of
what it holds to buckets, which own a range of hash values each; a bucket meets
the hashes of all chunks and answers every chunk, one value for each hash in
the order sent. So a hash costs a few bytes in the shuffle instead of a row, a
chunk sends a hash once however often it holds it, and no bucket grows with the
copies of one text. Texts are shuffled once: all steps of a plan share the
exchange of the packed chunks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.hashing import mix

CHUNK_BYTES = 8 << 20
NO_ID = -(1 << 63)
#: Bytes of a hash that are sent; its bucket follows from other bits.
KEY_BYTES = 6
PACKED = "chunk int, payload binary"
MESSAGE = "bucket int, chunk int, body binary"
REPLY = "chunk int, bucket int, body binary"


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed body: lengths first, then the bytes."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    joined = b"".join([head, *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=1).compress(joined)


def unsqueeze(body: bytes, *types) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(body)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(data, np.int64, count, 8), 8 * (count + 1), []
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def squeeze_places(*arrays: np.ndarray) -> bytes:
    """As squeeze, with the bytes of numbers compressed place by place; booleans are bits.

    Small numbers and differences of sorted ones then cost little more than the
    places that vary; a place that is zero throughout costs nothing.
    """
    head, pieces, tool = [len(arrays)], [], zstandard.ZstdCompressor(level=1)
    for a in arrays:
        head.append(len(a))
        rows = np.packbits(a) if a.dtype == bool else np.ascontiguousarray(a)
        for place in rows.view(np.uint8).reshape(len(rows), rows.itemsize).T:
            plain = place.tobytes() if place.any() else b""
            small = tool.compress(plain) if plain else plain
            pieces.append(min(plain, small, key=len))  # as it is, if it has its full length
            head.append(len(pieces[-1]))
    return b"".join([np.array(head, "<u4").tobytes(), *pieces])


def unsqueeze_places(body: bytes, *types) -> list[np.ndarray]:
    tool, out = zstandard.ZstdDecompressor(), []
    places = [1 if kind is bool else np.dtype(kind).itemsize for kind in types]
    head = np.frombuffer(body, "<u4", 1 + len(types) + sum(places)).tolist()
    if head[0] != len(types):
        raise ValueError(f"{head[0]} arrays, {len(types)} expected")
    at, from_ = 4 * len(head), 1
    for kind, width in zip(types, places, strict=True):
        size = head[from_]
        stored = -(-size // 8) if kind is bool else size
        rows = np.zeros((stored, width), np.uint8)
        for i, length in enumerate(head[from_ + 1 : from_ + 1 + width]):
            piece = body[at : at + length]
            if length:
                whole = piece if length == stored else tool.decompress(piece)
                rows[:, i] = np.frombuffer(whole, np.uint8)
            at += length
        from_ += 1 + width
        if kind is bool:
            out.append(np.unpackbits(rows.ravel(), count=size).astype(bool))
        else:
            out.append(rows.view(kind).ravel())
    return out


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body, offsets


def ids_of(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def as_ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NO_ID)


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def id_bounds(docs: DataFrame, n: int) -> np.ndarray:
    """n - 1 borders that deal doc_id to n ranges of about as many rows."""
    steps = min(n, 1000)
    points = [i / steps for i in range(steps + 1)]
    found = docs.agg(F.percentile_approx("doc_id", points, 10_000)).first()[0]
    if not found:
        return np.zeros(0, np.int64)
    exact = np.interp(np.arange(1, n) / n, points, np.array(found, float))
    return np.unique(np.ceil(exact).astype(np.int64))


class Chunks:
    """The packed texts of documents (doc_id, text), dealt by id or by ranges of it.

    With `ordered`, a smaller doc_id never lies in a later chunk. A null doc_id
    counts as the smallest, a null text as empty. `mark` names a boolean column
    that goes along (null: false).
    """

    def __init__(
        self,
        docs: DataFrame,
        ordered: bool = False,
        chunk_bytes: int = CHUNK_BYTES,
        mark: str | None = None,
    ):
        docs = docs.select(
            F.col("doc_id").cast("long"),
            F.col("text").cast("string"),
            F.coalesce(F.col(mark), F.lit(False)) if mark else F.lit(False),
        )
        n = self.n = max(4, math.ceil(total_bytes(docs) / chunk_bytes))
        bounds = id_bounds(docs, n) if ordered else None

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, (body, offsets) = ids_of(batch.column(0)), string_parts(batch.column(1))
                marks = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                if bounds is None:
                    to = spread(mix(ids.view(np.uint64)), n)
                else:
                    to = np.searchsorted(bounds, ids, side="right")
                order = np.argsort(to, kind="stable")
                chunk, first = np.unique(to[order], return_index=True)
                payloads = []
                for rows in np.split(order, first[1:]):
                    texts = [body[offsets[r] : offsets[r + 1]] for r in rows]
                    sizes = np.array([len(t) for t in texts], np.int64)
                    joined = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
                    payloads.append(squeeze(ids[rows], sizes, joined, marks[rows]))
                if payloads:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(chunk, pa.int32()), pa.array(payloads, pa.binary())],
                        ["chunk", "payload"],
                    )

        self.packed = docs.mapInArrow(pack, PACKED).repartition(n, "chunk")

    def each(self, act: Callable, schema: str) -> DataFrame:
        """act(chunk, texts) gives a table for each chunk."""

        def apply(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            return act(key[0].as_py(), unpack(table))

        return self.packed.groupBy("chunk").applyInArrow(apply, schema)

    def each_with(self, replies: DataFrame, act: Callable, schema: str) -> DataFrame:
        """act(chunk, texts, replies) for each chunk; replies: a table of this chunk's rows."""

        def apply(
            key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table
        ) -> pa.Table:
            return act(key[0].as_py(), unpack(left), right)

        grouped = self.packed.groupBy("chunk").cogroup(replies.groupBy("chunk"))
        return grouped.applyInArrow(apply, schema)


class Texts:
    """The texts of a chunk: ids, marks, and bytes with the offsets of their borders."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, body: np.ndarray, marks: np.ndarray):
        self.ids, self.body, self.marks = ids, body, marks
        self.offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def unpack(table: pa.Table) -> Texts:
    """The texts in an order that does not depend on the shuffle."""
    parts = [
        unsqueeze(payload, np.int64, np.int64, np.uint8, bool)
        for payload in sorted(table["payload"].to_pylist())
    ]
    if not parts:
        empty = np.zeros(0, np.int64)
        return Texts(empty, empty, np.zeros(0, np.uint8), np.zeros(0, bool))
    return Texts(*(np.concatenate(column) for column in zip(*parts, strict=True)))


def spread(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes dealt evenly to n ranges of their values, in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def short_keys(keys: np.ndarray) -> np.ndarray:
    """The low bytes of the keys; the bucket is known from the high ones."""
    return np.ascontiguousarray(keys, "<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]


def long_keys(data: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = data.reshape(-1, KEY_BYTES)
    return wide.view("<u8").ravel()


def sorted_keys(keys: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted hashes for each of n buckets, as differences of their high bits.

    48 bits and those that tell the buckets apart are kept.
    """
    bits = min(64, 8 * KEY_BYTES + (n - 1).bit_length())
    high = keys >> np.uint64(64 - bits)
    return [np.diff(high[own], prepend=np.uint64(0)) for own in bucket_slices(keys, n)]


def bucket_slices(keys: np.ndarray, n: int) -> list[slice]:
    """Where each bucket's part of sorted hashes lies."""
    ends = np.searchsorted(spread(keys, n), np.arange(n), side="right").tolist()
    return [slice(a, b) for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def questions(chunk: int, keys: np.ndarray, n: int, *columns: np.ndarray) -> pa.Table:
    """One message to each bucket: sorted distinct keys and columns of equal length."""
    ends = np.searchsorted(spread(keys, n), np.arange(n), side="right")
    starts = np.concatenate(([0], ends[:-1]))
    bodies = [
        squeeze(short_keys(keys[a:b]), *(c[a:b] for c in columns))
        for a, b in zip(starts, ends, strict=True)
    ]
    return pa.table(
        {
            "bucket": pa.array(np.arange(n), pa.int32()),
            "chunk": pa.array(np.full(n, chunk), pa.int32()),
            "body": pa.array(bodies, pa.binary()),
        }
    )


def answer(messages: DataFrame, rule: Callable, *types) -> DataFrame:
    """Each bucket's rule over what it was asked, sent back to the chunks.

    rule(keys, sender, *columns) sees the keys of all messages, by chunk and
    sorted within it, and returns an array of one value for each.
    """

    def apply(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table["chunk"].to_numpy(), kind="stable")
        chunks = table["chunk"].to_numpy()[order]
        bodies = table["body"].take(pa.array(order))
        parts = [unsqueeze(b.as_py(), np.uint8, *types) for b in bodies]
        keys = [long_keys(p[0]) for p in parts]
        sizes = np.array([len(k) for k in keys])
        columns = [np.concatenate([p[i + 1] for p in parts]) for i in range(len(types))]
        values = rule(np.concatenate(keys), np.repeat(np.arange(len(parts)), sizes), *columns)
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "chunk": pa.array(chunks, pa.int32()),
                "bucket": pa.array(np.full(len(parts), key[0].as_py()), pa.int32()),
                "body": pa.array(
                    [squeeze(values[e - s : e]) for s, e in zip(sizes, ends, strict=True)],
                    pa.binary(),
                ),
            }
        )

    return messages.groupBy("bucket").applyInArrow(apply, REPLY)


def answers(replies: pa.Table, kind) -> np.ndarray:
    """The answers to a chunk, in the order of its sorted keys."""
    order = np.argsort(replies["bucket"].to_numpy(), kind="stable")
    bodies = replies["body"].take(pa.array(order))
    parts = [unsqueeze(b.as_py(), kind)[0] for b in bodies]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by key, and where each group begins in it."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))[: len(keys)]

"""Quartile bucket digests of texts, and how like two digests are.

Every text is read as UTF-8 bytes. Each window of four bytes gives three
triplets, (0, 1, 2), (0, 1, 3) and (0, 2, 3), as far as the text goes; a triplet
and its kind hash to one of 256 buckets. A bucket's code (0 to 3) says how many
of the quartiles of the text's 256 counts lie below its count. A digest is 128
hex digits of codes, two codes a digit, and two of the length: how many steps of
about an eighth the number of bytes has reached.

Equal texts have equal digests. Texts of less than three bytes have all codes 0.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.chunks import NO_ID, string_parts
from gazette.llm.hashing import blocks

BUCKETS = 256
#: Places of the second and third byte of each kind of triplet.
TRIPLETS = ((1, 2), (1, 3), (2, 3))
MULTIPLIER = 2654435761
#: Steps of length that make two texts wholly unlike.
FAR_LENGTH = 20
SLICE_BYTES = 1 << 20
#: Text of a part of the documents, in order; fewest and most parts, parts of a task
#: on average, and sampled keys for each part.
PART_BYTES, FEWEST, MOST, TOGETHER, SAMPLED = 16 << 20, 128, 40_000, 4, 16
EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _steps() -> np.ndarray:
    steps = [1]
    while len(steps) < 255:
        steps.append(steps[-1] + max(1, steps[-1] // 8))
    return np.array(steps, np.int64)


LENGTHS = _steps()


def counted(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Triplets per text and bucket; body holds the texts end to end.

    Works on slices, so a text of any length takes bounded memory.
    """
    n = len(offsets) - 1
    counts = np.zeros((n, BUCKETS), np.int64)
    end = int(offsets[-1])
    for at in range(int(offsets[0]), end, SLICE_BYTES):
        stop = min(at + SLICE_BYTES, end)
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        last = int(np.searchsorted(offsets, stop, side="left"))
        own = offsets[first : last + 1]
        # the text of each byte of the slice, and how many bytes of it are left
        inner = np.clip(own, at, stop)
        text = np.repeat(np.arange(last - first), np.diff(inner))
        left = np.repeat(own[1:], np.diff(inner)) - np.arange(at, stop)
        data = np.zeros(stop - at + 3, np.uint32)
        tail = body[at : min(stop + 3, end)]
        data[: len(tail)] = tail
        for kind, (i, j) in enumerate(TRIPLETS):
            size = stop - at
            value = data[:size] | data[i : size + i] << 8 | data[j : size + j] << 16
            value += np.uint32(kind << 24)
            value *= np.uint32(MULTIPLIER)
            value >>= 24
            whole = left > j
            place = (text * BUCKETS + value)[whole]
            found = np.bincount(place, minlength=(last - first) * BUCKETS)
            counts[first:last] += found.reshape(-1, BUCKETS)
    return counts


def encoded(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A digest per text: one row of 65 bytes."""
    ranked = np.sort(counts, axis=1)
    quarter = BUCKETS // 4
    codes = np.zeros(counts.shape, np.uint8)
    for place in (quarter - 1, 2 * quarter - 1, 3 * quarter - 1):
        codes += counts > ranked[:, place : place + 1]
    packed = codes.reshape(len(codes), -1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = np.searchsorted(LENGTHS, sizes, side="right").astype(np.uint8)
    return np.concatenate([packed, length[:, None]], axis=1)


def digests(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The digests of texts that lie end to end in body, one row of bytes each."""
    return encoded(counted(body, offsets), np.diff(offsets))


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How like digests are, row by row, from 0 to 1.

    The difference of two digests is the sum of the differences of their codes,
    as a share of what it would be if the codes of one lay in any order (so texts
    that have nothing in common come to 1), and a twentieth for each step of
    length between them; it ends at 1. Digests that have all codes equal differ
    by their length alone.
    """
    shifts = np.array([6, 4, 2, 0], np.uint8)
    a, b = (((x[:, :-1, None] >> shifts) & 3).reshape(len(x), -1).astype(np.int64) for x in (one, other))
    body = np.abs(a - b).sum(1)
    many_a, many_b = (np.stack([(x == c).sum(1) for c in range(4)], 1) for x in (a, b))
    apart = np.abs(np.subtract.outer(np.arange(4), np.arange(4)))
    chance = np.einsum("ni,ij,nj->n", many_a, apart, many_b)
    steps = np.abs(one[:, -1].astype(np.int64) - other[:, -1])
    steps = np.minimum(steps, FAR_LENGTH)
    # both sides of one fraction, so that the result is one division of whole numbers
    plain = chance == 0
    whole = np.where(plain, 1, chance)
    near = FAR_LENGTH * (whole - np.where(plain, 0, a.shape[1] * body)) - steps * whole
    return np.maximum(0, near) / (FAR_LENGTH * whole)


def as_hex(rows: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in rows]


def from_hex(values: list[str]) -> np.ndarray:
    return np.array([list(bytes.fromhex(v)) for v in values], np.uint8).reshape(len(values), -1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The digest of each whole text (null: empty): doc_id, n_bytes, fingerprint.

    One row per row of docs, computed in the scan without an exchange; repeated
    rows have equal digests. Columns other than doc_id and text are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = string_parts(batch["text"])
            parts = [digests(body, offsets[a : b + 1]) for a, b in blocks(offsets)]
            found = [x for part in parts for x in as_hex(part)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(offsets)), pa.array(found, pa.string())],
                ["doc_id", "n_bytes", "fingerprint"],
            )

    return rows.mapInArrow(act, "doc_id long, n_bytes long, fingerprint string")


def compared(pairs: DataFrame, one: str, other: str, name: str = "likeness") -> DataFrame:
    """pairs with the likeness of two columns of fingerprints (null where one is null)."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [batch[c].to_pylist() for c in (one, other)]
            full = [i for i, v in enumerate(zip(*both, strict=True)) if None not in v]
            near: list[float | None] = [None] * len(batch)
            if full:
                a, b = (from_hex([v[i] for i in full]) for v in both)
                for i, value in zip(full, likeness(a, b).tolist(), strict=True):
                    near[i] = value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.float64())], [*batch.schema.names, name]
            )

    schema = ", ".join(f"`{c}` {kind}" for c, kind in pairs.dtypes)
    return pairs.mapInArrow(act, f"{schema}, `{name}` double")


def _at_most(firsts: Column, seconds: Column, n: int, key: Column, tie: Column) -> Column:
    """How many of n sorted keys are not above (key, tie): a binary search."""
    steps = [1 << i for i in reversed(range(n.bit_length()))]

    def step(place: Column, width: Column) -> Column:
        first, second = F.get(firsts, place + width - 1), F.get(seconds, place + width - 1)
        below = (first < key) | ((first == key) & (second <= tie))
        return F.when(below, place + width).otherwise(place)  # past the end: null, so not below

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _borders(rows: DataFrame, part_bytes: int) -> tuple[list[tuple[int, int]], tuple[int, int] | None]:
    """Keys of rows that begin a part of about part_bytes, and the first key of all.

    The keys come from a sample by hash, in proportion to the bytes; it shapes the
    parts only. No more than MOST parts are made, which are then larger: a part is
    sorted and read as a stream.
    """
    size = F.octet_length("text") + 64
    total, first = rows.agg(F.sum(size), F.min(F.struct("key", "tie"))).first()
    if first is None:
        return [], None
    parts = min(MOST, max(FEWEST, math.ceil(total / part_bytes)))
    each = total / (parts * SAMPLED)
    draw = F.pmod(F.xxhash64("key", "tie", F.lit("border")), F.lit(1 << 32)) / float(1 << 32)
    some = rows.select("key", "tie", size.alias("size")).where(draw < F.col("size") / each)
    found = sorted(some.select("key", "tie", F.greatest("size", F.lit(each))).collect())
    weight = np.cumsum([f[2] for f in found])
    places = np.searchsorted(weight, np.arange(1, parts) * (weight[-1] / parts)) if found else []
    keys = {tuple(found[i][:2]) for i in places}
    return sorted(keys - {tuple(first)}), tuple(first)


def followed(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents in ascending order of doc_id, dealt to parts that end with a guest.

    Returns part, guest, doc_id and text, sorted by part within the tasks. The
    order is total: doc_id (null first), then a hash of the text, then the text.
    A part holds a run of documents and, after them, the document that begins
    the next part (the first of all after the last part) as a guest, so each
    document's successor is the row after it. No task holds a part as a whole.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).select(
        "doc_id", "text",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("tie"),
    )
    keys, first = _borders(rows, part_bytes)
    parts = len(keys) + 1
    if first is None:
        first = (NO_ID, 0)
    part, begins = F.lit(0), F.lit(False)
    if keys:
        firsts, seconds = (F.array(*[F.lit(k[i]).cast("long") for k in keys]) for i in (0, 1))
        part = _at_most(firsts, seconds, len(keys), F.col("key"), F.col("tie"))
        before = F.col("part") - 1
        begins = (F.get(firsts, before) == F.col("key")) & (F.get(seconds, before) == F.col("tie"))
    dealt = rows.withColumn("part", part)
    least = (F.col("key") == first[0]) & (F.col("tie") == first[1])
    places = F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")),
        F.when(begins, F.struct((F.col("part") - 1).alias("part"), F.lit(True).alias("guest"))),
        F.when(least, F.struct(F.lit(parts - 1).alias("part"), F.lit(True).alias("guest"))),
    )
    spread = dealt.select(
        F.explode(F.filter(places, lambda p: p.isNotNull())).alias("at"),
        "doc_id", "text", "key", "tie",
    ).select("at.part", "at.guest", "doc_id", "text", "key", "tie")
    ordered = spread.repartition(math.ceil(parts / TOGETHER), "part").sortWithinPartitions(
        "part", "guest", "key", "tie", "text"
    )
    return ordered.select("part", "guest", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def edited_likeness(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Digests of documents, of their edited texts, and how like these and the next are.

    docs: doc_id, text (null: empty); other columns are not read. The edited text
    has the last quarter of the code points replaced by the first of the next
    document in the order of `followed`; the first document follows the last, so
    a single document follows itself. Rows that share a doc_id (or have none) are
    ordered by their text; repeated rows follow each other. Returns one row per
    row of docs (none for an empty table): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.
    """

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            _, offsets = string_parts(batch["text"])
            for a, b in blocks(offsets):
                some = batch.slice(a, b - a)
                held += zip(*(some[c].to_pylist() for c in batch.schema.names), strict=True)
                # the last row waits for its successor, which may be in the next block
                pairs = [i for i in range(len(held) - 1) if not held[i][1] and held[i][0] == held[i + 1][0]]
                lone = [r for r, s in zip(held, held[1:]) if not r[1] and r[0] != s[0]]
                if lone:
                    raise RuntimeError("a document has no successor: the input changed between reads")
                if pairs:
                    yield _rows(held, pairs)
                held = held[-1:]
        if held and not held[0][1]:
            raise RuntimeError("a document has no successor: the input changed between reads")

    return followed(docs, part_bytes).mapInArrow(act, EDITED)


def _rows(held: list[tuple], pairs: list[int]) -> pa.RecordBatch:
    texts = [row[3] for row in held]
    changed = [edited(texts[i], texts[i + 1]) for i in pairs]
    own, other = digests(*_joined(texts)), digests(*_joined(changed))
    at = np.array(pairs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([held[i][2] for i in pairs], pa.int64()),
            pa.array([len(texts[i]) for i in pairs], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array(as_hex(own[at])),
            pa.array(as_hex(other)),
            pa.array(likeness(own[at], other)),
            pa.array(likeness(own[at], own[at + 1])),
        ],
        [name.split()[0] for name in EDITED.split(", ")],
    )

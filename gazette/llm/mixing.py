"""Mixing sources to target weights in fixed-length blocks.

The words of each source, documents in a pseudorandom order, form one stream
that is cut into blocks. Each output shard draws how many of its slots go to
each source (multinomially, from what is left of the sources' quotas). The j-th
slot of a source takes the block that a pseudorandom permutation of the source's
block numbers gives for j; a new pass over the blocks has a permutation of its
own, so no block is taken twice before all are taken once. Slots and blocks are
joined by source and block number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.hashing import mix
from gazette.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Documents that are put in order together.
PART_ROWS = 2000
#: Slots that one task numbers at once.
SLOT_ROWS = 1 << 16


def targets(sizes: Sequence[int], weights: Sequence[float], limit: float) -> list[float]:
    """Shares of the total by weight, none above limit times its size."""
    out, rest = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while rest:
        unit = left / sum(weights[i] for i in rest)
        full = {i for i in rest if unit * weights[i] > limit * sizes[i]}
        for i in full or rest:
            out[i] = float(limit * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        rest -= full
    return out


def draws(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each shard (row) for each source; the columns add up to the quotas."""
    rng, left = np.random.default_rng(seed), np.array(quotas, np.int64)
    out = np.zeros((shards, len(left)), np.int64)
    for shard in range(shards):
        total = left.sum()
        size = total // (shards - shard)
        if not size:
            continue
        drawn = rng.multinomial(size, left / total)
        over = np.maximum(drawn - left, 0)
        drawn -= over
        spill = int(over.sum())
        for i in np.argsort(drawn - left):
            more = min(spill, int(left[i] - drawn[i]))
            drawn[i] += more
            spill -= more
        out[shard], left = drawn, left - drawn
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """The images of indexes below size under a keyed permutation of all of them.

    Four Feistel rounds permute the next even power of two; images that are too
    large are permuted again until they are not.
    """
    half = max(1, (max(1, int(size - 1).bit_length()) + 1) // 2)
    bits, low = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, 5, dtype=np.uint64) + np.uint64(key << 3 & (1 << 64) - 1))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        value = out[todo]
        left, right = value >> bits, value & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


@dataclass
class Mixture:
    """Documents with their place in the stream of their source, and the slots."""

    #: doc_id, sign (hash of the text), size, source_size, target, number, start
    documents: DataFrame
    #: shard, slot, number (of the source), block
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """The parts of documents in each block: number, block, first word and words."""
        at, begin = F.col("block") * self.block_words, F.col("start")
        first = F.greatest(at - begin, F.lit(0))
        last = F.least(at + self.block_words - begin, F.col("size"))
        blocks = F.sequence(
            F.floor(begin / self.block_words),
            F.floor((begin + F.col("size") - 1) / self.block_words),
        )
        return (
            self.documents.where("size > 0")
            .withColumn("block", F.explode(blocks))
            .withColumns({"first": first, "words": last - first})
        )

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target and taken: words that the slots take of it."""
        times = self.slots.groupBy("number", "block").agg(F.count("*").alias("times"))
        # made from a few rows, so Spark thinks the slots are few: no broadcast
        times = times.hint("merge")
        columns = ["doc_id", "size", "source_size", "target"]
        some = (
            self.pieces()
            .join(times, ["number", "block"], "left")
            .groupBy("number", "start", *columns)
            .agg(F.sum(F.coalesce("times", F.lit(0)) * F.col("words")).alias("taken"))
            .select(*columns, "taken")
        )
        none = self.documents.where("size = 0")
        return some.unionByName(none.select(*columns, F.lit(0).cast("long").alias("taken")))

    def texts(self, docs: DataFrame) -> DataFrame:
        """The blocks as text: shard, slot and text, words joined by one space."""
        words = F.filter(F.split("text", SPACE), lambda w: w != "")
        own = docs.select("doc_id", F.xxhash64("text").alias("sign"), "text")
        pieces = self.pieces().select("number", "block", "start", "doc_id", "sign", "first", "words")
        held = own.dropDuplicates(["doc_id", "sign"]).alias("d")
        pieces = pieces.alias("p").join(
            held,
            F.col("p.doc_id").eqNullSafe(F.col("d.doc_id"))
            & F.col("p.sign").eqNullSafe(F.col("d.sign")),
        )
        part = F.slice(words, (F.col("first") + 1).cast("int"), F.col("words").cast("int"))
        blocks = (
            pieces.select("number", "block", "start", F.array_join(part, " ").alias("part"))
            .groupBy("number", "block")
            .agg(F.sort_array(F.collect_list(F.struct("start", "part"))).alias("parts"))
            .select("number", "block", F.array_join("parts.part", " ").alias("text"))
        )
        slots = self.slots.hint("merge")
        return slots.join(blocks, ["number", "block"]).select("shard", "slot", "text")


def mixture(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    limit: float = 3,
    block_words: int = 64,
    shards: int = 64,
    seed: int = 17,
) -> Mixture:
    """Mix documents (doc_id, text, source) to weights of their sources.

    Sources in the order of their code points, null last, get the weights in turn
    and share the words of all sources by them, but none more than `limit` times
    its own; the excess goes to the others by weight. A null text has no words. A
    document without words is never taken, a source without words has target 0;
    repeated rows are separate documents. One row per source is held by the
    driver. Other columns are not read.
    """
    shared_dir(docs.sparkSession)
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("sign"),
        F.col("source").cast("string"),
        size.alias("size"),
    ).checkpoint()
    found = sized.groupBy("source").agg(F.sum("size"), F.count("*")).collect()
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [r[1] for r in found]
    shares = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], limit)
    blocks = [math.ceil(n / block_words) for n in sizes]
    quotas = [
        min(round(t * b / n), math.floor(limit * b)) if n else 0
        for t, b, n in zip(shares, blocks, sizes, strict=True)
    ]
    sources = spark.createDataFrame(
        [
            (r[0], i, sizes[i], shares[i], math.ceil(r[2] / PART_ROWS))
            for i, r in enumerate(found)
        ],
        "of string, number int, source_size long, target double, parts int",
    )
    placed = _placed(sized.join(sources, F.col("source").eqNullSafe(F.col("of"))))
    counts = draws(quotas, shards, seed)
    done = np.concatenate((np.zeros((1, len(found)), np.int64), np.cumsum(counts, 0)))
    across = np.cumsum(counts, 1) - counts
    rows = [
        (shard, i, int(done[shard, i]), int(across[shard, i]), int(counts[shard, i]), blocks[i])
        for shard in range(shards)
        for i in range(len(found))
        if counts[shard, i]
    ]
    drawn = spark.createDataFrame(
        rows, "shard int, number int, done long, across long, count long, blocks long"
    )
    tasks = max(8, math.ceil(sum(quotas) / (4 * SLOT_ROWS)))
    return Mixture(placed, _slots(drawn, seed, tasks), block_words)


def _placed(sized: DataFrame) -> DataFrame:
    """Where each document starts in the stream of its source."""
    sized = sized.withColumn("part", F.pmod(F.xxhash64("doc_id", "sign"), "parts"))
    part = Window.partitionBy("number", "part")
    order = part.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id", "sign", "size")
    ahead = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sized.groupBy("number", "part")
        .agg(F.sum("size").alias("words"))
        .select(
            F.col("number").alias("n"),
            F.col("part").alias("p"),
            F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"),
        )
    )
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    inside = sized.withColumn("inside", before)
    return inside.join(bases, (F.col("number") == F.col("n")) & (F.col("part") == F.col("p"))).select(
        *("doc_id", "sign", "size", "source_size", "target", "number"),
        (F.col("base") + F.col("inside")).alias("start"),
    )


def _slots(drawn: DataFrame, seed: int, tasks: int) -> DataFrame:
    """The slots of all shards with the blocks they take."""
    steps = F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(SLOT_ROWS).cast("long"))
    # rows are few where slots are many: the number of tasks follows the slots
    parts = drawn.withColumn("step", F.explode(steps)).repartition(tasks, "shard", "number", "step")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = np.arange(row["step"], min(row["step"] + SLOT_ROWS, row["count"]))
                turn, index = np.divmod(row["done"] + own, row["blocks"])
                block = np.empty(len(own), np.int64)
                for t in np.unique(turn):
                    key = (seed * 1_000_003 + row["number"]) * 1_000_003 + int(t)
                    block[turn == t] = permuted(index[turn == t], row["blocks"], key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), row["shard"]), pa.int32()),
                        pa.array(row["across"] + own, pa.int64()),
                        pa.array(np.full(len(own), row["number"]), pa.int32()),
                        pa.array(block, pa.int64()),
                    ],
                    ["shard", "slot", "number", "block"],
                )

    return parts.mapInArrow(number, "shard int, slot long, number int, block long")

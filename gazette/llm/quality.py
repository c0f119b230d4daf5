"""Quality classifier: regularised quadratic discriminant analysis of text statistics.

Each whole text becomes a short vector of transformed statistics on an integer
grid, so the sums from which Spark estimates means and covariances are exact and
do not depend on the order of rows. The class covariances are shrunk towards the
pooled one and towards a multiple of the identity; their Cholesky factors are
kept, and a score follows from the difference of the log densities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.chunks import as_ids, ids_of, string_parts
from gazette.llm.hashing import Words, blocks, mix
from gazette.session import shared_dir

STATISTICS = [
    "word_bytes", "word_bytes_spread", "symbols", "capitals", "digits", "marks",
    "line_ends", "repeated_neighbours", "distinct_words", "distinct_pairs",
    "words_with_symbols", "words_in_capitals",
]
#: Statistics are kept as multiples of 1 / GRID.
GRID = 256
#: Shares below this one look alike after the logarithm.
SHARE = 1e-2
#: Every text counts as longer by these, so that a short one is not judged by a few bytes.
MORE_BYTES, MORE_WORDS = 64, 16
#: Mean and spread of the bytes of the added words.
WORD_MEAN, WORD_SPREAD = 5.0, 3.0
#: Longer words (keys, addresses) count as this long.
LONG_WORD = 20
TO_POOLED, TO_SPHERE = 0.1, 0.02


def _kind(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(characters)] = 1
    return table


_SYMBOLS = _kind(rb"#$%&*|<>{}[]\^~_=+@/!")
_CAPITALS = _kind(bytes(range(65, 91)))
_LETTERS = _kind(bytes(range(65, 91)) + bytes(range(97, 123)))
_DIGITS = _kind(b"0123456789")
_MARKS = _kind(b".,;:?'\"()-")
_LINES = _kind(b"\n")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log(SHARE + part / whole)


def _sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[borders[1:]] - total[borders[:-1]]


def text_statistics(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS on the grid for each text of a block."""
    words = Words(body, offsets)
    own, borders = words.body, offsets - offsets[0]
    n_bytes = np.diff(borders) + float(MORE_BYTES)
    n_words = np.diff(words.borders) + float(MORE_WORDS)
    sizes = np.minimum(words.ends - words.starts, LONG_WORD)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.borders))
    counts = {
        name: _sums(kind[own], borders)
        for name, kind in (
            ("symbols", _SYMBOLS), ("capitals", _CAPITALS), ("letters", _LETTERS),
            ("digits", _DIGITS), ("marks", _MARKS), ("lines", _LINES),
        )
    }
    mean = (_sums(sizes, words.borders) + MORE_WORDS * WORD_MEAN) / n_words
    added = MORE_WORDS * (WORD_MEAN**2 + WORD_SPREAD**2)
    square = (_sums(sizes.astype(float) ** 2, words.borders) + added) / n_words
    hashes = words.hashes()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    of_text = mix(text.astype(np.uint64) + np.uint64(1))
    distinct = _distinct(mix(hashes ^ of_text), text, len(n_words))
    pairs = mix(hashes[1:] + mix(hashes[:-1])) ^ of_text[1:]
    within = text[1:] == text[:-1]
    distinct_pairs = _distinct(pairs[within], text[1:][within], len(n_words))
    places = np.concatenate(([0], np.cumsum(_SYMBOLS[own])))
    with_symbols = places[words.ends] - places[words.starts] > 0
    capitals = np.concatenate(([0], np.cumsum(_CAPITALS[own])))
    small = np.concatenate(([0], np.cumsum(_LETTERS[own] - _CAPITALS[own])))
    shouted = (capitals[words.ends] - capitals[words.starts] > 1) & (
        small[words.ends] == small[words.starts]
    )
    columns = [
        np.log1p(mean),
        np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
        _share(counts["symbols"], n_bytes),
        _share(counts["capitals"], counts["letters"] + MORE_BYTES),
        _share(counts["digits"], n_bytes),
        _share(counts["marks"], n_bytes),
        _share(counts["lines"], n_words),
        _share(_sums(same, words.borders), n_words),
        np.log((distinct + MORE_WORDS) / n_words),
        np.log((distinct_pairs + MORE_WORDS) / n_words),
        _share(_sums(with_symbols, words.borders), n_words),
        _share(_sums(shouted, words.borders), n_words),
    ]
    return np.rint(np.stack(columns, 1) * GRID).astype(np.int64)


def _distinct(keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    _, first = np.unique(keys, return_index=True)
    return np.bincount(text[first], minlength=n).astype(float)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and statistics (array of longs) of each row of (doc_id, text)."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = string_parts(batch.column(1))
            rows = [text_statistics(body, offsets[a : b + 1]) for a, b in blocks(offsets)]
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0, np.int64)
            places = np.arange(len(batch) + 1, dtype=np.int32) * len(STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [
                    as_ids(ids_of(batch.column(0))),
                    pa.ListArray.from_arrays(pa.array(places), pa.array(flat)),
                ],
                ["doc_id", "statistics"],
            )

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(act, "doc_id long, statistics array<long>")


@dataclass
class Discriminant:
    """Class shares, means and Cholesky factors of the shrunk covariances."""

    shares: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if self.shares.min() == 0:
            return np.full(len(rows), self.shares[1] if self.shares.any() else 0.5)
        densities = []
        for share, mean, factor in zip(self.shares, self.means, self.factors, strict=True):
            z = np.linalg.solve(factor, (rows / self.scale - mean).T)
            densities.append(np.log(share) - np.log(np.diag(factor)).sum() - (z**2).sum(0) / 2)
        return 1 / (1 + np.exp(np.clip(densities[0] - densities[1], -700, 700)))


def fit(statistics: DataFrame, labels: DataFrame) -> Discriminant:
    """From statistics of documents and labels (doc_id, quality 0 or 1), all of them."""
    d = len(STATISTICS)
    x = [F.col("statistics")[i] for i in range(d)]
    half = [(i, j) for i in range(d) for j in range(i + 1)]
    known = labels.select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")
    ).where("quality in (0, 1)")
    sums = (
        statistics.join(known, F.col("doc_id") == F.col("id"))
        .groupBy("quality")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(c) for c in x]).alias("first"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in half]).alias("second"),
        )
        .collect()
    )
    counts, first, second = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in sums:
        c = row["quality"]
        counts[c], first[c] = row["n"], np.array(row["first"], float) / GRID
        for (i, j), value in zip(half, row["second"], strict=True):
            second[c, i, j] = second[c, j, i] = float(value) / GRID**2
    n = np.maximum(counts, 1)
    means = first / n[:, None]
    spread = second / n[:, None, None] - means[:, :, None] * means[:, None, :]
    share = counts / max(counts.sum(), 1)
    pooled = np.tensordot(share, spread, 1)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    spread, pooled = spread / np.outer(scale, scale), pooled / np.outer(scale, scale)
    factors = []
    for own in spread:
        mixed = (1 - TO_POOLED) * own + TO_POOLED * pooled
        sphere = max(np.trace(mixed) / d, 1e-3) * np.eye(d)
        factors.append(np.linalg.cholesky((1 - TO_SPHERE) * mixed + TO_SPHERE * sphere))
    return Discriminant(share, scale, means / scale, np.stack(factors))


def score(statistics: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score of each row."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(rows / GRID))], ["doc_id", "score"]
            )

    return statistics.mapInArrow(act, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> DataFrame:
    """Score every document (doc_id, text) by a classifier learnt from labels.

    `train` is a condition on the labels' doc_id; only such labels are used, and
    of them those with quality 0 or 1. Returns doc_id and score, the probability
    of quality 1, one row per document. A null text counts as empty; empty texts
    have statistics like any other. Without labels of both classes the score is
    the share of class 1, without any 0.5. Repeated doc_ids are scored row by row.
    Other columns are not read.
    """
    shared_dir(docs.sparkSession)
    own = statistics(docs).checkpoint()
    return score(own, fit(own, labels if train is None else labels.where(train)))


def accepted(docs: DataFrame, model: Discriminant, threshold: float) -> DataFrame:
    """The rows of documents, all columns, whose score reaches the threshold."""
    text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = string_parts(batch.column(text).cast(pa.string()))
            rows = [text_statistics(body, offsets[a : b + 1]) for a, b in blocks(offsets)]
            rows = np.concatenate([np.zeros((0, len(STATISTICS)), np.int64), *rows])
            yield batch.filter(pa.array(model.scores(rows / GRID) >= threshold))

    return docs.mapInArrow(keep, docs.schema)

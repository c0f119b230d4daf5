"""Language identification: naive Bayes over character trigrams.

Training counts the trigrams of labelled texts in a fixed number of buckets, so
no trigram is left out and the profile is bounded by construction. It is broadcast
as one array per language; a text is scored within its row, by the sum of the log
probabilities of its trigrams. So scoring neither multiplies rows nor shuffles them.
Both look at the trigrams of a batch of texts at once, as arrays in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import normalize_text
from gazette.session import shared_dir

# Log probabilities are whole millionths, so sums do not depend on row order.
LOG_UNIT = 1_000_000
# Rows of a profile at most; each has a number for every language.
BUCKETS = 1 << 18
# Factors of the three code points of a trigram.
FACTORS = (7919, 104_729, 1_299_709)
# Trigrams that are worked on at once, and languages a task counts at once.
SLICE = 1 << 20
HELD = 32
UNKNOWN = "unknown"


@dataclass(frozen=True)
class LanguageProfile:
    """A row per bucket seen in training, with a score in a column for each language."""

    scores: DataFrame

    @property
    def languages(self) -> list[str]:
        return sorted(c for c in self.scores.columns if c != "bucket")


def _padded(text: Column) -> Column:
    """The text as its trigrams are taken: clean, lower case, a space at both ends."""
    return F.concat(F.lit(" "), F.lower(normalize_text(text)), F.lit(" "))


def _slices(texts: Iterable[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows, first positions and trigram buckets of texts, about SLICE of them at a time.

    A trigram that is not of one text has the bucket BUCKETS. A text that is longer
    than a slice is in several, cut so that each trigram is in one; a text without
    any trigram is in none.
    """
    rows, parts, size, last = [], [], 0, len(FACTORS) - 1
    for row, text in enumerate(texts):
        for start in range(0, len(text) - last, SLICE):
            rows.append(row)
            parts.append(text[start : start + SLICE + last])
            size += len(parts[-1])
            if size >= SLICE:
                yield rows, *_buckets(parts)
                rows, parts, size = [], [], 0
    if rows:
        yield rows, *_buckets(parts)


def _buckets(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First position of each text, and the buckets at all positions of them joined."""
    points = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
    last = len(FACTORS) - 1
    found = sum(points[k : len(points) - last + k] * f for k, f in enumerate(FACTORS)) % BUCKETS
    ends = np.cumsum([len(p) for p in parts])
    for back in range(1, last + 1):
        found[ends[:-1] - back] = BUCKETS
    return ends - [len(p) for p in parts], found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams per language and bucket of the texts of a task."""
    held: dict[str, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for language, counts in held.items():
            seen = np.flatnonzero(counts[:BUCKETS])
            columns = [pa.array([language] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(counts[seen])]
            yield pa.RecordBatch.from_arrays(columns, ["language", "bucket", "n"])

    for batch in batches:
        labels, texts = (batch.column(i).to_pylist() for i in range(2))
        texts_of: dict[str, list[str]] = {}
        for language, text in zip(labels, texts, strict=True):
            texts_of.setdefault(language, []).append(text)
        for language, own in texts_of.items():
            if language not in held and len(held) == HELD:
                yield from counted()
                held.clear()
            counts = held.setdefault(language, np.zeros(BUCKETS + 1, np.int64))
            for _, _, found in _slices(own):
                counts += np.bincount(found, minlength=BUCKETS + 1)
    yield from counted()


def train(labelled: DataFrame, text: str, label: str) -> LanguageProfile:
    """Profile of every language that occurs as a label."""
    shared_dir(labelled.sparkSession)
    counted = (
        labelled.filter(F.col(label).isNotNull())
        .select(F.col(label).cast("string").alias("language"), _padded(F.col(text)).alias("text"))
        .mapInArrow(_count, "language string, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    totals = {
        row["language"]: row["total"]
        for row in counted.groupBy("language").agg(F.sum("n").alias("total")).collect()
    }
    table = counted.groupBy("bucket").pivot("language", sorted(totals)).agg(F.sum("n"))
    vocabulary = table.count()

    def log_score(language: str) -> Column:
        seen = F.coalesce(F.col(f"`{language}`"), F.lit(0)) + 1
        return F.round(F.log(seen / F.lit(totals[language] + vocabulary)) * LOG_UNIT).cast("bigint")

    return LanguageProfile(table.select("bucket", *[log_score(x).alias(x) for x in sorted(totals)]))


def _arrays(profile: LanguageProfile) -> list[np.ndarray]:
    """The profile as an array over all buckets per language, and one that marks those seen."""
    table = profile.scores.select("bucket", *[f"`{x}`" for x in profile.languages]).toArrow()
    place = table.column(0).to_numpy()
    arrays = []
    for values in [*(c.to_numpy() for c in table.columns[1:]), np.ones(len(place), np.int64)]:
        arrays.append(np.zeros(BUCKETS + 1, np.int64))
        arrays[-1][place] = values
    return arrays


def _best(texts: list[str], arrays: list[np.ndarray], names: list[str]) -> list[str]:
    """The language with the highest sum for each text, of equal ones the last."""
    sums = np.zeros((len(arrays), len(texts)), np.int64)
    for rows, starts, found in _slices(texts):
        for total, values in zip(sums, arrays, strict=True):
            np.add.at(total, rows, np.add.reduceat(values[found], starts))
    best = len(names) - 1 - np.argmax(sums[-2::-1], axis=0)
    return [names[i] if seen else UNKNOWN for i, seen in zip(best, sums[-1], strict=True)]


def with_language(
    df: DataFrame, text: str, profile: LanguageProfile, name: str = "language"
) -> DataFrame:
    """Add the language of a text column; unknown where no trigram of it is in the profile."""
    names = profile.languages
    if not names:
        return df.withColumn(name, F.lit(UNKNOWN))
    held = df.sparkSession.sparkContext.broadcast(_arrays(profile))

    @F.arrow_udf("string")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(_best(batch.to_pylist(), held.value, names), pa.string())

    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, found(_padded(F.col(text))).alias(name))


def identify(df: DataFrame, key: str, text: str, profile: LanguageProfile) -> DataFrame:
    """(key, language) for every row; unknown where no trigram is in the profile."""
    return with_language(df.select(key, text), text, profile).select(key, "language")

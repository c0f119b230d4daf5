"""Documents to training data: five stages, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import decontamination, mixing, quality, secrets, simhash
from gazette.session import run_dir

#: Score from which a document is kept.
ACCEPTED = 0.3
#: No SQL: scores, fingerprints and a forest are not expressible.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; it learns from four fifths of the labels."""
    labels = _table(spark, sf_dir, "labels")
    train = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = quality.fit(quality.statistics(docs), train)
    return quality.accepted(docs, model, ACCEPTED)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose fingerprints of three words differ in two bits or fewer."""
    return simhash.one_of_each_group(docs, size=3, radius=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.without_items(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets in the texts; no document goes."""
    return secrets.masked(docs, secrets.scan(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mixture(docs, weights=(1, 2, 3), limit=3).taken()


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again."""
    folder = run_dir(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gazette.llm import (
    codes,
    decontamination,
    digests,
    katz,
    mixing,
    multiindex,
    pii,
    quality,
    repeats,
    secrets,
    simhash,
    suffixes,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _span_length(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def remainder(key: str, of: int):
    """crc32 of an id as text, modulo a number."""
    return F.crc32(F.col(key).cast("string")) % of


def op1_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        train=remainder("doc_id", 5) != 0,
    )
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.linked(table(spark, sf_dir, "embeddings"), threshold=0.98)


def _joined(spans):
    """kind:start:end of spans, by kind as listed and start, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in pii.KINDS])
    ranked = F.transform(
        spans, lambda s: F.struct(F.array_position(kinds, s["kind"]), s["start"], s["end"], s["kind"])
    )
    return F.array_join(
        F.transform(
            F.array_sort(ranked), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        ),
        ",",
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in pii.KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), weights=(1, 2, 3), limit=3).taken()


def op5_secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "position",
        F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        "probability",
    )


def op6_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = katz.katz_scores(docs.withColumn("train", remainder("doc_id", 7) != 2), order=3)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 7) == 2).alias("held_out"),
        *("n_tokens", "n_known", "train_tokens", "base_score", "score"),
    )


def op7_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.hits(documents, items)


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, radius=2)


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    return found.select(
        "doc_id",
        "n_bytes",
        _span_length("removed").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_windows(table(spark, sf_dir, "documents"), width=35)
    return found.select(
        "doc_id",
        "n_words",
        _span_length("removed").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.edited_likeness(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return codes.compressed(embeddings, parts=16, entries=64, rounds=2, scale=256)


def op13_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_quality_scores": op1_quality_scores,
    "op2_embedding_links": op2_embedding_links,
    "op3_personal_data": op3_personal_data,
    "op4_source_mix": op4_source_mix,
    "op5_secret_findings": op5_secret_findings,
    "op6_katz_scores": op6_katz_scores,
    "op7_benchmark_hits": op7_benchmark_hits,
    "op8_simhash_groups": op8_simhash_groups,
    "op9_suffix_repeats": op9_suffix_repeats,
    "op10_repeated_windows": op10_repeated_windows,
    "op11_text_digests": op11_text_digests,
    "op12_vector_codes": op12_vector_codes,
    "op13_whitened_vectors": op13_whitened_vectors,
    "pipeline": pipeline,
}

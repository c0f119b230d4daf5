"""Streaming ingest: messages to hourly bronze files, and to the article table.

Every query drains what has arrived and stops; its checkpoint holds the
position, so the next run goes on where this one ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gazette import schemas
from gazette.functions.dates import iso_utc, utc

_BROKEN = "_broken"


def read_kafka(
    spark: SparkSession, servers: str, topic: str, max_per_batch: int | None = None
) -> DataFrame:
    """Messages of a topic, from the earliest on the first run."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load()


def read_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages from text files, one per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _parse(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The article of each message, its text, and why it is not taken (null if it is)."""
    schema = T.StructType([*schemas.BRONZE_BATCH.fields, T.StructField(_BROKEN, T.StringType())])
    record = F.col("value").cast("string")
    parsed = F.from_json(record, schema, {"columnNameOfCorruptRecord": _BROKEN})
    reason = (
        F.when(F.coalesce(F.trim("record"), F.lit("")) == "", "empty message")
        .when(
            F.col("article").isNull()
            | F.col(f"article.{_BROKEN}").isNotNull()
            | ~F.col("record").rlike(r"^\s*\{"),
            "not an article",
        )
        .when(F.coalesce("article.article_id", F.lit("")) == "", "no article_id")
    )
    return messages.select(*keep, record.alias("record"), parsed.alias("article")).withColumn(
        "reason", reason
    )


def decode(
    messages: DataFrame, received_at: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Articles from messages, stamped as streamed; what aside() gives is left out.

    Columns of the messages named in `keep` stay beside the article's.
    """
    if received_at is None:
        received_at = utc(F.current_timestamp())
    valid = _parse(messages, keep).filter("reason IS NULL").select("article.*", *keep).drop(_BROKEN)
    return valid.withColumns(
        {"ingestion_mode": F.lit("streaming"), "stream_received_at": iso_utc(received_at)}
    )


def aside(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The messages decode leaves out (record, reason): empty, broken or without an id."""
    return _parse(messages, keep).filter("reason IS NOT NULL").select("record", "reason", *keep)


def drain_to_hours(messages: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Append articles to date= and hour= folders by time of processing, drain and return.

    Messages that are no articles go to the set_aside folder of the same root in
    the same run, by a query with a position of its own.
    """
    now = utc(F.current_timestamp())
    rejected = (
        aside(messages)
        .writeStream.format("json")
        .option("path", f"{root}/set_aside")
        .option("checkpointLocation", f"{checkpoint}/set_aside")
        .trigger(availableNow=True)
        .start()
    )
    query = (
        decode(messages)
        .withColumns({"date": F.date_format(now, "yyyy-MM-dd"), "hour": F.date_format(now, "HH")})
        .writeStream.format("json")
        .partitionBy("date", "hour")
        .option("path", f"{root}/streaming")
        .option("checkpointLocation", f"{checkpoint}/articles")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rejected.awaitTermination()
    return query

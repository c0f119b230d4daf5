"""Articles as messages: one JSON text per article."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_message_value(articles: DataFrame) -> DataFrame:
    """One column, value: the article as JSON text with its null fields."""
    return articles.select(
        F.to_json(F.struct(*articles.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def publish_kafka(articles: DataFrame, servers: str, topic: str) -> None:
    """Send one message per article. Needs Spark's Kafka connector on the class path."""
    (
        to_message_value(articles)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_files(articles: DataFrame, path: str) -> None:
    """Append the messages as text files, for consumers without a broker."""
    to_message_value(articles).write.mode("append").text(path)

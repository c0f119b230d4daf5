"""Joins against small dimensions, which are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette import constants as C
from gazette import schemas


def sources_dim(spark: SparkSession, sources: list[tuple] = C.SOURCES) -> DataFrame:
    """The configured sources as a table."""
    return spark.createDataFrame(sources, schemas.SOURCE_CONFIG)


def with_country(articles: DataFrame, sources: list[tuple] = C.SOURCES) -> DataFrame:
    """Add source_country from the source configuration, Unknown if not there."""
    dim = sources_dim(articles.sparkSession, sources).select(
        F.col("name").alias("_name"), F.col("country").alias("_country")
    )
    # the driver has the list; as rows of unknown size they would have all articles shuffled
    joined = articles.join(F.broadcast(dim), F.col("source") == F.col("_name"), "left")
    return joined.withColumn("source_country", F.coalesce("_country", F.lit(C.UNKNOWN))).drop(
        "_name", "_country"
    )

"""Bronze: JSON lines below a root, one folder for batch, one for streaming."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette import schemas
from gazette.functions.dates import iso_utc
from gazette.operators.filters import moment


def scan(
    spark: SparkSession, path: str, schema: T.StructType = schemas.BRONZE_STREAM
) -> DataFrame:
    """All JSON lines below a folder. Blank lines are skipped, a broken line fails.

    The date= and hour= folders are an arrangement of files, not columns.
    """
    found = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
    return found.select(*schema.names)


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError("No bronze records found")
    return df


def union(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Batch and stream together; columns only one of them has are null elsewhere."""
    return batch.unionByName(stream, allowMissingColumns=True)


def stamp_batch(articles: DataFrame, as_of: datetime) -> DataFrame:
    return articles.withColumns(
        {"ingestion_mode": F.lit("batch"), "ingested_at": iso_utc(moment(as_of))}
    )


def write_hour(articles: DataFrame, root: str, as_of: datetime) -> None:
    """Write the run's hour folder; a rerun within the hour replaces it."""
    stamped = stamp_batch(articles, as_of).withColumns(
        {"date": F.lit(f"{as_of:%Y-%m-%d}"), "hour": F.lit(f"{as_of:%H}")}
    )
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "hour")
        .json(f"{root}/batch")
    )


def write_snapshot(articles: DataFrame, root: str, as_of: datetime) -> None:
    """Keep this run's articles next to those of earlier runs."""
    articles.write.mode("errorifexists").json(f"{root}/run_ts={as_of:%Y%m%d_%H%M%S}")

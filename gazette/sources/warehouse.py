"""Published tables: every load is a new version, visible once it is complete.

A version is a folder of parquet tables that is never written again. Writing one
changes nothing for readers; a row in the commits log, appended after the last
table, does. The log numbers the versions, so the current one is the last that
was committed, whatever time it is for.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.operators.filters import moment

_COMMITS = "sequence long, version string, committed_at timestamp_ntz"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_COMMITS).parquet(f"{root}/commits")


def _last(spark: SparkSession, root: str) -> int:
    try:
        return _commits(spark, root).agg(F.max("sequence")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0  # nothing has been published yet


def published(spark: SparkSession, root: str) -> bool:
    """Whether there is a version."""
    return _last(spark, root) > 0


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], as_of: datetime) -> str:
    """Write all tables of a new version, then make them current together; its name."""
    version = f"{as_of:%Y%m%d_%H%M%S}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{root}/versions/{version}/{name}")
    commit = spark.range(1).select(
        F.lit(_last(spark, root) + 1).cast("long").alias("sequence"),
        F.lit(version).alias("version"),
        moment(as_of).alias("committed_at"),
    )
    commit.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return version


def current_version(spark: SparkSession, root: str) -> str:
    """The version committed last."""
    last = _commits(spark, root).orderBy(F.desc("sequence"), F.desc("version")).limit(1)
    return last.collect()[0]["version"]


def read(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    version = version or current_version(spark, root)
    return spark.read.parquet(f"{root}/versions/{version}/{table}")


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Replace each table's folder; the tables must not read from there."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def write_run_snapshot(df: DataFrame, root: str, as_of: datetime, run: str | None = None) -> None:
    """Keep this run's rows next to those of earlier runs.

    A run with a name replaces its own snapshot when it is repeated.
    """
    path = f"{root}/run_ts={as_of:%Y%m%d_%H%M%S}"
    if run is None:
        df.write.mode("errorifexists").parquet(path)
    else:
        df.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition: tuple[str, str, str, int] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table; with partition (column, lower, upper, tasks) read in parallel.

    Needs the database's JDBC driver on the class path.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition:
        column, lower, upper, tasks = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", tasks)
        )
    return reader.options(**(properties or {})).load()

"""Time and source filters; each is one predicate that reaches the scan."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C


def moment(as_of: datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def recent_hour(df: DataFrame, as_of: datetime) -> DataFrame:
    """Rows whose event time lies in the hour before as_of."""
    return df.filter(F.col("scraped_at") > moment(as_of - timedelta(hours=1)))


def event_time(df: DataFrame) -> DataFrame:
    """Add scraped_at: when the article was taken in, else when it was created."""
    return df.withColumn("scraped_at", F.coalesce("ingested_at", "created_at"))


def last_24_hours(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.filter(F.col("published_at") >= moment(as_of - timedelta(hours=24)))


def day_window(df: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Days of the window; the widest window is no filter and keeps undated rows."""
    if days >= C.UNBOUNDED_WINDOW_DAYS:
        return df
    return df.filter(F.col("published_day") >= F.lit(as_of.date() - timedelta(days=days)))


def for_source(df: DataFrame, source: str) -> DataFrame:
    if source == C.ALL_SOURCES:
        return df
    return df.filter(F.col("source") == F.lit(source))

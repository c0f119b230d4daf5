"""Gold aggregates and the dashboard's reads of them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions import text
from gazette.operators.filters import day_window, for_source, last_24_hours, moment
from gazette.session import shared_dir

# Gold table -> the key it counts articles by.
COUNT_KEYS = {
    "articles_by_day": "published_day",
    "articles_by_source": "source",
    "articles_by_theme": "theme",
    "articles_by_country": "source_country",
    "articles_by_category": "category",
}
LAKE_TABLES = [
    "articles_by_day", "articles_by_source", "articles_by_theme", "articles_by_country",
]
WAREHOUSE_TABLES = [*LAKE_TABLES, "articles_by_category"]


def with_published_day(df: DataFrame) -> DataFrame:
    return df.withColumn("published_day", F.to_date("published_at"))


def with_theme(df: DataFrame, body: str) -> DataFrame:
    lowered = df.withColumn("_lowered", text.theme_text(F.col("title"), F.col(body)))
    return lowered.withColumn("theme", text.theme(F.col("_lowered"))).drop("_lowered")


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Articles per key; the null key is a group of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("articles_count"))


def count_tables(facts: DataFrame, tables: list[str]) -> dict[str, DataFrame]:
    """Several count tables from one pass over the articles.

    The articles are first counted by all keys together. That frame has a row
    per combination of keys, so the tables roll up from it and the article
    text is read only once. The checkpoint keeps it that way if executors are
    lost before the last table is written.
    """
    keys = [COUNT_KEYS[t] for t in tables]
    shared_dir(facts.sparkSession)
    combined = count_by(facts, *keys).checkpoint()
    return {
        t: combined.groupBy(COUNT_KEYS[t]).agg(F.sum("articles_count").alias("articles_count"))
        for t in tables
    }


def top_keywords(
    df: DataFrame, column: str, n: int, stopwords: list[str] = C.STOPWORDS
) -> DataFrame:
    """Most frequent keywords of a text column; equal frequencies go by keyword."""
    words = df.select(F.explode(text.keywords(F.col(column))).alias("keyword"))
    counted = (
        words.filter(~F.col("keyword").isin(stopwords))
        .groupBy("keyword")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    return counted.orderBy(F.col("frequency").desc(), "keyword").limit(n)


def stamped(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumn("last_updated", moment(as_of))


# Summaries


def _score() -> Column:
    """The score as the silver table stores it; exact, so averages are too."""
    return F.col("data_quality_score").cast("decimal(3,2)")


def kpi_metrics(detail: DataFrame, as_of: datetime) -> DataFrame:
    """Four headline numbers in one pass."""
    today = F.to_date("published_at") == F.lit(as_of.date())
    return detail.agg(
        F.count(F.lit(1)).alias("total_articles"),
        F.count_if(today).alias("articles_today"),
        F.count_if(F.col("quarantine")).alias("quarantined_articles"),
        F.count_distinct("source").alias("unique_sources"),
    )


def analytics_summary(silver: DataFrame, as_of: datetime) -> DataFrame:
    """Headline numbers with average quality and languages seen, as one row."""
    today = F.to_date("published_at") == F.lit(as_of.date())
    # counted per pair of keys first: two distinct counts over the articles
    # themselves would make Spark triple every row
    per_pair = silver.groupBy("source", "detected_language").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(today).alias("today"),
        F.count_if(F.col("quarantine")).alias("flagged"),
        F.sum(_score()).alias("score"),
        F.count(_score()).alias("scored"),
    )
    zero = F.lit(0)
    return per_pair.agg(
        moment(as_of).alias("summary_timestamp"),
        F.coalesce(F.sum("n"), zero).alias("total_articles"),
        F.coalesce(F.sum("today"), zero).alias("articles_today"),
        F.coalesce(F.sum("flagged"), zero).alias("quarantined_articles"),
        F.count_distinct("source").alias("unique_sources"),
        F.try_divide(F.sum("score"), F.sum("scored"))
        .cast("decimal(3,2)")
        .alias("avg_quality_score"),
        F.count_distinct("detected_language").alias("languages_detected"),
    )


def daily_article_trends(silver: DataFrame) -> DataFrame:
    """Volume, length and quality per day and source."""
    dated = silver.filter(F.col("published_at").isNotNull())
    return dated.groupBy(F.to_date("published_at").alias("trend_date"), "source").agg(
        F.count(F.lit(1)).alias("articles_count"),
        F.round(F.avg("word_count")).cast("int").alias("avg_word_count"),
        F.try_divide(F.sum(_score()), F.count(_score()))
        .cast("decimal(3,2)")
        .alias("avg_quality_score"),
    )


def hourly_by_source(
    detail: DataFrame, as_of: datetime, source: str = C.ALL_SOURCES
) -> DataFrame:
    """Articles per hour and source over the last 24 hours."""
    hour = F.date_trunc("hour", "published_at").cast("timestamp_ntz").alias("published_hour")
    recent = last_24_hours(for_source(detail, source), as_of)
    return (
        recent.groupBy(hour, "source")
        .agg(F.count(F.lit(1)).alias("articles_count"))
        .orderBy("published_hour", "source")
    )


# Reads of the gold tables


def ranked(counts: DataFrame, key: str) -> DataFrame:
    """Counts from high to low; equal counts go by key."""
    return counts.orderBy(F.col("articles_count").desc(), F.col(key).asc_nulls_last())


def top_source(by_source: DataFrame, source: str = C.ALL_SOURCES) -> DataFrame:
    """The largest source, or N/A with 0 articles where there is none."""
    best = ranked(for_source(by_source, source), "source").limit(1)
    found = best.agg(
        F.first("source").alias("source"), F.first("articles_count").alias("articles_count")
    )
    return found.select(
        F.when(F.col("articles_count").isNull(), "N/A").otherwise(F.col("source")).alias("source"),
        F.coalesce("articles_count", F.lit(0).cast("bigint")).alias("articles_count"),
    )


def total_articles(
    by_day: DataFrame, by_source: DataFrame, as_of: datetime, days: int, source: str
) -> DataFrame:
    """Articles of one source, or of the days in the window."""
    counted = (
        day_window(by_day, as_of, days)
        if source == C.ALL_SOURCES
        else for_source(by_source, source)
    )
    return counted.agg(F.coalesce(F.sum("articles_count"), F.lit(0)).alias("total"))


def day_trend(by_day: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return day_window(by_day, as_of, days).orderBy(F.col("published_day").asc_nulls_last())


def top_by_frequency(keyword_table: DataFrame, n: int) -> DataFrame:
    return (
        keyword_table.select("keyword", "frequency")
        .orderBy(F.col("frequency").desc(), "keyword")
        .limit(n)
    )


def latest_for_source(detail: DataFrame, source: str, n: int = C.RECENT_PER_SOURCE) -> DataFrame:
    """Most recent articles of one source; undated ones count as most recent."""
    order = [F.col("published_at").desc_nulls_first(), F.col("article_id")]
    return for_source(detail, source).orderBy(*order).limit(n)


def distinct_sources(by_source: DataFrame) -> DataFrame:
    return by_source.select("source").distinct().orderBy(F.col("source").asc_nulls_last())


def source_options(by_source: DataFrame, configured: list[tuple] = C.SOURCES) -> DataFrame:
    """Choices of the source filter: all, then configured, then the table's others."""
    spark = by_source.sparkSession
    names = [C.ALL_SOURCES] + [name for name, *_ in configured]
    fixed = spark.createDataFrame(list(enumerate(names)), "position long, source string")
    found = by_source.select(F.lit(len(names)).cast("bigint").alias("position"), "source")
    return (
        fixed.unionByName(found)
        .groupBy("source")
        .agg(F.min("position").alias("position"))
        .orderBy("position", F.col("source").asc_nulls_last())
    )

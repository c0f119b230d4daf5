"""Gold counts kept up by batches: what a batch takes away and what it adds.

A batch's rows as they were before count -1, as they are afterwards +1. Only keys
whose count changes are left, so the stored counts grow with the changes, not with
the articles, and their sums are the counts over the whole table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions import text
from gazette.operators import gold
from gazette.operators.filters import moment
from gazette.operators.lookups import with_country

#: Columns of articles that the counts depend on.
ARTICLE_COLUMNS = ["title", "author", "content", "source", "category", "published_at"]
SILVER_COLUMNS = [
    "published_at", "source", "word_count", "data_quality_score", "content_length"
]
COUNT_KEYS = ["published_day", "source", "theme", "category"]
INVALID_DATES = "invalid_dates"
CHECKS = [
    "articles_detail.title_null", "articles_detail.author_null", "articles_detail.content_null",
    INVALID_DATES, "negative_lengths", "invalid_scores",
]
TREND_KEYS = ["trend_date", "source"]
TREND_SUMS = ["articles", "words", "counted", "score", "scored"]


def signed(before: DataFrame | None, after: DataFrame | None, columns: list[str]) -> DataFrame:
    """The rows before with sign -1 and after with +1; either may be missing."""
    parts = [
        df.select(*columns, F.lit(sign).cast("long").alias("sign"))
        for df, sign in ((before, -1), (after, 1))
        if df is not None
    ]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _net(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    total = df.groupBy(*keys).agg(
        *[F.sum(s).cast(df.schema[s].dataType).alias(s) for s in sums]
    )
    return total.where(" or ".join(f"{s} <> 0" for s in sums))


def article_counts(changed: DataFrame) -> DataFrame:
    """Change of the number of articles per day, source, theme and category."""
    keyed = gold.with_theme(gold.with_published_day(changed), "content")
    return _net(keyed.select(*COUNT_KEYS, F.col("sign").alias("n")), COUNT_KEYS, ["n"])


def keyword_counts(changed: DataFrame) -> DataFrame:
    """Change of the frequency of every keyword of the titles, stop words included."""
    words = changed.select(F.explode(text.keywords(F.col("title"))).alias("keyword"), F.col("sign").alias("n"))
    return _net(words, ["keyword"], ["n"])


def trend_counts(changed: DataFrame) -> DataFrame:
    """Change of the sums that the daily trends are made of; undated articles have none."""
    dated = changed.where(F.col("published_at").isNotNull())
    score = F.col("data_quality_score").cast("decimal(3,2)")
    rows = dated.select(
        F.to_date("published_at").alias("trend_date"),
        "source",
        F.col("sign").alias("articles"),
        (F.coalesce("word_count", F.lit(0)) * F.col("sign")).cast("long").alias("words"),
        F.when(F.col("word_count").isNotNull(), F.col("sign")).otherwise(0).cast("long").alias("counted"),
        (F.coalesce(score, F.lit(0)) * F.col("sign")).cast("decimal(28,2)").alias("score"),
        F.when(score.isNotNull(), F.col("sign")).otherwise(0).cast("long").alias("scored"),
    )
    return _net(rows, TREND_KEYS, TREND_SUMS)


def _named(changed: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Change of the number of rows that meet each rule, with their time where it matters."""
    met = F.array(
        *[F.when(rule, F.lit(name)) for name, rule in rules.items()]
    )
    rows = changed.select(F.explode(F.array_compact(met)).alias("name"), "published_at", F.col("sign").alias("n"))
    timed = F.when(F.col("name") == INVALID_DATES, F.col("published_at"))
    return _net(rows.withColumn("published_at", timed), ["name", "published_at"], ["n"])


def article_checks(changed: DataFrame, as_of: datetime) -> DataFrame:
    """Change of the counters of the articles' checks.

    Articles dated after their batch are counted by their date, as they stop being
    in the future; the others never are.
    """
    blank = {
        f"articles_detail.{c}_null": text.blank_if_null(F.col(c)) == "" for c in ("title", "content")
    }
    return _named(
        changed,
        {
            **blank,
            "articles_detail.author_null": F.col("author") == C.UNKNOWN,
            INVALID_DATES: F.col("published_at") > moment(as_of),
        },
    )


def silver_checks(changed: DataFrame) -> DataFrame:
    """Change of the counters of the silver table's checks."""
    score = F.col("data_quality_score")
    rules = {"negative_lengths": F.col("content_length") < 0, "invalid_scores": (score > 1) | (score < 0)}
    return _named(changed, rules)


def checks(counts: DataFrame, as_of: datetime) -> DataFrame:
    """name and value of the checks that have counters, 0 where nothing was found."""
    spark = counts.sparkSession
    names = spark.createDataFrame([(n,) for n in CHECKS], "name string")
    due = counts.where((F.col("name") != INVALID_DATES) | (F.col("published_at") > moment(as_of)))
    found = due.groupBy("name").agg(F.sum("n").alias("n"))
    return names.join(found, "name", "left").select("name", F.coalesce("n", F.lit(0)).alias("value"))


# The gold tables from the stored counts


def _table(counts: DataFrame, key: str) -> DataFrame:
    total = counts.groupBy(key).agg(F.sum("n").alias("articles_count"))
    return total.where("articles_count <> 0")


def count_tables(
    counts: DataFrame, keywords: DataFrame, as_of: datetime, sources: list[tuple] = C.SOURCES
) -> dict[str, DataFrame]:
    """The warehouse's gold tables; the country follows from the source as configured now."""
    placed = with_country(counts, sources)
    tables = {name: _table(placed, gold.COUNT_KEYS[name]) for name in gold.WAREHOUSE_TABLES}
    kept = keywords.where(~F.col("keyword").isin(C.WAREHOUSE_STOPWORDS))
    words = kept.groupBy("keyword").agg(F.sum("n").alias("frequency")).where("frequency <> 0")
    order = [F.col("frequency").desc(), F.col("keyword")]
    tables["top_keywords"] = words.orderBy(*order).limit(C.WAREHOUSE_TOP_KEYWORDS)
    return {name: gold.stamped(df, as_of) for name, df in tables.items()}


def daily_trends(trends: DataFrame) -> DataFrame:
    total = trends.groupBy(*TREND_KEYS).agg(*[F.sum(s).alias(s) for s in TREND_SUMS])
    return total.where("articles <> 0").select(
        *TREND_KEYS,
        F.col("articles").alias("articles_count"),
        F.round(F.try_divide("words", "counted")).cast("int").alias("avg_word_count"),
        F.try_divide("score", "scored").cast("decimal(3,2)").alias("avg_quality_score"),
    )

"""Silver: cleaned articles, for the lake and for the warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions import dates, html, language, text
from gazette.operators.filters import event_time, moment, recent_hour
from gazette.operators.language_model import UNKNOWN, LanguageProfile, with_language
from gazette.operators.ranking import keep_last


def with_lake_defaults(bronze: DataFrame) -> DataFrame:
    """Missing titles are empty, missing names are Unknown; all are normalised."""
    unknown = F.lit(C.UNKNOWN)
    return bronze.withColumns(
        {
            "title": text.normalize_text(F.col("title")),
            **{
                c: text.normalize_text(F.coalesce(c, unknown))
                for c in ("author", "category", "source")
            },
        }
    )


def with_lake_content(bronze: DataFrame) -> DataFrame:
    """Add content_clean, content_from_html and content_final."""
    cleaned = bronze.withColumns(
        {
            "content_clean": text.normalize_text(F.col("content")),
            "content_from_html": F.coalesce(html.visible_text(F.col("content_html")), F.lit("")),
        }
    )
    fallback = text.normalize_text(F.col("content_from_html"))
    return cleaned.withColumn(
        "content_final", F.coalesce(text.null_if_blank(F.col("content_clean")), fallback)
    )


def lake_silver(bronze: DataFrame, profile: LanguageProfile | None = None) -> DataFrame:
    """Latest scrape of every URL, cleaned, with its language (unknown without a profile).

    The choice depends on raw columns only, so it comes first and only the
    rows that stay are cleaned and scored, each within its row.
    """
    return cleaned(latest_by_url(bronze), profile)


def cleaned(latest: DataFrame, profile: LanguageProfile | None = None) -> DataFrame:
    """Bronze rows as silver rows, each within its row."""
    dated = latest.withColumn("published_at", dates.parse_timestamp(F.col("published_at")))
    silver = with_lake_content(with_lake_defaults(dated))
    if profile is None:
        return silver.withColumn("language", F.lit(UNKNOWN))
    return with_language(silver, "content_final", profile)


def _url_key() -> Column:
    """A key that is not null; a missing URL differs from every URL."""
    return F.struct(F.col("url").isNotNull().alias("has"), F.coalesce("url", F.lit("")).alias("url"))


def latest_by_url(articles: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The latest scrape of every URL; missing URLs are one."""
    keyed = articles.withColumn("_url", _url_key())
    return keep_last(keyed, "_url", within).drop("_url")


def with_warehouse_text(articles: DataFrame) -> DataFrame:
    """Add clean text, its measures, the language vote and the quality score."""
    cleaned = articles.withColumns(
        {
            "content_clean": html.html_to_text(F.col("content")),
            "title_normalized": text.normalize_title(F.col("title")),
        }
    )
    measured = cleaned.withColumns(
        {
            "content_length": text.char_count(F.col("content_clean")),
            "word_count": text.word_count_collapsed(F.col("content_clean")),
            "_votes": language.vote_counts(F.col("content_clean")),
        }
    )
    score = text.quality_score(F.col("content_length"), F.col("word_count"), F.col("title"))
    return measured.withColumns(
        {
            "detected_language": language.vote_winner(F.col("content_clean"), F.col("_votes")),
            "data_quality_score": score,
        }
    ).drop("_votes")


def warehouse_silver(detail: DataFrame, as_of: datetime) -> DataFrame:
    """Silver rows for the articles taken in during the last hour."""
    fresh = recent_hour(event_time(detail), as_of)
    columns = [
        "article_id", "title", "author", "content", "source", "category",
        "published_at", "url", "canonical_url", "scraped_at",
    ]
    return with_warehouse_text(fresh.select(*columns)).withColumn(
        "silver_timestamp", moment(as_of)
    )


def as_silver_table(silver: DataFrame, quarantine: Column | None = None) -> DataFrame:
    """The rows with the table's types; the flag defaults to false."""
    return silver.withColumns(
        {
            "quarantine": F.lit(False) if quarantine is None else quarantine,
            "data_quality_score": F.col("data_quality_score").cast("decimal(3,2)"),
        }
    )

"""Articles from landed pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C
from gazette import schemas
from gazette.functions import dates, html, urls
from gazette.functions.text import null_if_blank
from gazette.operators.filters import moment
from gazette.operators.ranking import first_n, first_n_per_source


def first_category(tags: Column) -> Column:
    """Term of the first tag, Unknown without one."""
    return F.coalesce(F.get(tags, 0)["term"], F.lit(C.UNKNOWN))


def published_text(published: Column, updated: Column) -> Column:
    """Publication time, else update time, as ISO-8601 text in UTC."""
    given = F.coalesce(null_if_blank(published), updated)
    return dates.iso_utc(dates.parse_timestamp(given))


def extract_articles(entries: DataFrame, as_of: datetime, limit_per_source: int) -> DataFrame:
    """Bronze articles from feed entries with their landed pages.

    Entries carry source, source_country, source_pos, feed_pos, url, html,
    title, author, published, updated and tags. The first entries of every
    feed count, including unusable ones. They are chosen by position alone, so
    only the chosen pages are read whole and none of them is shuffled before.
    """
    place = ["source", "feed_pos"]
    first = first_n_per_source(entries.select(*place), limit_per_source)
    chosen = entries.join(first, place, "left_semi").filter(
        F.col("url") != ""
    )
    cleaned = chosen.withColumn("html", html.drop_boilerplate(F.col("html")))
    parsed = cleaned.select(
        "source",
        "source_country",
        "source_pos",
        "feed_pos",
        "url",
        html.best_title(F.col("html"), F.col("title")).alias("title"),
        F.coalesce("author", F.lit(C.UNKNOWN)).alias("author"),
        published_text(F.col("published"), F.col("updated")).alias("published_at"),
        first_category(F.col("tags")).alias("category"),
        html.paragraph_html(F.col("html")).alias("content_html"),
        F.array_join(html.paragraph_texts(F.col("html")), "\n").alias("content"),
        html.canonical_url(F.col("html")).alias("canonical_url"),
        dates.iso_utc(moment(as_of)).alias("scraped_at"),
    )
    identified = parsed.withColumn(
        "article_id", urls.article_id(F.col("canonical_url"), F.col("url"))
    )
    # untitled entries rank last and go after the choice: as a filter before it,
    # the title of every page would be worked out ahead of the join above
    order = [F.col("title") == "", F.col("source_pos"), F.col("feed_pos")]
    unique = first_n(identified, ["article_id"], order, 1)
    return unique.filter(F.col("title") != "").select(*schemas.BRONZE.names)

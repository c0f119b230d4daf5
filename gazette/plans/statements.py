"""The dashboard's statements as SQL text with bound parameters.

Values never become part of the text, so a source name may hold quotes. Tables
are named in braces and stand for frames, read from wherever they are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATEMENTS = {
    "source_total": """
        SELECT coalesce(sum(articles_count), 0) AS total
        FROM {articles_by_source} WHERE source = :source""",
    "window_total": """
        SELECT coalesce(sum(articles_count), 0) AS total FROM {articles_by_day}
        WHERE published_day >= date_sub(:today, :days)""",
    "top_source": """
        SELECT source, articles_count FROM {articles_by_source}
        ORDER BY articles_count DESC, source NULLS LAST LIMIT 1""",
    "recent_of_source": """
        SELECT article_id, title, author, published_at, url, quarantine FROM {articles_detail}
        WHERE source = :source ORDER BY published_at DESC NULLS FIRST, article_id LIMIT :rows""",
    "hourly_of_source": """
        SELECT CAST(date_trunc('hour', published_at) AS timestamp_ntz) AS published_hour,
          count(*) AS articles_count
        FROM {articles_detail} WHERE source = :source AND published_at >= :since
        GROUP BY 1 ORDER BY 1""",
    "day_series": """
        SELECT published_day, articles_count FROM {articles_by_day}
        WHERE published_day >= date_sub(:today, :days) ORDER BY published_day""",
}


def run(spark: SparkSession, tables: dict[str, DataFrame], name: str, **parameters) -> DataFrame:
    """The result of a statement over tables, given by the names in its text."""
    text = STATEMENTS[name]
    used = {table: df for table, df in tables.items() if f"{{{table}}}" in text}
    return spark.sql(text, args=parameters or None, **used)

"""Per-key choice of rows: keep first, keep last, first N, most recent N.

Each is a ranked window with a bound on the rank, which Spark turns into a
group limit before the shuffle: a task passes on at most N rows of a key, so
a key that holds a third of the table does not travel to one task whole.

Where keys are few (sources, languages) every task passes on rows of every
key. Those choices go through an intermediate round that many tasks share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette import constants as C

# Tasks that share the intermediate round of one key.
SPREAD = 256


def _limit(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def first_n(
    df: DataFrame, keys: list[str], order: list[Column], n: int, few_keys: bool = False
) -> DataFrame:
    """The first n rows of every key; the order must be total for a stable result."""
    if few_keys:
        # one salt per task, so the limit before the shuffle loses nothing by it;
        # whatever the salt, the first n of all rows are among those it lets pass
        salted = df.withColumn("_salt", F.spark_partition_id() % SPREAD)
        df = _limit(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _limit(df, keys, order, n)


def first_n_per_source(df: DataFrame, n: int) -> DataFrame:
    """The first entries of every feed, in feed order."""
    return first_n(df, ["source"], [F.col("feed_pos")], n, few_keys=True)


def keep_first(df: DataFrame) -> DataFrame:
    """First article of an identity, by source and feed order; no id, no row."""
    known = df.filter(F.col("article_id") != "")
    return first_n(known, ["article_id"], [F.col("source_pos"), F.col("feed_pos")], 1)


def keep_last(df: DataFrame, key: str = "url", within: Sequence[str] = ()) -> DataFrame:
    """Latest scrape of a URL; rows that are dealt out by `within`, which follows from it, stay in place.

    A missing scrape time counts as latest and missing URLs are one URL. The
    same article usually arrives by batch and by stream with one scrape time:
    the streamed copy wins, then the smaller article_id.
    """
    order = [
        F.col("scraped_at").desc_nulls_first(),
        F.col("ingestion_mode").desc_nulls_last(),
        *[
            F.col(c).asc_nulls_last()
            for c in ("article_id", "published_at", "title", "content")
        ],
    ]
    return first_n(df, [*within, key], order, 1)


def recent_per_source(df: DataFrame, n: int = C.RECENT_PER_SOURCE) -> DataFrame:
    """Most recent articles of every source; undated ones count as most recent."""
    order = [F.col("published_at").desc_nulls_first(), F.col("article_id")]
    return first_n(df, ["source"], order, n, few_keys=True).orderBy(
        "source", F.col("published_at").desc_nulls_first(), "article_id"
    )

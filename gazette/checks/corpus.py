"""News articles derived from the given tables, all rows and whole texts.

Every document becomes one article and every page one feed entry. Defects the
operators must handle (missing fields, menu titles, broken URLs, repeats) are
assigned by row number; oracle.py derives the same rows in SQL.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions.dates import iso_utc
from gazette.operators.filters import moment
from gazette.operators.lookups import with_country
from gazette.operators.quarantine import with_quarantine
from gazette.operators.ranking import first_n

AS_OF = datetime(2024, 1, 31, 1, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A text table; with spark.gazette.spread set, dealt to that many tasks first.

    A small table is one file with one row group, hence one task; who knows this of
    the input sets the number. Otherwise the table is read as it is.
    """
    df = table(spark, sf_dir, name)
    spread = spark.conf.get("spark.gazette.spread", None)
    return df.repartition(int(spread), key) if spread else df


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _minutes_after(start: str, minutes: Column) -> Column:
    days, hours = F.lit(0), F.lit(0)
    return F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(days, hours, minutes.cast("int"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document."""
    k = F.col("doc_id")
    headline = F.regexp_extract("text", r"^[^.!?\n]*", 0)
    even = k % 2 == 0
    per_fifty = F.floor(k / 50)
    source = (
        F.when(k % 61 == 15, F.lit(None))
        .when(k % 5 == 0, "BBC News")
        .when(k % 5 == 1, "Reuters World")
        .when(k % 5 == 2, "Hespress")
        .when(k % 5 == 3, "France24")
        .otherwise(F.col("source"))
    )
    title = (
        F.when(k % 17 == 1, F.lit(None))
        .when(k % 23 == 2, "")
        .when(k % 29 == 3, "Read more")
        .when(k % 19 == 4, F.upper(F.replace(headline, F.lit("ß"), F.lit("ss"))))
        .when(k % 31 == 5, "?!?!--..ab")
        .when(k % 37 == 6, "Short")
        .otherwise(headline)
    )
    url = (
        F.when(k % 13 == 7, F.lit(None))
        .when(k % 11 == 8, _text("ftp://files.example.com/", k))
        .when((k % 5 == 0) & even, _text("https://www.bbc.com/news/", per_fifty))
        .when((k % 5 == 1) & even, _text("https://www.reuters.com/world/", per_fifty))
        .when((k % 5 == 2) & even, _text("https://fr.hespress.com/", per_fifty, ".html"))
        .otherwise(
            _text("https://news.example.org/", F.col("lang"), "/", F.floor(k / 4))
        )
    )
    canonical = (
        F.when(k % 53 == 14, "http://[::1/x")
        .when(k % 59 == 16, "https://www.bbc.com/sport;v=1")
        .when(k % 71 == 17, "http://[::1]/x")
        .when(k % 73 == 18, "http://[::g]/x")
        .when(k % 79 == 19, "http://a[b]/x")
        .when(k % 83 == 20, "http://[2001:db8::7%eth0]:80/x")
        .when(k % 89 == 21, "http://[1:2:3:4:5:6:7:8:9]/x")
    )
    escaped = F.replace(
        F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"), F.lit("&gt;"),
    )
    body = F.replace(escaped, F.lit("\n"), F.lit("</p>\n<p>"))
    published = (
        F.when(k % 37 == 11, F.lit(None))
        .when(k % 47 == 12, _minutes_after("2024-03-01", k % 60))
        .otherwise(_minutes_after("2024-01-01", (k * 43) % 43200))
    )
    identity = F.coalesce(F.col("url"), _text("doc", k))
    return (
        texts(spark, sf_dir, "documents", "doc_id")
        .select(
            "doc_id",
            "lang",
            title.alias("title"),
            F.when(k % 9 == 0, F.lit(None))
            .when(k % 10 == 1, "Unknown")
            .otherwise(_text("author", k % 40))
            .alias("author"),
            published.alias("published_at"),
            F.when(k % 7 != 0, F.col("lang")).alias("category"),
            _text("<html><body>\n<p>", body, "</p>\n</body></html>").alias("content_html"),
            F.when(k % 41 == 10, F.lit(None))
            .when(k % 43 == 9, "")
            .otherwise(F.col("text"))
            .alias("content"),
            source.alias("source"),
            url.alias("url"),
            canonical.alias("canonical_url"),
            F.when(k % 97 != 50, _minutes_after("2024-01-30 22:00:00", (k * 7) % 180)).alias(
                "scraped_at"
            ),
        )
        .withColumn("article_id", F.substring(F.sha2(identity, 256), 1, 24))
    )


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles as rows of the article table, judged by the rules."""
    taken_in = F.make_dt_interval((F.col("doc_id") % 20).cast("int"))
    return with_quarantine(articles(spark, sf_dir)).withColumns(
        {
            "ingested_at": F.col("scraped_at") - taken_in,
            "created_at": F.lit("2024-01-01").cast("timestamp_ntz"),
        }
    )


def _one_per_article(df: DataFrame) -> DataFrame:
    return first_n(df, ["article_id"], [F.col("doc_id")], 1)


def _in_last_hour() -> Column:
    return F.coalesce(F.col("scraped_at") > F.lit("2024-01-31").cast("timestamp_ntz"), F.lit(False))


def existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article table before the last hour; its flags are older judgements."""
    before = _one_per_article(detail(spark, sf_dir).filter(~_in_last_hour()))
    return before.withColumn("quarantine", F.col("doc_id") % 2 == 0)


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles of the last hour, judged; taken in when they were scraped."""
    fresh = _one_per_article(detail(spark, sf_dir).filter(_in_last_hour()))
    return fresh.withColumn("ingested_at", F.col("scraped_at"))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of the flagged articles, and of labelled documents that may be gone."""
    marked = existing(spark, sf_dir).filter("quarantine")
    reason = F.when(F.col("doc_id") % 4 == 0, "retroactive-backfill").otherwise("title_missing")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1")
    gone = F.substring(F.sha2(_text("doc", F.col("doc_id")), 256), 1, 24)
    columns = [
        F.lit("mark").alias("action"),
        F.lit("system").alias("performed_by"),
    ]
    when = F.lit("2024-01-30").cast("timestamp_ntz").alias("performed_at")
    return marked.select("article_id", *columns, reason.alias("reason"), when).unionByName(
        toxic.select(
            gone.alias("article_id"), *columns, F.lit("title_generic").alias("reason"), when
        )
    )


def bronze_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles as batch bronze: text as it arrives."""
    rows = with_country(articles(spark, sf_dir)).withColumns(
        {
            "published_at": F.when(F.col("doc_id") % 67 == 20, "not a date").otherwise(
                iso_utc(F.col("published_at"))
            ),
            "scraped_at": iso_utc(F.col("scraped_at")),
        }
    )
    return rows.withColumns(
        {"ingestion_mode": F.lit("batch"), "ingested_at": iso_utc(moment(AS_OF))}
    ).drop("doc_id", "lang")


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles of the last hour once more, as they came by stream."""
    recent = bronze_batch(spark, sf_dir).filter(F.col("scraped_at") > iso_utc(
        F.lit("2024-01-31").cast("timestamp_ntz")
    ))
    return recent.withColumns(
        {"ingestion_mode": F.lit("streaming"), "stream_received_at": F.col("scraped_at")}
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed entry per page; a third of them come from one source.

    Some pages get the head tags the raw pages lack: canonical links, og:url
    and og:title by property and by name, in both attribute orders.
    """
    k = F.col("page_id")
    site = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    bare = F.regexp_extract("url", "^([^?#]*)", 1)
    name = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    head = (
        F.when(k % 5 == 0, _text('<link rel="canonical" href="', site, '/home">'))
        .when(
            k % 5 == 1,
            _text(
                '<link href="', site, '" rel="canonical"><meta property="og:url" content="', bare,
                '"><meta property="og:title" content="', name, ' - The Site | World">',
            ),
        )
        .when(
            k % 5 == 2,
            _text(
                '<meta content="', bare, '" name="og:url">',
                '<meta content="Sport live" name="og:title">',
                "<noscript><p>Please switch on scripts to read the whole story</p></noscript>",
            ),
        )
        .when(k % 5 == 3, '<meta property="og:title" content="">')
        .otherwise("")
    )
    when = _minutes_after("2024-01-01 10:00:00", k)
    slot = k % 6
    return texts(spark, sf_dir, "pages", "page_id").select(
        "page_id",
        F.when(slot <= 1, "BBC News").when(slot == 2, "Reuters World").when(slot == 3, "Hespress")
        .when(slot == 4, "France24").otherwise("Local Post").alias("source"),
        F.when(slot <= 3, "International").when(slot == 4, "France").otherwise("Unknown")
        .alias("source_country"),
        F.greatest(slot - 1, F.lit(0)).cast("int").alias("source_pos"),
        k.alias("feed_pos"),
        F.when(k % 11 == 5, "").otherwise(F.col("url")).alias("url"),
        F.replace("html", F.lit("<head>"), F.concat(F.lit("<head>"), head)).alias("html"),
        F.when(k % 9 != 1, _text("Feed story ", k, " — Feed")).alias("title"),
        F.when(k % 4 != 0, _text("author", k % 40)).alias("author"),
        F.when(k % 7 == 0, "")
        .when(k % 7 == 1, _text(F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"), " GMT"))
        .when(k % 7 == 2, _text(F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"), " +0200"))
        .when(k % 7 == 3, "yesterday at noon")
        .otherwise(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("published"),
        F.when(k % 2 == 0, F.date_format(when, "yyyy-MM-dd HH:mm:ss")).alias("updated"),
        F.when(
            k % 8 != 2,
            F.array(F.struct(F.regexp_extract("url", "/([a-z]{2})/", 1).alias("term"))),
        ).alias("tags"),
    )

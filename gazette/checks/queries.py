"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette import constants as C
from gazette import schemas
from gazette.checks import corpus
from gazette.checks.corpus import AS_OF
from gazette.functions import dates, html, language, text, urls
from gazette.operators import extract, filters, gold, lookups, maintenance, quality, ranking
from gazette.operators import quarantine as rules
from gazette.operators.language_model import identify, train
from gazette.plans import gold as gold_plan
from gazette.plans import jobs, statements
from gazette.plans import silver as silver_plan
from gazette.plans.ingest import ingest
from gazette.session import run_dir
from gazette.sources import bronze, config, messages, warehouse
from gazette.streaming import bounded
from gazette.streaming import ingest as stream
from gazette.streaming import upsert as stream_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _detail(spark, sf):
    """The article table: all articles, judged, with the table's columns."""
    return corpus.detail(spark, sf).select(*schemas.ARTICLES_DETAIL.names)


def _existing(spark, sf):
    return corpus.existing(spark, sf).select(*schemas.ARTICLES_DETAIL.names)


def _upserted(spark, sf):
    """The article table after the last hour's upsert: every article once."""
    return ingest(_existing(spark, sf), corpus.incoming(spark, sf), AS_OF).articles


def _bronze(spark, sf):
    return bronze.union(corpus.bronze_batch(spark, sf), corpus.bronze_stream(spark, sf))


def _warehouse_silver(spark, sf):
    """All articles as warehouse silver rows, judged."""
    return silver_plan.with_warehouse_text(corpus.detail(spark, sf))


# Sources and sinks


@register
def bronze_scan(spark, sf):
    """Write batch and stream bronze as JSON lines, read the folder back."""
    root = run_dir(spark, "bronze")
    corpus.bronze_batch(spark, sf).write.json(f"{root}/batch/date=2024-01-31/hour=01")
    corpus.bronze_stream(spark, sf).write.json(f"{root}/streaming/date=2024-01-31/hour=01")
    return bronze.require_rows(bronze.scan(spark, root))


@register
def bronze_batch_sink(spark, sf):
    """Write one hour twice: the second run replaces the first."""
    root = run_dir(spark, "bronze")
    articles = corpus.bronze_batch(spark, sf).select(*schemas.BRONZE.names)
    for _ in range(2):
        bronze.write_hour(articles, root, AS_OF)
    written = spark.read.schema(
        T.StructType(schemas.BRONZE_BATCH.fields + schemas.HOUR_FOLDERS)
    ).json(f"{root}/batch")
    return written.groupBy("date", "hour", "ingestion_mode", "ingested_at").agg(
        F.count(F.lit(1)).alias("articles"), F.count_distinct("article_id").alias("ids")
    )


@register
def bronze_snapshot(spark, sf):
    """Two runs next to each other, counted by run."""
    root = run_dir(spark, "snapshots")
    articles = corpus.bronze_batch(spark, sf).select(*schemas.BRONZE.names)
    bronze.write_snapshot(articles, root, AS_OF.replace(hour=0))
    bronze.write_snapshot(articles.filter("url IS NOT NULL"), root, AS_OF)
    run = T.StructField("run_ts", T.StringType())
    written = spark.read.schema(T.StructType([*schemas.BRONZE.fields, run])).json(root)
    return written.groupBy("run_ts").agg(F.count(F.lit(1)).alias("articles"))


@register
def article_to_json(spark, sf):
    """Articles as messages and back."""
    sent = messages.to_message_value(corpus.bronze_batch(spark, sf))
    parsed = F.from_json("value", schemas.BRONZE_BATCH).alias("a")
    return sent.select(parsed).select("a.*")


@register
def gold_write(spark, sf):
    """Lake gold tables written to files; all rows read back."""
    root = run_dir(spark, "gold")
    silver = silver_plan.lake_silver(_bronze(spark, sf))
    warehouse.write_tables(gold_plan.lake_tables(silver), root)
    keys = {**{t: gold.COUNT_KEYS[t] for t in gold.LAKE_TABLES}, "top_keywords": "keyword"}
    return _long(spark, {t: spark.read.parquet(f"{root}/{t}") for t in keys}, keys)


def _long(spark, tables, keys):
    """Several count tables as rows of (table_name, key, n)."""
    rows = None
    for name, df in tables.items():
        n = "frequency" if name == "top_keywords" else "articles_count"
        part = df.select(
            F.lit(name).alias("table_name"),
            F.col(keys[name]).cast("string").alias("key"),
            F.col(n).alias("n"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


@register
def silver_snapshot(spark, sf):
    """Warehouse silver of the run, kept below its run time."""
    root = run_dir(spark, "silver")
    rows = silver_plan.warehouse_silver(_detail_as_scraped(spark, sf), AS_OF)
    warehouse.write_run_snapshot(rows, root, AS_OF)
    return spark.read.parquet(root).withColumn("run_ts", F.col("run_ts").cast("string"))


def _detail_as_scraped(spark, sf):
    """The article table with the time of the scrape as the time of intake."""
    judged = corpus.detail(spark, sf).withColumn("ingested_at", F.col("scraped_at"))
    return judged.select(*schemas.ARTICLES_DETAIL.names)


@register
def gold_publish(spark, sf):
    """Two loads of the warehouse gold tables; readers see the second whole."""
    root = run_dir(spark, "warehouse")
    detail = _detail(spark, sf)
    undated = detail.filter("published_at IS NULL")
    warehouse.publish(spark, root, gold_plan.warehouse_tables(undated, AS_OF), AS_OF)
    # the later load is current although it is for an earlier time
    warehouse.publish(
        spark, root, gold_plan.warehouse_tables(detail, AS_OF), AS_OF.replace(hour=0)
    )
    keys = {**{t: gold.COUNT_KEYS[t] for t in gold.WAREHOUSE_TABLES}, "top_keywords": "keyword"}
    return _long(spark, {t: warehouse.read(spark, root, t) for t in keys}, keys)


# Extraction from pages


@register
def pages_clean_html(spark, sf):
    pages = corpus.texts(spark, sf, "pages", "page_id")
    return pages.select("page_id", html.drop_boilerplate(F.col("html")).alias("clean_html"))


def _clean_pages(spark, sf):
    return corpus.entries(spark, sf).withColumn("html", html.drop_boilerplate(F.col("html")))


@register
def pages_paragraphs(spark, sf):
    return _clean_pages(spark, sf).select(
        "page_id", F.array_join(html.paragraph_texts(F.col("html")), "\n").alias("content")
    )


@register
def pages_paragraph_html(spark, sf):
    return _clean_pages(spark, sf).select(
        "page_id", html.paragraph_html(F.col("html")).alias("content_html")
    )


@register
def pages_canonical_url(spark, sf):
    return _clean_pages(spark, sf).select(
        "page_id", html.canonical_url(F.col("html")).alias("canonical_url")
    )


@register
def pages_best_title(spark, sf):
    return _clean_pages(spark, sf).select(
        "page_id", html.best_title(F.col("html"), F.col("title")).alias("title")
    )


@register
def article_identity(spark, sf):
    return corpus.articles(spark, sf).select(
        "doc_id", urls.article_id(F.col("canonical_url"), F.col("url")).alias("identity")
    )


@register
def normalize_published_at(spark, sf):
    """Event times written in the shapes feeds use, parsed back."""
    k, ts = F.col("event_id"), F.date_trunc("second", "ts")
    rfc = F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss")
    shape = k % 8
    written = (
        F.when(shape == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(shape == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .when(shape == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(shape == 3, F.concat(rfc, F.lit(" +0200")))
        .when(shape == 4, F.concat(rfc, F.lit(" GMT")))
        .when(shape == 5, F.date_format(ts, "d MMM yyyy HH:mm:ss '+0000'"))
        .when(shape == 6, F.concat(F.lit("around "), rfc))
    )
    events = corpus.table(spark, sf, "events").select("event_id", written.alias("written"))
    return events.select("event_id", dates.parse_timestamp(F.col("written")).alias("published_at"))


@register
def first_category(spark, sf):
    return corpus.entries(spark, sf).select(
        "page_id", extract.first_category(F.col("tags")).alias("category")
    )


@register
def first_n_per_source(spark, sf):
    feed = corpus.entries(spark, sf).select("source", "feed_pos", "url")
    return ranking.first_n_per_source(feed, C.LIMIT_PER_SOURCE_LAKE)


@register
def dedup_keep_first(spark, sf):
    stable = html.canonical_url(F.col("html"))
    feed = corpus.entries(spark, sf).select(
        "source", "source_pos", "feed_pos", urls.article_id(stable, F.col("url")).alias("article_id")
    )
    return ranking.keep_first(feed)


@register
def extract_articles(spark, sf):
    return extract.extract_articles(corpus.entries(spark, sf), AS_OF, C.LIMIT_PER_SOURCE_LAKE)


# Cleaning and scalar functions


@register
def silver_defaults(spark, sf):
    rows = silver_plan.with_lake_defaults(corpus.articles(spark, sf))
    return rows.select("doc_id", "title", "author", "category", "source")


@register
def normalize_text(spark, sf):
    """Document texts with odd white space put in, normalised."""
    odd = F.replace("text", F.lit(", "), F.lit(",   \t"))
    documents = corpus.texts(spark, sf, "documents", "doc_id")
    return documents.select("doc_id", text.normalize_text(odd).alias("normalized"))


@register
def html_to_text(spark, sf):
    pages = corpus.texts(spark, sf, "pages", "page_id")
    return pages.select("page_id", html.html_to_text(F.col("html")).alias("page_text"))


@register
def content_final(spark, sf):
    rows = silver_plan.with_lake_content(corpus.articles(spark, sf))
    return rows.select("doc_id", "content_clean", "content_final")


@register
def title_normalized(spark, sf):
    """Whole document texts through the title whitelist."""
    documents = corpus.texts(spark, sf, "documents", "doc_id")
    return documents.select("doc_id", text.normalize_title(F.col("text")).alias("title_normalized"))


@register
def text_metrics(spark, sf):
    return corpus.texts(spark, sf, "documents", "doc_id").select(
        "doc_id",
        text.char_count(F.col("text")).alias("content_length"),
        text.word_count(F.col("text")).alias("word_count"),
    )


@register
def detect_language_vote(spark, sf):
    articles = corpus.articles(spark, sf)
    voted = articles.withColumn("votes", language.vote_counts(F.col("content")))
    return voted.select(
        "doc_id",
        F.col("votes.fr").alias("fr_votes"),
        F.col("votes.en").alias("en_votes"),
        language.vote_winner(F.col("content"), F.col("votes")).alias("detected_language"),
    )


@register
def detect_language_ngram(spark, sf):
    """Profile from most of the labelled documents, then every document's language."""
    documents = corpus.texts(spark, sf, "documents", "doc_id")
    return identify(documents, "doc_id", "text", _profile(documents))


def _profile(documents):
    """Learnt from documents that are not held out by a hash of their id."""
    held_out = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).isin("0", "1", "2")
    return train(documents.where(~held_out), "text", "lang")


@register
def quality_score(spark, sf):
    rows = silver_plan.with_warehouse_text(corpus.articles(spark, sf))
    score = F.col("data_quality_score")
    return rows.select(
        "doc_id", score, score.cast("decimal(3,2)").alias("score_dec")
    )


@register
def infer_theme(spark, sf):
    rows = gold.with_theme(corpus.articles(spark, sf), "content")
    return rows.select("doc_id", "theme")


# Filters and rules


@register
def recent_hour(spark, sf):
    rows = filters.recent_hour(filters.event_time(_detail_as_scraped(spark, sf)), AS_OF)
    return rows.select("article_id", "title", "scraped_at").orderBy(
        F.col("scraped_at").desc(), "article_id"
    )


@register
def trend_by_day(spark, sf):
    return gold.day_trend(articles_by_day(spark, sf), AS_OF, days=7)


@register
def hourly_by_source(spark, sf):
    return gold.hourly_by_source(corpus.articles(spark, sf), AS_OF)


@register
def articles_for_source(spark, sf):
    rows = filters.for_source(corpus.articles(spark, sf), "Hespress")
    return rows.select("article_id", "source", "title", "published_at")


@register
def quarantine_reasons(spark, sf):
    rows = rules.with_quarantine(corpus.articles(spark, sf))
    return rows.select("doc_id", "quarantine", "reason")


@register
def suspicious_title(spark, sf):
    return corpus.articles(spark, sf).select(
        "doc_id", rules.suspicious_title(F.col("title")).alias("suspicious")
    )


@register
def suspicious_url(spark, sf):
    return corpus.articles(spark, sf).select(
        "doc_id", rules.suspicious_url(F.col("url"), F.col("source")).alias("suspicious")
    )


@register
def split_quarantine(spark, sf):
    """Most recent articles per source, split into shown and held back."""
    recent = ranking.recent_per_source(_detail(spark, sf))
    shown, held = rules.split_quarantine(recent)
    side = [(shown, "reliable"), (held, "quarantined")]
    parts = [df.withColumn("side", F.lit(name)) for df, name in side]
    return parts[0].unionByName(parts[1])


# Joins


@register
def country_lookup(spark, sf):
    return lookups.with_country(corpus.articles(spark, sf)).select(
        "doc_id", "source", "source_country"
    )


@register
def orphan_audit(spark, sf):
    return maintenance.orphans(corpus.audit(spark, sf), _upserted(spark, sf))


@register
def backfill_audit(spark, sf):
    return maintenance.backfill(_upserted(spark, sf), corpus.audit(spark, sf), AS_OF)


# Gold


@register
def articles_by_day(spark, sf):
    return gold.count_by(gold.with_published_day(corpus.articles(spark, sf)), "published_day")


@register
def articles_by_source(spark, sf):
    return gold.count_by(corpus.articles(spark, sf), "source")


@register
def articles_by_theme(spark, sf):
    """Articles per theme of the lake's silver table."""
    silver = silver_plan.lake_silver(_bronze(spark, sf))
    return gold.count_by(gold.with_theme(silver, "content_final"), "theme")


@register
def articles_by_country(spark, sf):
    return gold.count_by(lookups.with_country(corpus.articles(spark, sf)), "source_country")


@register
def articles_by_category(spark, sf):
    return gold.count_by(corpus.articles(spark, sf), "category")


@register
def top_keywords_content(spark, sf):
    silver = silver_plan.lake_silver(_bronze(spark, sf))
    return gold.top_keywords(silver, "content_final", C.LAKE_TOP_KEYWORDS)


@register
def top_keywords_title(spark, sf):
    return gold.top_keywords(
        corpus.articles(spark, sf), "title", C.WAREHOUSE_TOP_KEYWORDS, C.WAREHOUSE_STOPWORDS
    )


@register
def kpi_metrics(spark, sf):
    return gold.kpi_metrics(_detail(spark, sf), AS_OF)


@register
def analytics_summary(spark, sf):
    return gold.analytics_summary(_warehouse_silver(spark, sf), AS_OF)


@register
def daily_article_trends(spark, sf):
    return gold.daily_article_trends(_warehouse_silver(spark, sf))


@register
def total_articles(spark, sf):
    by_day, by_source = articles_by_day(spark, sf), articles_by_source(spark, sf)
    parts = [
        gold.total_articles(by_day, by_source, AS_OF, days, source).select(
            F.lit(source).alias("source"), F.lit(days).alias("days"), "total"
        )
        for days, source in [(7, C.ALL_SOURCES), (30, C.ALL_SOURCES), (7, "BBC News")]
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def quality_report_lake(spark, sf):
    return quality.lake_report(silver_plan.lake_silver(_bronze(spark, sf)))


# Windows


@register
def recent_per_source(spark, sf):
    rows = _detail(spark, sf).select(
        "article_id", "title", "author", "source", "published_at", "url", "quarantine"
    )
    return ranking.recent_per_source(rows)


@register
def dedup_keep_last(spark, sf):
    return ranking.keep_last(_bronze(spark, sf))


# Sorts, limits and sets


@register
def top_source(spark, sf):
    return gold.top_source(articles_by_source(spark, sf))


@register
def sources_ranked(spark, sf):
    return gold.ranked(articles_by_source(spark, sf), "source")


@register
def themes_ranked(spark, sf):
    return gold.ranked(articles_by_theme(spark, sf), "theme")


@register
def latest_for_source(spark, sf):
    rows = corpus.articles(spark, sf).select("article_id", "title", "source", "published_at", "url")
    return gold.latest_for_source(rows, "BBC News")


@register
def keywords_top25(spark, sf):
    return gold.top_by_frequency(top_keywords_title(spark, sf), 25)


@register
def sources_top5(spark, sf):
    return gold.ranked(articles_by_source(spark, sf), "source").limit(5)


@register
def countries_ranked(spark, sf):
    return gold.ranked(articles_by_country(spark, sf), "source_country")


@register
def bronze_union(spark, sf):
    return _bronze(spark, sf)


@register
def distinct_sources(spark, sf):
    return gold.distinct_sources(articles_by_source(spark, sf))


@register
def source_options(spark, sf):
    return gold.source_options(articles_by_source(spark, sf))


# Table maintenance


@register
def upsert_articles(spark, sf):
    return ingest(_existing(spark, sf), corpus.incoming(spark, sf), AS_OF).articles


@register
def quarantine_audit_delta(spark, sf):
    return ingest(_existing(spark, sf), corpus.incoming(spark, sf), AS_OF).audit_delta


@register
def replace_by_key(spark, sf):
    """Silver rows of earlier articles, with the last hour's rows put in."""
    judged = ("quarantine", "silver_timestamp")
    columns = [c for c in schemas.ARTICLES_SILVER.names if c not in judged]
    old = silver_plan.with_warehouse_text(corpus.existing(spark, sf)).select(*columns)
    new = silver_plan.with_warehouse_text(corpus.incoming(spark, sf)).select(*columns)
    return maintenance.replace_by_key(old, new)


@register
def purge_articles(spark, sf):
    return maintenance.purge_articles(_upserted(spark, sf), AS_OF)


@register
def purge_audit(spark, sf):
    return maintenance.purge_audit(corpus.audit(spark, sf), _upserted(spark, sf), AS_OF)


@register
def purge_counts(spark, sf):
    return maintenance.purge_counts(corpus.audit(spark, sf), _upserted(spark, sf), AS_OF)


def _approved_ids(spark, sf):
    """The ids a user approves at once: the quarantined ones that are on show."""
    return rules.quarantined(ranking.recent_per_source(_upserted(spark, sf))).select("article_id")


@register
def approve_articles(spark, sf):
    return maintenance.approve_articles(_upserted(spark, sf), _approved_ids(spark, sf))


@register
def approve_audit(spark, sf):
    return maintenance.approve_audit(_approved_ids(spark, sf), AS_OF)


@register
def evolve_schema(spark, sf):
    """An old article table gains its later columns, existing ones stay."""
    old = _upserted(spark, sf).drop("canonical_url", "quarantine")
    return maintenance.evolve_schema(
        old,
        {
            "canonical_url": F.lit(None).cast("string"),
            "quarantine": F.lit(False),
            "created_at": F.lit(None).cast("timestamp_ntz"),
        },
    )


@register
def transformation_audit(spark, sf):
    rows = silver_plan.with_warehouse_text(corpus.detail(spark, sf)).withColumn(
        "silver_timestamp", filters.moment(AS_OF)
    )
    return maintenance.transformation_audit(rows, AS_OF)


@register
def silver_warehouse(spark, sf):
    """Silver table after a run: last hour's rows in place of their older ones."""
    names = schemas.ARTICLES_SILVER.names
    detail = corpus.existing(spark, sf).select(*schemas.ARTICLES_DETAIL.names)
    ingested = ingest(detail, corpus.incoming(spark, sf), AS_OF).articles
    old = silver_plan.with_warehouse_text(filters.event_time(detail)).withColumn(
        "silver_timestamp", F.col("created_at")
    )
    fresh = silver_plan.warehouse_silver(ingested, AS_OF)
    return maintenance.replace_by_key(
        silver_plan.as_silver_table(old).select(*names),
        silver_plan.as_silver_table(fresh).select(*names),
    )


@register
def silver_lake(spark, sf):
    documents = corpus.texts(spark, sf, "documents", "doc_id")
    return silver_plan.lake_silver(_bronze(spark, sf), _profile(documents))


# Data quality


def _checks(spark, sf):
    return quality.warehouse_checks(
        _upserted(spark, sf), corpus.audit(spark, sf), _warehouse_silver(spark, sf), AS_OF
    )


@register
def quality_suite(spark, sf):
    return _checks(spark, sf)


@register
def quality_summary(spark, sf):
    return quality.checks_summary(_checks(spark, sf))


# Streaming


def _messages(spark, sf):
    """Folder with all articles as message files."""
    path = run_dir(spark, "messages")
    messages.publish_files(corpus.bronze_batch(spark, sf), path)
    return path


@register
def stream_decode(spark, sf):
    """Messages decoded as a batch; those without a category arrive broken."""
    articles = corpus.bronze_batch(spark, sf)
    whole = messages.to_message_value(articles.filter("category IS NOT NULL"))
    cut = messages.to_message_value(articles.filter("category IS NULL"))
    arrived = whole.unionByName(cut.select(F.concat(F.lit("{"), "value").alias("value")))
    return stream.decode(arrived, filters.moment(AS_OF))


@register
def stream_drain(spark, sf):
    """All messages through the stream in several batches, twice on one checkpoint."""
    path, root = _messages(spark, sf), run_dir(spark, "bronze")
    for _ in range(2):
        arrived = stream.read_files(spark, path, files_per_batch=2)
        stream.drain_to_hours(arrived, root, f"{root}/checkpoint")
    return bronze.scan(spark, f"{root}/streaming").drop("stream_received_at")


@register
def stream_drain_bounded(spark, sf):
    """All messages in runs of at most 200, each going on where the one before ended."""
    path, root = _messages(spark, sf), run_dir(spark, "bronze")
    while bounded.drain(spark, path, root, max_messages=C.MAX_MESSAGES, runs=None):
        pass
    return bronze.scan(spark, f"{root}/streaming").drop("stream_received_at")


@register
def stream_sink(spark, sf):
    """Rows per ingestion mode in the hour folders of a drained stream."""
    path, root = _messages(spark, sf), run_dir(spark, "bronze")
    stream.drain_to_hours(stream.read_files(spark, path), root, f"{root}/checkpoint")
    written = spark.read.schema(
        T.StructType(schemas.BRONZE_STREAM.fields + schemas.HOUR_FOLDERS)
    ).json(f"{root}/streaming")
    in_folder = F.col("date") == F.substring("stream_received_at", 1, 10)
    return written.groupBy("ingestion_mode").agg(
        F.count(F.lit(1)).alias("articles"), F.count_if(in_folder).alias("in_date_folder")
    )


def _as_bronze(articles):
    """Rows of the article table as they would arrive: text, taken in when scraped."""
    names = [c for c in schemas.BRONZE.names if c not in ("published_at", "scraped_at")]
    return articles.withColumn("source_country", F.lit(None).cast("string")).select(
        *names,
        dates.iso_utc(F.col("published_at")).alias("published_at"),
        dates.iso_utc(F.col("ingested_at")).alias("scraped_at"),
    )


@register
def stream_upsert(spark, sf):
    """The last hour's articles by two streams and a batch run, compacted in between."""
    path, root = run_dir(spark, "messages"), run_dir(spark, "table")
    fresh = _as_bronze(corpus.incoming(spark, sf))
    first = F.substring("article_id", 1, 1)
    jobs.create_warehouse(spark, root, AS_OF.replace(hour=0), _existing(spark, sf), buckets=8)
    messages.publish_files(fresh.where(first < "5"), path)
    for checkpoint in ("a", "a", "b"):  # a second drain, and a checkpoint that is lost
        arrived = stream.read_files(spark, path, files_per_batch=8)
        stream_table.drain_to_table(arrived, root, f"{root}/{checkpoint}", clock=lambda: AS_OF)
    for _ in range(2):
        jobs.compact_warehouse(spark, root, AS_OF)
        jobs.apply_batch(spark, root, fresh.where(first >= "5"), "run", 1, AS_OF)
    return jobs.detail(spark, root)


# Stored tables


@register
def set_aside(spark, sf):
    """What a batch does not take, by reason, as the tables have it."""
    root = run_dir(spark, "table")
    recent = corpus.bronze_batch(spark, sf)
    articles = recent.select(*schemas.BRONZE.names).withColumn(
        "article_id", F.when(F.col("category").isNotNull(), F.col("article_id"))
    )
    cut = messages.to_message_value(recent.where("category IS NULL"))
    arrived = cut.select(F.concat(F.lit("{"), "value").alias("value")).unionByName(
        recent.where("title IS NULL").select(F.lit(" ").alias("value"))
    )
    jobs.create_warehouse(spark, root, AS_OF)
    jobs.apply_batch(spark, root, articles, "run", 1, AS_OF, stream.aside(arrived))
    return jobs.set_aside(spark, root).groupBy("reason").agg(F.count("*").alias("n"))


def _stored(spark, sf):
    """A warehouse of all articles and their audit."""
    root = run_dir(spark, "warehouse")
    before = AS_OF.replace(hour=0)
    jobs.create_warehouse(
        spark, root, before, _upserted(spark, sf), corpus.audit(spark, sf), buckets=8
    )
    return root


@register
def stored_purge(spark, sf):
    """Articles after a purge of the stored tables."""
    root = _stored(spark, sf)
    jobs.purge_warehouse(spark, root, AS_OF)
    return jobs.detail(spark, root)


@register
def stored_purge_audit(spark, sf):
    """Audit rows after a purge of the stored tables and a compaction."""
    root = _stored(spark, sf)
    jobs.purge_warehouse(spark, root, AS_OF)
    jobs.compact_warehouse(spark, root, AS_OF)
    return jobs.audit(spark, root)


@register
def stored_approve(spark, sf):
    """Articles after an approval in the stored tables."""
    root = _stored(spark, sf)
    jobs.approve_in_warehouse(spark, root, _approved_ids(spark, sf), AS_OF)
    return jobs.detail(spark, root)


@register
def stored_backfill(spark, sf):
    """Audit rows after two backfills of the stored tables."""
    root = _stored(spark, sf)
    for _ in range(2):
        jobs.backfill_warehouse(spark, root, AS_OF)
    return jobs.audit(spark, root)


def _with_last_hour(spark, sf):
    """A warehouse of the earlier articles with the last hour's batch put in."""
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF.replace(hour=0), _existing(spark, sf), buckets=8)
    return root, _as_bronze(corpus.incoming(spark, sf))


@register
def stored_silver_hour(spark, sf):
    """Silver rows of the last hour, read from the stored articles of its day."""
    root, fresh = _with_last_hour(spark, sf)
    jobs.apply_batch(spark, root, fresh, "run", 1, AS_OF)
    jobs.silver_hour(spark, root, AS_OF, "run silver", 1)
    return jobs.warehouse_silver_of(spark, root, AS_OF)


@register
def gold_by_batches(spark, sf):
    """Gold counts kept up by three batches: the earlier articles, the last hour's, a purge."""
    root, fresh = _with_last_hour(spark, sf)
    jobs.apply_batch(spark, root, fresh, "run", 1, AS_OF)
    jobs.compact_warehouse(spark, root, AS_OF)
    jobs.purge_warehouse(spark, root, AS_OF)
    tables = jobs.gold_tables(spark, root, AS_OF)
    keys = {**{t: gold.COUNT_KEYS[t] for t in gold.WAREHOUSE_TABLES}, "top_keywords": "keyword"}
    return _long(spark, {t: tables[t] for t in keys}, keys)


@register
def trends_by_batches(spark, sf):
    """Daily trends kept up by two hours of silver, the second replaces rows of the first."""
    root, fresh = _with_last_hour(spark, sf)
    jobs.silver_hour(spark, root, AS_OF.replace(hour=0), "run silver", 0)
    jobs.apply_batch(spark, root, fresh, "run", 1, AS_OF)
    jobs.silver_hour(spark, root, AS_OF, "run silver", 1)
    return jobs.gold_tables(spark, root, AS_OF)["daily_article_trends"]


@register
def stored_columns(spark, sf):
    """Articles of two batches with a column added in between, some with a value of their own."""
    root, fresh = _with_last_hour(spark, sf)
    tables = jobs.warehouse_store(spark, root)
    tables.add_column(AS_OF, "articles_detail", "checked_by", "string", "nobody")
    jobs.apply_batch(spark, root, fresh, "run", 1, AS_OF)
    own = jobs.detail(spark, root).where(F.col("source") == "BBC News")
    tables.commit(AS_OF, {"articles_detail": own.withColumn("checked_by", F.lit("desk"))})
    return jobs.detail(spark, root)


@register
def batch_ingest(spark, sf):
    """Pages to the hour's folder and on to messages; the articles as consumers get them."""
    root = run_dir(spark, "lake")
    jobs.lake_ingest(spark, root, corpus.entries(spark, sf), AS_OF)
    received = spark.read.text(f"{root}/messages")
    return stream.decode(received, filters.moment(AS_OF)).select(*schemas.BRONZE.names)


def _lake_hours(spark, sf):
    root = run_dir(spark, "lake")
    for hour, kind, rows in (
        (0, "batch", corpus.bronze_batch(spark, sf)),
        (1, "streaming", corpus.bronze_stream(spark, sf)),
    ):
        rows.write.json(f"{root}/bronze/{kind}/date=2024-01-31/hour={hour:02d}", compression="gzip")
        jobs.lake_silver_hour(spark, root, AS_OF.replace(hour=hour))
    return root


@register
def silver_lake_hours(spark, sf):
    """Lake silver built hour by hour: the batch's folder, then the stream's."""
    root = _lake_hours(spark, sf)
    return jobs.lake_silver_table(spark, root)


@register
def quality_by_hours(spark, sf):
    """The lake's quality report, from counters kept while silver was written hour by hour."""
    root = _lake_hours(spark, sf)
    return jobs.lake_quality(spark, root, AS_OF).drop("generated_at")


@register
def quality_by_batches(spark, sf):
    """The warehouse's checks after a batch, from counters kept by the batches."""
    root, fresh = _with_last_hour(spark, sf)
    tables = jobs.warehouse_store(spark, root)
    tables.commit(AS_OF, {"quarantine_audit": corpus.audit(spark, sf)})
    jobs.silver_hour(spark, root, AS_OF.replace(hour=0), "run silver", 0)
    jobs.apply_batch(spark, root, fresh, "run", 1, AS_OF)
    jobs.silver_hour(spark, root, AS_OF, "run silver", 1)
    return jobs.kept_checks(spark, root, AS_OF)


def _configured(spark):
    """Entries of a file with the configured sources and three that cannot be used."""
    path = f"{run_dir(spark, 'config')}/sources.yml"
    odd = [
        ("BBC News", None, "https://example.org/again"),
        ("No feed", "France", None),
        ("", "Maroc", "https://example.org/f"),
    ]
    config.write_sources(spark, path, [*C.SOURCES, *odd])
    return config.checked(config.read_entries(spark, path))


@register
def sources_dim(spark, sf):
    """The sources of a configuration file with the articles each has in the table."""
    counts = gold.count_by(corpus.articles(spark, sf), "source")
    known, _ = _configured(spark)
    return known.join(counts, known["name"] == counts["source"], "left").select(
        "name", "country", "rss_url", F.coalesce("articles_count", F.lit(0)).alias("articles_count")
    )


# Statements with parameters


#: A source whose name holds a quote.
QUOTED = "L'Officiel"


def _views(spark, sf):
    """Gold and article tables by name; one source has a quote in its name."""
    renamed = F.when(F.col("source") == "France24", QUOTED).otherwise(F.col("source"))
    detail = _detail(spark, sf).withColumn("source", renamed)
    return {
        "articles_detail": detail,
        "articles_by_source": gold.count_by(detail, "source"),
        "articles_by_day": gold.count_by(gold.with_published_day(detail), "published_day"),
    }


def _statement(name, **parameters):
    def query(spark, sf):
        return statements.run(spark, _views(spark, sf), name, **parameters)

    query.__name__ = f"statement_{name}"
    return register(query)


_statement("source_total", source=QUOTED)
_statement("window_total", today=AS_OF.date(), days=7)
_statement("top_source")
_statement("recent_of_source", source=QUOTED, rows=10)
_statement("hourly_of_source", source=QUOTED, since=AS_OF - timedelta(hours=24))
_statement("day_series", today=AS_OF.date(), days=7)

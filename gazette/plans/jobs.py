"""Whole runs over folders: the lake's and the warehouse's.

Each stage writes its table and the next one reads it from there, so a lost
executor never sends a run back to the raw pages.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gazette import constants as C
from gazette import schemas
from gazette.operators import deltas, maintenance, quality
from gazette.operators import gold as gold_operators
from gazette.operators.extract import extract_articles
from gazette.operators.filters import moment
from gazette.operators.language_model import LanguageProfile, train
from gazette.operators.ranking import first_n
from gazette.plans import gold, silver
from gazette.plans.ingest import as_detail_batch
from gazette.sources import bronze, messages, warehouse
from gazette.sources.commits import exists
from gazette.sources.store import BUCKETS, Conflict, Store, Table, bucket

log = logging.getLogger(__name__)

NO_ID, REPEATED, REFUSED = "no article_id", "article_id repeated in the batch", "batch refused"
APPLIED = "applied"


# Lake


def lake_ingest(
    spark: SparkSession,
    root: str,
    entries: DataFrame,
    as_of: datetime,
    limit_per_source: int = C.LIMIT_PER_SOURCE_LAKE,
) -> DataFrame:
    """Feed entries with their pages to the hour's bronze folder and to messages.

    The messages are made from the folder, so the pages are taken apart once.
    """
    articles = extract_articles(entries, as_of, limit_per_source)
    bronze.write_hour(articles, f"{root}/bronze", as_of)
    landed = bronze.scan(
        spark, f"{root}/bronze/batch/date={as_of:%Y-%m-%d}/hour={as_of:%H}", schemas.BRONZE_BATCH
    )
    messages.publish_files(landed.select(*schemas.BRONZE.names), f"{root}/messages")
    return landed


def train_language(
    spark: SparkSession, root: str, labelled: DataFrame, text: str, label: str, as_of: datetime
) -> LanguageProfile:
    """Learn a language profile from labelled texts and keep it for later runs."""
    tables = {"profile": train(labelled, text, label).scores}
    warehouse.publish(spark, f"{root}/language", tables, as_of)
    return language_profile(spark, root)


def language_profile(spark: SparkSession, root: str) -> LanguageProfile:
    """The profile learnt last."""
    return LanguageProfile(warehouse.read(spark, f"{root}/language", "profile"))


#: Folders that lake silver is bucketed into by URL.
LAKE_BUCKETS = 64
#: Tasks that share the URLs of a bucket while silver of two hours is put together.
LAKE_PARTS = 8


def lake_silver_table(spark: SparkSession, root: str) -> DataFrame:
    """The lake's current silver articles."""
    return spark.read.parquet(f"{root}/silver/articles_silver").drop("_bucket")


def _lake_bucket() -> Column:
    return bucket(F.coalesce("url", F.lit("")), LAKE_BUCKETS)


def _new_silver(landed: DataFrame, profile: LanguageProfile | None) -> DataFrame:
    """Silver rows by bucket; the raw rows travel, which are less than cleaned ones."""
    latest = silver.latest_by_url(landed).withColumn("_bucket", _lake_bucket())
    return silver.cleaned(latest.hint("rebalance", "_bucket"), profile)


def _merged(held: DataFrame, fresh: DataFrame) -> DataFrame:
    """The latest of silver rows by bucket, each of two frames with a URL once.

    One exchange serves the choice and the write: a URL has two rows at most here.
    """
    part = F.pmod(F.xxhash64(F.coalesce("url", F.lit("")), F.lit(1)), F.lit(LAKE_PARTS))
    both = held.unionByName(fresh).withColumns({"_bucket": _lake_bucket(), "_part": part})
    by = ["_bucket", "_part"]
    return silver.latest_by_url(both.repartition(*by), by).drop("_part")


def _write_silver(rows: DataFrame, root: str, mode: str) -> dict:
    """Write buckets and count what the quality report needs on the way."""
    seen = Observation()
    (
        quality.observed(rows, seen)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "zstd")
        .partitionBy("_bucket")
        .parquet(f"{root}/silver/articles_silver")
    )
    return seen.get


def _keep_counters(spark: SparkSession, root: str, counters: dict | None) -> None:
    """The counters of the table as it is, or none while it is being written."""
    rows = [[(counters or {}).get(c) for c in quality.COUNTERS]]
    schema = ", ".join(f"{c} long" for c in quality.COUNTERS)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").json(f"{root}/silver_counters")


def _lake_counters(spark: SparkSession, root: str) -> dict:
    """The kept counters; if a run did not get to its end, those of a new scan."""
    schema = ", ".join(f"{c} long" for c in quality.COUNTERS)
    kept = spark.read.schema(schema).json(f"{root}/silver_counters").first()
    if kept is not None and kept["record_count"] is not None:
        return kept.asDict()
    return quality.counters(lake_silver_table(spark, root)).first().asDict()


def lake_silver(
    spark: SparkSession, root: str, as_of: datetime, profile: LanguageProfile | None = None
) -> DataFrame:
    """Bronze to silver: all JSON lines below bronze, in place of the table."""
    articles = bronze.require_rows(bronze.scan(spark, f"{root}/bronze"))
    _keep_counters(spark, root, None)
    seen = _write_silver(_new_silver(articles, profile), root, "static")
    _keep_counters(spark, root, seen)
    return lake_silver_table(spark, root)


def lake_silver_hour(
    spark: SparkSession, root: str, as_of: datetime, profile: LanguageProfile | None = None
) -> DataFrame:
    """Put the hour's bronze folders into the silver table of the hours before.

    Reads the new hour and the buckets of its URLs and writes these buckets anew;
    the latest scrape of a URL stays, whichever of them holds it. An hour may be
    repeated, and hours come in any order.
    """
    hour = f"date={as_of:%Y-%m-%d}/hour={as_of:%H}"
    landed = bronze.require_rows(bronze.scan(spark, f"{root}/bronze/*/{hour}"))
    if not exists(spark, f"{root}/silver/articles_silver"):
        _keep_counters(spark, root, None)
        _keep_counters(spark, root, _write_silver(_new_silver(landed, profile), root, "dynamic"))
        return lake_silver_table(spark, root)
    before = _lake_counters(spark, root)
    touched = [r[0] for r in landed.select(_lake_bucket().alias("b")).distinct().collect()]
    held = spark.read.parquet(f"{root}/silver/articles_silver").where(F.col("_bucket").isin(touched))
    taken = Observation()
    fresh = silver.lake_silver(landed, profile)
    merged = _merged(quality.observed(held.drop("_bucket"), taken), fresh)
    _keep_counters(spark, root, None)
    seen = _write_silver(merged, root, "dynamic")
    gone = taken.get
    _keep_counters(spark, root, {c: before[c] - gone[c] + seen[c] for c in quality.COUNTERS})
    return lake_silver_table(spark, root)


def lake_quality(spark: SparkSession, root: str, as_of: datetime) -> DataFrame:
    """Quality report of the silver table from the counters kept as it was written."""
    schema = ", ".join(f"{c} long" for c in quality.COUNTERS)
    found = _lake_counters(spark, root)
    counted = spark.createDataFrame([[found[c] for c in quality.COUNTERS]], schema)
    report = quality.scored(counted).withColumn("generated_at", moment(as_of))
    report.coalesce(1).write.mode("overwrite").json(f"{root}/governance/quality_report_latest")
    return report


def lake_gold(spark: SparkSession, root: str, as_of: datetime) -> None:
    """Silver to gold: five tables that become visible together."""
    warehouse.publish(spark, f"{root}/gold", gold.lake_tables(lake_silver_table(spark, root)), as_of)


# Warehouse


TABLES = {
    # cut by the day of intake, so that a read of the last hours finds its folders
    "articles_detail": Table(
        schemas.ARTICLES_DETAIL, day=lambda: F.coalesce("ingested_at", "created_at")
    ),
    "url_owner": Table(schemas.URL_OWNER, key="url"),
    "articles_silver": Table(schemas.ARTICLES_SILVER, day=lambda: F.col("silver_timestamp")),
    "quarantine_audit": Table(schemas.QUARANTINE_AUDIT, latest=False),
    "transformation_audit": Table(schemas.TRANSFORMATION_AUDIT, latest=False),
    "set_aside": Table(schemas.SET_ASIDE, latest=False),
    "article_counts": Table(schemas.ARTICLE_COUNTS, key="source", latest=False, sums=("n",)),
    "keyword_counts": Table(schemas.KEYWORD_COUNTS, key="keyword", latest=False, sums=("n",)),
    "check_counts": Table(schemas.CHECK_COUNTS, key="name", latest=False, sums=("n",)),
    "trend_counts": Table(
        schemas.TREND_COUNTS, key="source", latest=False, sums=tuple(deltas.TREND_SUMS)
    ),
}
#: How often a batch starts over when another writer commits in between.
ATTEMPTS = 10


@dataclass(frozen=True)
class WarehouseRun:
    applied: bool
    metrics: DataFrame
    checks: DataFrame


def warehouse_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, f"{root}/warehouse", TABLES)


def _owned(articles: DataFrame) -> DataFrame:
    """The URLs of articles with their owners."""
    return articles.where(F.col("url").isNotNull()).select("url", "article_id")


def create_warehouse(
    spark: SparkSession,
    root: str,
    as_of: datetime,
    articles: DataFrame | None = None,
    audit: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Start the warehouse, empty or with articles and audit rows.

    More buckets make an upsert read less of a large table. The articles are made
    once; their URLs and counts are read from the stored table.
    """
    rows, derive = {}, None
    if articles is not None:
        rows["articles_detail"] = articles

        def derive(stored):
            held = stored("articles_detail")
            return {"url_owner": _owned(held), **_counts(None, held, as_of)}

    if audit is not None:
        rows["quarantine_audit"] = audit
    warehouse_store(spark, root).create(as_of, rows, buckets, derive)


def _counts(
    before: DataFrame | None, after: DataFrame | None, as_of: datetime
) -> dict[str, DataFrame]:
    """What a change of articles does to the stored counts."""
    changed = deltas.signed(before, after, deltas.ARTICLE_COLUMNS)
    return {
        "article_counts": deltas.article_counts(changed),
        "keyword_counts": deltas.keyword_counts(changed),
        "check_counts": deltas.article_checks(changed, as_of),
    }


def detail(spark: SparkSession, root: str) -> DataFrame:
    return warehouse_store(spark, root).current("articles_detail")


def recent_detail(spark: SparkSession, root: str, since: datetime) -> DataFrame:
    """Articles taken in from the day of `since` on, read from the folders of these days."""
    return warehouse_store(spark, root).current("articles_detail", since=since.date())


def silver_table(spark: SparkSession, root: str) -> DataFrame:
    return warehouse_store(spark, root).current("articles_silver")


def audit(spark: SparkSession, root: str) -> DataFrame:
    """Quarantine audit rows of all batches."""
    return warehouse_store(spark, root).current("quarantine_audit")


def set_aside(spark: SparkSession, root: str) -> DataFrame:
    """What the batches did not take, with the reason."""
    return warehouse_store(spark, root).current("set_aside")


def _aside(articles: DataFrame, reason: str, as_of: datetime) -> DataFrame:
    names = [c for c in articles.columns if not c.startswith("_")]
    return articles.select(
        "article_id",
        F.lit(reason).alias("reason"),
        F.to_json(F.struct(*names)).alias("record"),
        moment(as_of).alias("set_aside_at"),
    )


def apply_batch(
    spark: SparkSession,
    root: str,
    articles: DataFrame,
    writer: str,
    batch: int,
    as_of: datetime,
    broken: DataFrame | None = None,
) -> bool:
    """Upsert one batch of bronze articles; False if it was refused as a whole.

    Articles, audit rows, URL owners and what is set aside are one commit. Articles
    without an id, and all but the latest of several with one id, are set aside, as
    are `broken` messages (record, reason). A batch that would leave two articles
    with one URL is refused: all of it is set aside. A batch that this writer has
    committed before changes nothing. Only the parts of the tables that hold the
    batch's ids and URLs are read.
    """
    for attempt in range(ATTEMPTS):
        try:
            return _apply(spark, root, articles, writer, batch, as_of, broken)
        except Conflict:
            # another writer came first: all is decided anew from its state
            if attempt == ATTEMPTS - 1:
                raise
            log.info("batch %d of %s starts over", batch, writer)
    raise AssertionError


def _apply(
    spark: SparkSession,
    root: str,
    articles: DataFrame,
    writer: str,
    batch: int,
    as_of: datetime,
    broken: DataFrame | None,
) -> bool:
    store = warehouse_store(spark, root)
    state = store.state()
    if (known := store.note(writer, batch, state)) is not None:
        return known == APPLIED
    named = articles.where(F.coalesce(F.col("article_id") != "", F.lit(False)))
    unnamed = articles.where(~F.coalesce(F.col("article_id") != "", F.lit(False)))
    order = [F.col("scraped_at").desc_nulls_last(), F.xxhash64(*articles.columns)]
    latest = first_n(named, ["article_id"], order, 1)
    judged = as_detail_batch(latest).persist()
    aside = [_aside(unnamed, NO_ID, as_of), _aside(_others(named, order), REPEATED, as_of)]
    if broken is not None:
        aside.append(
            broken.select(
                F.lit(None).cast("string").alias("article_id"),
                *("reason", "record"),
                moment(as_of).alias("set_aside_at"),
            )
        )
    try:
        keys = maintenance.batch_keys(judged)
        urls = _owned(keys)
        own = store.current("articles_detail", near=keys, state=state)
        before = own.join(keys.select("article_id"), "article_id", "left_semi")
        before = before.select(
            "article_id", "url", "quarantine", "created_at", *deltas.ARTICLE_COLUMNS
        ).persist()
        owners = store.current("url_owner", near=urls, state=state)
        owners = owners.join(urls.select("url"), "url", "left_semi")
        maintenance.check_unique(owners, keys)
        freed = before.where(F.col("url").isNotNull()).join(urls.select("url"), "url", "left_anti")
        dated = maintenance.dated_batch(before.select("article_id", "created_at"), judged, keys, as_of)
        note = store.commit(
            as_of,
            rows={
                "articles_detail": dated,
                "quarantine_audit": maintenance.quarantine_audit_delta(before, judged, keys, as_of),
                "url_owner": urls,
                "set_aside": _union(aside),
                **_counts(before, judged, as_of),
            },
            deletes={"url_owner": freed},
            writer=writer,
            batch=batch,
            note=APPLIED,
            state=state,
        )
        before.unpersist()
        return note == APPLIED
    except maintenance.DuplicateKey as error:
        log.error("batch %d of %s refused: %s", batch, writer, error)
        refused = _aside(latest, f"{REFUSED}: {error}", as_of)
        store.commit(
            as_of,
            rows={"set_aside": _union([*aside, refused])},
            writer=writer,
            batch=batch,
            note=REFUSED,
            state=state,
        )
        return False
    finally:
        judged.unpersist()


def _others(named: DataFrame, order: list) -> DataFrame:
    """The rows of each id behind the first."""
    rank = F.row_number().over(Window.partitionBy("article_id").orderBy(*order))
    return named.withColumn("_rank", rank).where("_rank > 1")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def warehouse_run(
    spark: SparkSession,
    root: str,
    articles: DataFrame,
    batch: int,
    as_of: datetime,
    sources: list[tuple] = C.SOURCES,
    writer: str = "run",
) -> WarehouseRun:
    """Ingest, silver, gold, headline numbers and checks, in this order."""
    store = warehouse_store(spark, root)
    applied = apply_batch(spark, root, articles, writer, batch, as_of)
    _silver_hour(spark, store, as_of, f"{writer} silver", batch)
    warehouse.write_run_snapshot(
        warehouse_silver_of(spark, root, as_of), f"{root}/silver_runs", as_of, f"{writer}-{batch}"
    )
    table, silver_rows = detail(spark, root), silver_table(spark, root)
    tables = {
        **gold_tables(spark, root, as_of, sources),
        "analytics_summary": gold_operators.analytics_summary(silver_rows, as_of),
    }
    warehouse.publish(spark, f"{root}/gold", tables, as_of)
    return WarehouseRun(
        applied=applied,
        metrics=gold_operators.kpi_metrics(table, as_of),
        checks=kept_checks(spark, root, as_of),
    )


def silver_hour(spark: SparkSession, root: str, as_of: datetime, writer: str, batch: int) -> None:
    """Silver rows of the articles of the last hour in place of their older ones."""
    _silver_hour(spark, warehouse_store(spark, root), as_of, writer, batch)


def _silver_hour(spark: SparkSession, store: Store, as_of: datetime, writer: str, batch: int) -> None:
    """Reads the articles of the last hour's days, and of silver the buckets of their ids."""
    for attempt in range(ATTEMPTS):
        state = store.state()
        if store.note(writer, batch, state) is not None:
            return
        since = (as_of - timedelta(hours=1)).date()
        recent = store.current("articles_detail", state=state, since=since)
        fresh = silver.as_silver_table(silver.warehouse_silver(recent, as_of)).persist()
        ids = fresh.select("article_id")
        before = store.current("articles_silver", near=ids, state=state)
        before = before.join(ids, "article_id", "left_semi")
        changed = deltas.signed(before, fresh, deltas.SILVER_COLUMNS)
        try:
            store.commit(
                as_of,
                rows={
                    "articles_silver": fresh,
                    "transformation_audit": maintenance.transformation_audit(fresh, as_of),
                    "trend_counts": deltas.trend_counts(changed),
                    "check_counts": deltas.silver_checks(changed),
                },
                writer=writer,
                batch=batch,
                state=state,
            )
            return
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
        finally:
            fresh.unpersist()


def kept_checks(spark: SparkSession, root: str, as_of: datetime) -> DataFrame:
    """The checks from counters that the batches kept; only ids are read, for orphans."""
    store = warehouse_store(spark, root)
    state = store.state()
    counts, trail, table = (
        store.current(name, state=state)
        for name in ("check_counts", "quarantine_audit", "articles_detail")
    )
    return quality.judged_checks(
        deltas.checks(counts, as_of).unionByName(quality.orphan_check(trail, table))
    )


def gold_tables(
    spark: SparkSession, root: str, as_of: datetime, sources: list[tuple] = C.SOURCES
) -> dict[str, DataFrame]:
    """The gold tables from the stored counts; no article is read."""
    store = warehouse_store(spark, root)
    state = store.state()
    counts, words, trends = (
        store.current(name, state=state)
        for name in ("article_counts", "keyword_counts", "trend_counts")
    )
    return {
        **deltas.count_tables(counts, words, as_of, sources),
        "daily_article_trends": deltas.daily_trends(trends),
    }


def warehouse_silver_of(spark: SparkSession, root: str, as_of: datetime) -> DataFrame:
    """The silver rows of one run."""
    rows = warehouse_store(spark, root).current("articles_silver", since=as_of.date())
    return rows.where(F.col("silver_timestamp") == moment(as_of))


def purge_warehouse(
    spark: SparkSession, root: str, as_of: datetime, days: int = C.QUARANTINE_RETENTION_DAYS
) -> DataFrame:
    """Remove expired quarantined articles with their audit rows, in one commit.

    Returns how many of each were removed.
    """
    store = warehouse_store(spark, root)
    state = store.state()
    table, trail = (store.current(n, state=state) for n in ("articles_detail", "quarantine_audit"))
    counts = maintenance.purge_counts(trail, table, as_of, days).collect()
    gone = maintenance.expired(table, as_of, days)
    gone = gone.select("article_id", "url", *deltas.ARTICLE_COLUMNS).persist()
    store.commit(
        as_of,
        rows=_counts(gone, None, as_of),
        deletes={
            "articles_detail": gone,
            "quarantine_audit": gone,
            "transformation_audit": gone,
            "url_owner": gone.where(F.col("url").isNotNull()),
        },
        state=state,
    )
    gone.unpersist()
    return spark.createDataFrame(counts, "articles_deleted long, audit_deleted long")


def approve_in_warehouse(spark: SparkSession, root: str, ids: DataFrame, as_of: datetime) -> None:
    """Clear the flag of the listed articles and note it in the audit, in one commit."""
    store = warehouse_store(spark, root)
    state, listed = store.state(), ids.select("article_id").distinct()
    own = store.current("articles_detail", near=listed, state=state)
    own = own.join(listed, "article_id", "left_semi")
    store.commit(
        as_of,
        rows={
            "articles_detail": own.withColumn("quarantine", F.lit(False)),
            "quarantine_audit": maintenance.approve_audit(ids, as_of),
        },
        state=state,
    )


def backfill_warehouse(spark: SparkSession, root: str, as_of: datetime) -> None:
    """Add the audit rows that flagged articles lack; repeatable."""
    store = warehouse_store(spark, root)
    state = store.state()
    table, trail = (store.current(n, state=state) for n in ("articles_detail", "quarantine_audit"))
    missing = maintenance.missing_marks(table, trail, as_of)
    store.commit(as_of, rows={"quarantine_audit": missing}, state=state)


def compact_warehouse(spark: SparkSession, root: str, as_of: datetime) -> None:
    """Fold the batches so far into new bases of all tables."""
    warehouse_store(spark, root).compact(as_of)

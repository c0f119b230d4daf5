"""Table maintenance: each operation maps tables to their next version."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C
from gazette import schemas
from gazette.operators.filters import moment

BACKFILL_REASON = "retroactive-backfill"


class DuplicateKey(ValueError):
    """A batch that would break a uniqueness rule; none of it is applied."""


def batch_keys(batch: DataFrame) -> DataFrame:
    """Ids and URLs of a batch; Spark broadcasts them if they are few bytes."""
    return batch.select("article_id", "url")


def without_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of the table whose key is not listed; null keys stay."""
    return table.join(keys.select(key), key, "left_anti")


def replace_by_key(table: DataFrame, batch: DataFrame, key: str = "article_id") -> DataFrame:
    """Delete the batch's keys from the table, then append the batch."""
    return without_keys(table, batch, key).unionByName(batch, allowMissingColumns=True)


def check_unique(table: DataFrame, keys: DataFrame) -> None:
    """Raise if applying the batch would leave two rows with one id or one URL."""
    with_url = keys.filter(F.col("url").isNotNull())
    untouched = table.select("article_id", "url").join(keys, "article_id", "left_anti")
    offenders = {
        "article_id repeated in the batch": keys.groupBy("article_id").count().filter("count > 1"),
        "url repeated in the batch": with_url.groupBy("url").count().filter("count > 1"),
        "url belongs to another article": untouched.join(with_url, "url", "left_semi"),
    }
    found = [rows.select(F.lit(rule).alias("rule")).limit(1) for rule, rows in offenders.items()]
    broken = reduce(DataFrame.unionByName, found).collect()
    if broken:
        raise DuplicateKey("; ".join(row["rule"] for row in broken))


def dated_batch(
    table: DataFrame, batch: DataFrame, keys: DataFrame, as_of: datetime
) -> DataFrame:
    """The batch as table rows; articles already there keep their created_at."""
    born = table.select("article_id", "created_at").join(keys, "article_id", "left_semi")
    return (
        batch.drop("created_at")
        .join(born, "article_id", "left")
        .withColumn("created_at", F.coalesce("created_at", moment(as_of)))
        .select(*schemas.ARTICLES_DETAIL.names)
    )


def upsert(table: DataFrame, batch: DataFrame, keys: DataFrame, as_of: datetime) -> DataFrame:
    """Insert the batch, replacing the articles it repeats.

    The table is read without a shuffle while Spark broadcasts the batch's keys.
    """
    kept = table.join(keys, "article_id", "left_anti")
    return kept.select(*schemas.ARTICLES_DETAIL.names).unionByName(
        dated_batch(table, batch, keys, as_of)
    )


def _audit_row(action: Column, performed_by: str, reason: Column, as_of: datetime) -> list[Column]:
    return [
        F.col("article_id"),
        action.alias("action"),
        F.lit(performed_by).alias("performed_by"),
        reason.alias("reason"),
        moment(as_of).alias("performed_at"),
    ]


def quarantine_audit_delta(
    table: DataFrame, batch: DataFrame, keys: DataFrame, as_of: datetime
) -> DataFrame:
    """Audit rows for the flags the batch changes, and for new flagged articles."""
    before = (
        table.select("article_id", F.coalesce("quarantine", F.lit(False)).alias("_before"))
        .join(keys, "article_id", "left_semi")
    )
    now = F.col("quarantine")
    changed = (
        batch.filter(F.col("article_id") != "")
        .join(before, "article_id", "left")
        .filter(F.coalesce("_before", F.lit(False)) != now)
    )
    action = F.when(now, "mark").otherwise("unmark")
    reason = F.when(now, F.col("reason")).otherwise("heuristic-change")
    return changed.select(*_audit_row(action, "system", reason, as_of))


# Audit upkeep


def orphans(audit: DataFrame, detail: DataFrame) -> DataFrame:
    """Audit rows whose article does not exist."""
    return audit.join(detail.select("article_id"), "article_id", "left_anti")


def orphan_count(audit: DataFrame, detail: DataFrame) -> DataFrame:
    """Number of orphans; audit rows are counted per article before the join."""
    per_article = audit.groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    return orphans(per_article, detail).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")
    )


def missing_marks(detail: DataFrame, audit: DataFrame, as_of: datetime) -> DataFrame:
    """Backfill rows for flagged articles that have none yet; repeatable."""
    done = audit.filter((F.col("action") == "mark") & (F.col("reason") == BACKFILL_REASON))
    flagged = detail.filter("quarantine").select("article_id")
    missing = flagged.join(done.select("article_id").distinct(), "article_id", "left_anti")
    return missing.select(*_audit_row(F.lit("mark"), "system", F.lit(BACKFILL_REASON), as_of))


def backfill(detail: DataFrame, audit: DataFrame, as_of: datetime) -> DataFrame:
    """The audit with its missing backfill rows appended."""
    return audit.unionByName(missing_marks(detail, audit, as_of))


# Retention


def _expired(as_of: datetime, days: int) -> Column:
    cutoff = moment(as_of - timedelta(days=days))
    return F.coalesce(F.col("quarantine") & (F.col("ingested_at") < cutoff), F.lit(False))


def expired(
    detail: DataFrame, as_of: datetime, days: int = C.QUARANTINE_RETENTION_DAYS
) -> DataFrame:
    """Articles that a purge removes."""
    return detail.filter(_expired(as_of, days))


def purge_articles(
    detail: DataFrame, as_of: datetime, days: int = C.QUARANTINE_RETENTION_DAYS
) -> DataFrame:
    """Articles that stay: not quarantined, or taken in within the retention time."""
    return detail.filter(~_expired(as_of, days))


def purge_audit(
    audit: DataFrame, detail: DataFrame, as_of: datetime, days: int = C.QUARANTINE_RETENTION_DAYS
) -> DataFrame:
    """Audit rows that stay: those of articles that are not purged."""
    return without_keys(audit, expired(detail, as_of, days), "article_id")


def purge_counts(
    audit: DataFrame, detail: DataFrame, as_of: datetime, days: int = C.QUARANTINE_RETENTION_DAYS
) -> DataFrame:
    """How many articles and audit rows a purge removes."""
    gone = expired(detail, as_of, days).select("article_id")
    per_article = audit.groupBy("article_id").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    articles = gone.agg(F.count(F.lit(1)).alias("articles"), none.alias("audits"))
    audits = per_article.join(gone, "article_id", "left_semi").agg(
        none.alias("articles"), F.coalesce(F.sum("n"), none).alias("audits")
    )
    return articles.unionByName(audits).agg(
        F.sum("articles").alias("articles_deleted"), F.sum("audits").alias("audit_deleted")
    )


# Approval


def approve_articles(detail: DataFrame, ids: DataFrame) -> DataFrame:
    """Articles with the flag cleared for the listed ids."""
    listed = ids.select("article_id").distinct().withColumn("_listed", F.lit(True))
    return (
        detail.join(listed, "article_id", "left")
        .withColumn(
            "quarantine", F.when(F.col("_listed"), False).otherwise(F.col("quarantine"))
        )
        .select(*detail.columns)
    )


def approve_audit(ids: DataFrame, as_of: datetime) -> DataFrame:
    """One audit row per approved id."""
    return ids.select(*_audit_row(F.lit("unmark"), "ui", F.lit("approved_ui"), as_of))


# Schema


def evolve_schema(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add the columns that are not there yet, each with its default."""
    return df.withColumns({n: c for n, c in columns.items() if n not in df.columns})


def transformation_audit(silver: DataFrame, as_of: datetime) -> DataFrame:
    """One row per article and transformation that changed its value."""
    long = silver.selectExpr(
        "article_id",
        "stack(2, 'title_normalized', title, title_normalized, "
        "'content_clean', content, content_clean) "
        "AS (transformation_type, input_value, output_value)",
        "silver_timestamp AS transformation_timestamp",
    )
    changed = long.filter(~F.col("input_value").eqNullSafe(F.col("output_value")))
    return changed.withColumn("performed_at", moment(as_of)).select(
        *schemas.TRANSFORMATION_AUDIT.names
    )

"""Ingest: bronze articles into the warehouse's article table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette import schemas
from gazette.functions.dates import parse_timestamp
from gazette.operators import maintenance
from gazette.operators.quarantine import with_quarantine


def as_detail_batch(bronze: DataFrame) -> DataFrame:
    """Bronze articles with the article table's types, judged by the rules."""
    typed = bronze.withColumns(
        {
            "published_at": parse_timestamp(F.col("published_at")),
            "ingested_at": parse_timestamp(F.col("scraped_at")),
        }
    )
    names = [c for c in schemas.ARTICLES_DETAIL.names if c not in ("quarantine", "created_at")]
    return with_quarantine(typed.select(*names))


@dataclass(frozen=True)
class Ingested:
    articles: DataFrame
    audit_delta: DataFrame


def ingest(detail: DataFrame, batch: DataFrame, as_of: datetime) -> Ingested:
    """Next version of the article table, with the audit rows of the change.

    The batch is judged (with_quarantine). It is refused whole if it breaks a
    uniqueness rule. Both results read it, so a caller that writes both should
    persist it.
    """
    keys = maintenance.batch_keys(batch)
    maintenance.check_unique(detail, keys)
    return Ingested(
        articles=maintenance.upsert(detail, batch, keys, as_of),
        audit_delta=maintenance.quarantine_audit_delta(detail, batch, keys, as_of),
    )

"""Data-quality reports: counters fused into one pass per table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions.text import blank_if_null, strip_space
from gazette.operators.filters import moment
from gazette.operators.maintenance import orphan_count


COUNTERS = ("record_count", "article_sans_titre", "date_manquante", "contenu_trop_court")


def _counters(min_chars: int) -> list[Column]:
    title = strip_space(blank_if_null(F.col("title")))
    short = F.length(blank_if_null(F.col("content_final"))) < min_chars
    rules = (F.lit(True), title == "", F.col("published_at").isNull(), short)
    return [F.count_if(rule).alias(name) for name, rule in zip(COUNTERS, rules, strict=True)]


def counters(silver: DataFrame, min_chars: int = C.MIN_CONTENT_CHARS) -> DataFrame:
    """Completeness counters of the lake silver table."""
    return silver.agg(*_counters(min_chars))


def observed(silver: DataFrame, seen: Observation, min_chars: int = C.MIN_CONTENT_CHARS) -> DataFrame:
    """The rows as they are; the counters are gathered while they pass."""
    return silver.observe(seen, *_counters(min_chars))


def scored(counted: DataFrame) -> DataFrame:
    """Counters with the scores from them."""
    n = F.greatest("record_count", F.lit(1))
    untitled, undated, short = map(F.col, COUNTERS[1:])

    def score(issues, tests: int):
        return F.round(100 * (1 - issues / (tests * n)), 2)

    return counted.withColumns(
        {
            "completude": score(untitled + undated, 2),
            "coherence": score(short, 1),
            "validite": score(untitled + undated + short, 3),
        }
    )


def lake_report(silver: DataFrame, min_chars: int = C.MIN_CONTENT_CHARS) -> DataFrame:
    """Completeness counters of the lake silver table and the scores from them."""
    return scored(counters(silver, min_chars))


def _as_rows(counters: DataFrame, checks: dict[str, str]) -> DataFrame:
    """One row per check (name, value) from a one-row frame of counters."""
    pairs = ", ".join(f"'{name}', {column}" for name, column in checks.items())
    return counters.selectExpr(f"stack({len(checks)}, {pairs}) AS (name, value)")


def warehouse_checks(
    detail: DataFrame, audit: DataFrame, silver: DataFrame | None, as_of: datetime
) -> DataFrame:
    """One row per check: name, status, value. Checks of a missing table are left out."""
    from_detail = _as_rows(
        detail.agg(
            F.count_if(blank_if_null(F.col("title")) == "").alias("titles"),
            F.count_if(F.col("author") == C.UNKNOWN).alias("authors"),
            F.count_if(blank_if_null(F.col("content")) == "").alias("contents"),
            F.count_if(F.col("published_at") > moment(as_of)).alias("dates"),
        ),
        {
            "articles_detail.title_null": "titles",
            "articles_detail.author_null": "authors",
            "articles_detail.content_null": "contents",
            "invalid_dates": "dates",
        },
    )
    rows = from_detail.unionByName(orphan_check(audit, detail))
    if silver is not None:
        score = F.col("data_quality_score")
        rows = rows.unionByName(
            _as_rows(
                silver.agg(
                    F.count_if(F.col("content_length") < 0).alias("lengths"),
                    F.count_if((score > 1) | (score < 0)).alias("scores"),
                ),
                {"negative_lengths": "lengths", "invalid_scores": "scores"},
            )
        )
    return judged_checks(rows)


def orphan_check(audit: DataFrame, detail: DataFrame) -> DataFrame:
    return orphan_count(audit, detail).select(
        F.lit("orphaned_audit_records").alias("name"), F.col("orphans").alias("value")
    )


def judged_checks(rows: DataFrame) -> DataFrame:
    """Checks (name, value) with their status."""
    failing = F.when(F.col("name") == "orphaned_audit_records", "FAIL").otherwise("WARN")
    return rows.select(
        "name", F.when(F.col("value") == 0, "PASS").otherwise(failing).alias("status"), "value"
    )


def checks_summary(checks: DataFrame) -> DataFrame:
    """Totals of a set of checks; a warning counts as not passed."""
    counted = checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") != "PASS").alias("failed"),
        F.count_if(F.col("status") == "FAIL").alias("_fatal"),
    )
    total = F.col("total_checks")
    return counted.select(
        F.when(F.col("_fatal") > 0, "FAIL").otherwise("PASS").alias("status"),
        "total_checks",
        "passed",
        "failed",
        F.when(total > 0, F.col("passed") / total * 100).otherwise(0.0).alias("pass_rate"),
    )

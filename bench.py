"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
cores. Every query runs once to warm up and once for the clock, whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gazette.session import build_session, scale_conf

HEADLINES = [
    "html_to_text", "pages_paragraphs", "pages_best_title", "extract_articles",
    "normalize_text", "title_normalized", "text_metrics", "content_final",
    "detect_language_vote", "detect_language_ngram", "quality_score", "infer_theme",
    "normalize_published_at", "quarantine_reasons", "suspicious_url", "dedup_keep_first",
    "dedup_keep_last", "recent_per_source", "country_lookup", "articles_by_day",
    "articles_by_source", "articles_by_theme", "articles_by_country", "top_keywords_content",
    "top_keywords_title", "kpi_metrics", "analytics_summary", "daily_article_trends",
    "hourly_by_source", "upsert_articles", "quarantine_audit_delta", "replace_by_key",
    "purge_counts", "quality_report_lake", "quality_suite", "silver_lake", "silver_warehouse",
    "gold_publish", "bronze_scan", "stream_drain", "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    cores = int(cpus) if cpus.isdigit() else os.cpu_count() or 8
    bytes_in = sum(e.stat().st_size for e in os.scandir(sf_dir))
    conf = {
        **scale_conf(bytes_in, cores),
        "spark.sql.shuffle.partitions": str(cores),
        "spark.gazette.spread": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    spark = build_session("bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    from gazette.checks.queries import QUERIES

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        run(name)
        seconds[name] = round(run(name), 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()

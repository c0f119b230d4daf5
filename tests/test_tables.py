"""Maintenance, ranking, gold and quality on small tables and random ones."""

import math
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazette import schemas
from gazette.operators import filters, gold, language_model, maintenance, quality, ranking
from gazette.operators.language_model import BUCKETS, FACTORS, identify, train
from gazette.plans import gold as gold_plan
from gazette.plans.ingest import ingest

AS_OF = datetime(2024, 1, 31, 1, 0)
OLD = datetime(2024, 1, 1)
few = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def detail(spark, rows):
    """rows of dicts; missing columns are null"""
    names = schemas.ARTICLES_DETAIL.names
    return spark.createDataFrame(
        [tuple(r.get(n) for n in names) for r in rows], schemas.ARTICLES_DETAIL
    )


def article(i, **given):
    base = {
        "article_id": f"id{i}", "title": f"title {i}", "source": "s", "url": f"https://x/{i}",
        "quarantine": False, "created_at": OLD, "ingested_at": OLD,
    }
    return {**base, **given}


def batch(spark, rows):
    return detail(spark, rows).withColumn("reason", F.lit("title_missing;content_sparse"))


def by_id(df):
    rows = df.collect()
    assert len({r["article_id"] for r in rows}) == len(rows)
    return {r["article_id"]: r for r in rows}


def test_upsert_and_audit(spark):
    table = detail(
        spark, [article(1), article(2, quarantine=True), article(3, quarantine=None), article(9)]
    )
    new = batch(
        spark,
        [
            article(1, title="new", quarantine=True, created_at=None),
            article(2, created_at=None), article(3, created_at=None),
            article(4, quarantine=True, created_at=None), article(5, created_at=None),
        ],
    )
    result = ingest(table, new, AS_OF)
    rows = by_id(result.articles)
    assert sorted(rows) == ["id1", "id2", "id3", "id4", "id5", "id9"]
    assert rows["id1"]["title"] == "new" and rows["id1"]["created_at"] == OLD
    assert rows["id4"]["created_at"] == AS_OF
    audit = {(r["article_id"], r["action"], r["reason"]) for r in result.audit_delta.collect()}
    reasons = "title_missing;content_sparse"
    assert audit == {
        ("id1", "mark", reasons), ("id2", "unmark", "heuristic-change"), ("id4", "mark", reasons)
    }


@pytest.mark.parametrize(
    "rows, rule",
    [
        ([article(5, url="https://x/1")], "another article"),
        ([article(5), article(5, url="u")], "article_id repeated"),
        ([article(5), article(6, url="https://x/5")], "url repeated"),
    ],
)
def test_batch_that_breaks_uniqueness_is_refused(spark, rows, rule):
    with pytest.raises(maintenance.DuplicateKey, match=rule):
        ingest(detail(spark, [article(1)]), batch(spark, rows), AS_OF)


def test_moving_a_url_within_the_batch_is_fine(spark):
    table = detail(spark, [article(1), article(2, url=None)])
    moved = [article(1, url="https://x/new"), article(2, url="https://x/1"), article(3, url=None)]
    assert len(by_id(ingest(table, batch(spark, moved), AS_OF).articles)) == 3


ids = st.lists(st.integers(0, 12), unique=True, max_size=8)


@few
@given(old=ids, new=ids)
def test_upsert_is_idempotent(spark, old, new):
    table = detail(spark, [article(i) for i in old])
    changed = batch(spark, [article(i, title="new") for i in new])
    once = ingest(table, changed, AS_OF).articles
    twice = ingest(once, changed, AS_OF)
    assert by_id(once) == by_id(twice.articles)
    assert set(by_id(once)) == {f"id{i}" for i in {*old, *new}}
    assert twice.audit_delta.count() == 0


@few
@given(old=ids, new=ids)
def test_replace_by_key_leaves_one_row_per_key(spark, old, new):
    table = detail(spark, [article(i) for i in old])
    rows = by_id(maintenance.replace_by_key(table, detail(spark, [article(i) for i in new])))
    assert set(rows) == {f"id{i}" for i in {*old, *new}}


@few
@given(st.lists(st.tuples(st.sampled_from([True, False, None]), st.integers(0, 20))))
def test_purge(spark, flags):
    rows = [
        article(i, quarantine=q, ingested_at=AS_OF - timedelta(days=d) if d else None)
        for i, (q, d) in enumerate(flags)
    ]
    table = detail(spark, rows)
    audit = maintenance.approve_audit(table.select("article_id"), AS_OF)
    audit = audit.unionByName(audit)
    kept = maintenance.purge_articles(table, AS_OF)
    want = {f"id{i}" for i, (q, d) in enumerate(flags) if not (q and d > 7)}
    assert set(by_id(kept)) == want == set(by_id(maintenance.purge_articles(kept, AS_OF)))
    assert maintenance.purge_audit(audit, table, AS_OF).count() == 2 * len(want)
    gone = maintenance.purge_counts(audit, table, AS_OF).collect()[0]
    assert (gone["articles_deleted"], gone["audit_deleted"]) == (
        len(rows) - len(want), 2 * (len(rows) - len(want)),
    )


def test_backfill_is_idempotent(spark):
    table = detail(spark, [article(1, quarantine=True), article(2, quarantine=True), article(3)])
    audit = spark.createDataFrame(
        [("id1", "mark", "system", maintenance.BACKFILL_REASON, OLD),
         ("id2", "unmark", "ui", maintenance.BACKFILL_REASON, OLD)],
        schemas.QUARANTINE_AUDIT,
    )
    once = maintenance.backfill(table, audit, AS_OF)
    assert once.count() == 3
    assert maintenance.backfill(table, once, AS_OF).count() == 3


def test_approve(spark):
    table = detail(spark, [article(1, quarantine=True), article(2, quarantine=True), article(3)])
    listed = table.select("article_id").filter("article_id <> 'id2'")
    rows = by_id(maintenance.approve_articles(table, listed.union(listed)))
    assert {k: r["quarantine"] for k, r in rows.items()} == {
        "id1": False, "id2": True, "id3": False
    }


def test_evolve_schema_keeps_what_is_there(spark):
    df = maintenance.evolve_schema(
        spark.createDataFrame([(1, "x")], "a int, b string"),
        {"b": F.lit("y"), "c": F.lit(None).cast("string")},
    )
    assert df.columns == ["a", "b", "c"] and df.collect()[0]["b"] == "x"


def feed(spark, rows):
    return spark.createDataFrame(
        rows, "url string, scraped_at string, ingestion_mode string, article_id string, "
        "published_at string, title string, content string",
    )


def test_keep_last(spark):
    rows = [
        ("u", "2024-01-01", "batch", "a", None, None, None),
        ("u", "2024-01-02", "batch", "b", None, None, None),
        ("u", "2024-01-02", "streaming", "c", None, None, None),
        ("v", "2024-01-02", "batch", "d", None, None, None),
        ("v", None, "batch", "e", None, None, None),
        (None, "2024-01-01", "batch", "f", None, None, None),
        (None, "2024-01-02", "batch", "g", None, None, None),
    ]
    assert {r["article_id"] for r in ranking.keep_last(feed(spark, rows)).collect()} == {
        "c", "e", "g"
    }


def test_keep_first_drops_missing_ids(spark):
    rows = [("a", 1, 0), ("a", 0, 7), ("a", 0, 9), ("", 0, 1), (None, 0, 2), ("b", 3, 3)]
    df = spark.createDataFrame(rows, "article_id string, source_pos int, feed_pos int")
    assert sorted(tuple(r) for r in ranking.keep_first(df).collect()) == [("a", 0, 7), ("b", 3, 3)]


def test_a_source_with_a_third_of_all_rows(spark):
    """Exact results, and no task passes on more than the first rows of a source."""
    df = spark.range(30000, numPartitions=16).select(
        F.col("id").alias("feed_pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))
        ).alias("source"),
    )
    first = ranking.first_n_per_source(df, 25)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and "Partial" in plan
    got = {}
    for r in first.collect():
        got.setdefault(r["source"], []).append(r["feed_pos"])
    assert sorted(got["hot"]) == [3 * i for i in range(25)]
    assert all(len(v) == 25 for v in got.values())


def test_undated_articles_are_most_recent(spark):
    rows = [article(i, published_at=OLD + timedelta(days=i) if i else None) for i in range(14)]
    recent = [r["article_id"] for r in ranking.recent_per_source(detail(spark, rows)).collect()]
    assert recent == ["id0"] + [f"id{i}" for i in range(13, 4, -1)]
    latest = gold.latest_for_source(detail(spark, rows), "s").collect()
    assert [r["article_id"] for r in latest] == recent


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([OLD, None]))))
def test_gold_counts_add_up(spark, pairs):
    rows = [article(i, source=s, published_at=d) for i, (s, d) in enumerate(pairs)]
    tables = gold_plan.warehouse_tables(detail(spark, rows), AS_OF)
    for name, key in gold.COUNT_KEYS.items():
        counted = tables[name].collect()
        assert sum(r["articles_count"] for r in counted) == len(rows)
        assert len({r[key] for r in counted}) == len(counted)


def test_dashboard_defaults_without_articles(spark):
    none = detail(spark, [])
    by_source = gold.count_by(none, "source")
    by_day = gold.count_by(gold.with_published_day(none), "published_day")
    assert tuple(gold.top_source(by_source).collect()[0]) == ("N/A", 0)
    total = gold.total_articles(by_day, by_source, AS_OF, 7, "Toutes")
    assert total.collect()[0]["total"] == 0
    kpi = gold.kpi_metrics(none, AS_OF).collect()[0]
    assert tuple(kpi) == (0, 0, 0, 0)


def test_day_window(spark):
    days = [(AS_OF.date() - timedelta(days=d) if d is not None else None, 1) for d in
            (0, 7, 8, 40, None)]
    df = spark.createDataFrame(days, "published_day date, articles_count long")
    assert gold.day_trend(df, AS_OF, 7).count() == 2
    assert [r[0] for r in gold.day_trend(df, AS_OF, 30).collect()][-1] is None
    assert gold.day_trend(df, AS_OF, 30).count() == 5


def test_source_options(spark):
    df = spark.createDataFrame([("Zed",), ("Hespress",), ("Alpha",)], "source string")
    assert [r["source"] for r in gold.source_options(df).collect()] == [
        "Toutes", "BBC News", "Reuters World", "Hespress", "France24", "Alpha", "Zed",
    ]


def test_recent_hour_excludes_its_start(spark):
    times = [AS_OF - timedelta(hours=1), AS_OF - timedelta(minutes=59), None]
    rows = [article(i, ingested_at=t) for i, t in enumerate(times)]
    fresh = filters.recent_hour(filters.event_time(detail(spark, rows)), AS_OF)
    assert [r["article_id"] for r in fresh.collect()] == ["id1"]


def test_lake_report(spark):
    schema = "title string, published_at timestamp_ntz, content_final string"
    rows = [(" ", OLD, "x" * 200), ("t", None, "x" * 199), (None, OLD, None), ("t", OLD, "x" * 300)]
    got = quality.lake_report(spark.createDataFrame(rows, schema)).collect()[0]
    assert tuple(got) == (4, 2, 1, 2, 62.5, 50.0, 58.33)
    empty = quality.lake_report(spark.createDataFrame([], schema)).collect()[0]
    assert tuple(empty) == (0, 0, 0, 0, 100.0, 100.0, 100.0)


def test_warehouse_checks(spark):
    table = detail(
        spark,
        [article(1, author="Unknown", content="c"), article(2, title="", author=None, content="c"),
         article(3, content="", published_at=AS_OF + timedelta(1))],
    )
    audit = maintenance.approve_audit(
        spark.createDataFrame([("id1",), ("gone",), ("gone",)], "article_id string"), AS_OF
    )
    silver = spark.createDataFrame([(-1, 0.5), (1, 1.2)], "content_length int, data_quality_score double")
    checks = quality.warehouse_checks(table, audit, silver, AS_OF)
    assert {r["name"]: (r["status"], r["value"]) for r in checks.collect()} == {
        "articles_detail.title_null": ("WARN", 1), "articles_detail.author_null": ("WARN", 1),
        "articles_detail.content_null": ("WARN", 1), "orphaned_audit_records": ("FAIL", 2),
        "invalid_dates": ("WARN", 1), "negative_lengths": ("WARN", 1), "invalid_scores": ("WARN", 1),
    }
    assert tuple(quality.checks_summary(checks).collect()[0]) == ("FAIL", 7, 0, 7, 0.0)
    clean = quality.warehouse_checks(detail(spark, [article(1, content="c")]),
                                     audit.limit(0), None, AS_OF)
    assert tuple(quality.checks_summary(clean).collect()[0]) == ("PASS", 5, 5, 0, 100.0)


def test_language_model_knows_the_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held_out = F.col("doc_id") % 3 == 0
    profile = train(documents.where(~held_out), "text", "lang")
    assert profile.languages == ["de", "en", "es", "fr"]
    assert profile.scores.count() <= BUCKETS
    documents = documents.where(held_out)
    found = identify(documents, "doc_id", "text", profile).join(
        documents.select("doc_id", "lang"), "doc_id"
    )
    right = found.agg(F.avg((F.col("lang") == F.col("language")).cast("int"))).collect()[0][0]
    assert found.count() == documents.count() and right > 0.97
    empty = spark.createDataFrame([(1, ""), (2, None), (3, "漢字漢字")], "doc_id int, text string")
    assert {r["language"] for r in identify(empty, "doc_id", "text", profile).collect()} == {
        "unknown"
    }


def test_language_is_scored_by_arrays_as_by_its_definition(spark, monkeypatch):
    odd = ["", None, "a", "  Ünï\tcode\u00a0 \U0001f600x ", "abcabcabc", "zzz" * 40, "漢字漢字漢"]
    rows = [(i, text, ["x", "y", None][i % 3]) for i, text in enumerate(odd * 3)]
    given = spark.createDataFrame(rows, "k int, text string, lang string").coalesce(1)

    def grams(text):
        points = [ord(c) for c in f" {' '.join((text or '').split()).lower()} "]
        return [sum(p * f for p, f in zip(points[i:], FACTORS)) % BUCKETS for i in range(len(points) - 2)]

    counts = {x: Counter(b for _, t, l in rows if l == x for b in grams(t)) for x in "xy"}
    seen = set(counts["x"]) | set(counts["y"])
    score = {
        x: {b: round(math.log((c[b] + 1) / (c.total() + len(seen))) * 10**6) for b in seen}
        for x, c in counts.items()
    }
    expected = {
        k: max((sum(score[x].get(b, 0) for b in grams(t)), x) for x in "xy")[1]
        if seen & set(grams(t)) else "unknown"
        for k, t, _ in rows
    }
    profile = train(given, "text", "lang")
    assert {r["bucket"]: (r["x"], r["y"]) for r in profile.scores.collect()} == {
        b: (score["x"][b], score["y"][b]) for b in seen
    }
    found = identify(given, "k", "text", profile)
    assert {r["k"]: r["language"] for r in found.collect()} == expected
    # trigrams are not interpreted one by one
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    monkeypatch.setattr(language_model, "SLICE", 5)
    texts = [f" {' '.join((t or '').split()).lower()} " for t in odd]
    arrays = language_model._arrays(profile)
    assert language_model._best(texts, arrays, profile.languages) == [expected[i] for i in range(len(odd))]

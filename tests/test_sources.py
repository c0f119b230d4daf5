"""Sinks, versions, streaming and the registered queries as a whole."""

import json
import os
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import check
from __spark_entry__ import entry, oracle_sql, queries
from gazette import schemas
from gazette.checks import corpus
from gazette.checks.oracle import ORACLES
from gazette.checks.queries import QUERIES
from gazette.operators import lookups, maintenance, quality
from gazette.plans import jobs, statements
from gazette.plans import silver as silver_plan
from gazette.plans.ingest import as_detail_batch
from gazette.session import run_dir, scale_conf, shared_dir
from gazette.sources import bronze, config, messages, store, warehouse
from gazette.sources.commits import CommitLog
from gazette.streaming import bounded
from gazette.streaming import ingest as stream
from gazette.streaming import upsert as table

AS_OF = datetime(2024, 1, 31, 1, 0)
SMALL = "/root/testdata/sf0.001"


def articles(spark, n, start=0, **given):
    names = schemas.BRONZE.names
    rows = [
        {**{c: None for c in names}, "article_id": f"id{i}", "title": f"A headline number {i}",
         "url": f"https://x.org/{i}", "source": "s", "content": "é\n" * 60,
         "scraped_at": "2024-01-31T00:30:00Z", **given}
        for i in range(start, start + n)
    ]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schemas.BRONZE)


def test_hour_folder_is_replaced_and_others_stay(spark):
    root = run_dir(spark, "t")
    bronze.write_hour(articles(spark, 3), root, AS_OF)
    bronze.write_hour(articles(spark, 5), root, AS_OF + timedelta(hours=1))
    bronze.write_hour(articles(spark, 2), root, AS_OF)
    assert bronze.scan(spark, root).count() == 7


def test_scan_skips_blank_lines_and_fails_on_broken_ones(spark):
    root = run_dir(spark, "t")
    lines = spark.createDataFrame([('{"article_id": "a"}',), ("",), ('{"url": "u"}',)], "v string")
    lines.coalesce(1).write.text(f"{root}/a/date=x")
    assert bronze.scan(spark, root).count() == 2
    spark.createDataFrame([("{oops",)], "v string").write.text(f"{root}/b")
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST|FAILED_READ"):
        bronze.scan(spark, root).collect()
    with pytest.raises(RuntimeError, match="No bronze"):
        bronze.require_rows(articles(spark, 0))


def test_snapshots_are_kept(spark):
    root = run_dir(spark, "t")
    bronze.write_snapshot(articles(spark, 2), root, AS_OF)
    bronze.write_snapshot(articles(spark, 3), root, AS_OF + timedelta(seconds=1))
    assert bronze.scan(spark, root).count() == 5


def test_readers_see_the_last_complete_version(spark):
    root = run_dir(spark, "t")
    one, two = spark.range(1), spark.range(2)
    first = warehouse.publish(spark, root, {"a": one, "b": one}, AS_OF)
    # a load that did not get as far as its commit
    two.write.parquet(f"{root}/versions/v2/a")
    assert warehouse.read(spark, root, "a").count() == 1
    # a load for the same time, then one for an earlier time: the last commit counts
    warehouse.publish(spark, root, {"a": two, "b": two}, AS_OF)
    assert warehouse.read(spark, root, "b").count() == 2
    assert warehouse.read(spark, root, "b", version=first).count() == 1
    warehouse.publish(spark, root, {"a": one, "b": one}, AS_OF - timedelta(hours=1))
    assert warehouse.read(spark, root, "b").count() == 1


def test_messages_keep_every_field(spark):
    value = messages.to_message_value(articles(spark, 1)).collect()[0]["value"]
    assert '"author":null' in value and "é\\n" in value


def test_stream_resumes_and_keeps_broken_messages_aside(spark):
    inbox, root = run_dir(spark, "in"), run_dir(spark, "out")
    messages.publish_files(articles(spark, 4).repartition(4), inbox)

    def drain():
        raw = stream.read_files(spark, inbox, files_per_batch=1)
        stream.drain_to_hours(raw, root, f"{root}/checkpoint")
        return bronze.scan(spark, f"{root}/streaming")

    drain()
    assert drain().count() == 4
    messages.publish_files(articles(spark, 2, start=4), inbox)
    odd = ["{not json", "", "[1]", "12", '{"article_id": null}', '{"title": "t"}', "null"]
    lines = spark.createDataFrame([(x,) for x in odd], "value string")
    lines.write.mode("append").text(inbox)
    rows = drain().collect()
    assert sorted(r["article_id"] for r in rows) == [f"id{i}" for i in range(6)]
    assert {r["ingestion_mode"] for r in rows} == {"streaming"}
    kept = {r["record"]: r["reason"] for r in spark.read.json(f"{root}/set_aside").collect()}
    assert kept == {
        "{not json": "not an article", "": "empty message", "[1]": "not an article",
        "12": "not an article", '{"article_id": null}': "no article_id",
        '{"title": "t"}': "no article_id", "null": "not an article",
    }
    tombstone = spark.createDataFrame([(None,)], "value string")
    assert stream.decode(tombstone).count() == 0
    assert stream.aside(tombstone).collect()[0]["reason"] == "empty message"


def test_batches_of_the_article_table(spark):
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)
    assert jobs.detail(spark, root).count() == 0
    with pytest.raises(store.Conflict):
        jobs.create_warehouse(spark, root, AS_OF)
    run = jobs.warehouse_run(spark, root, articles(spark, 4), 1, AS_OF)
    assert run.applied and tuple(run.metrics.collect()[0]) == (4, 0, 0, 1)
    assert {r["status"] for r in run.checks.collect()} == {"PASS"}
    later = AS_OF + timedelta(minutes=10)
    changed = articles(spark, 2, start=3, title="Short")
    unnamed = articles(spark, 1, article_id=None)
    for _ in range(2):  # a repeated batch changes nothing
        given = changed.unionByName(changed).unionByName(unnamed)
        assert jobs.apply_batch(spark, root, given, "run", 2, later)
    aside = jobs.set_aside(spark, root).groupBy("reason").count().collect()
    assert {tuple(r) for r in aside} == {(jobs.REPEATED, 2), (jobs.NO_ID, 1)}
    rows = {r["article_id"]: r for r in jobs.detail(spark, root).collect()}
    assert len(rows) == 5 and rows["id3"]["title"] == "Short"
    assert rows["id3"]["created_at"] == AS_OF and rows["id4"]["created_at"] == later
    assert {(r["article_id"], r["action"]) for r in jobs.audit(spark, root).collect()} == {
        ("id3", "mark"), ("id4", "mark")
    }
    # another article with a URL that is taken: the batch is refused and kept
    clash = articles(spark, 1, start=9, url="https://x.org/1")
    assert not jobs.warehouse_run(spark, root, clash, 3, later).applied
    assert not jobs.apply_batch(spark, root, clash, "run", 3, later)
    refused = jobs.set_aside(spark, root).where(F.col("reason").startswith(jobs.REFUSED))
    assert [r["article_id"] for r in refused.collect()] == ["id9"]
    silver = jobs.silver_table(spark, root)
    assert {r["article_id"]: r["silver_timestamp"] for r in silver.collect()} == {
        f"id{i}": later for i in range(5)
    }
    before = sorted(jobs.detail(spark, root).collect()), sorted(silver.collect())
    for _ in range(2):  # a repeated compaction changes nothing
        jobs.compact_warehouse(spark, root, later)
    after = jobs.detail(spark, root), jobs.silver_table(spark, root)
    assert tuple(sorted(df.collect()) for df in after) == before
    gold = {t: warehouse.read(spark, f"{root}/gold", t).collect() for t in (
        "articles_by_theme", "daily_article_trends", "analytics_summary")}
    assert [(r["theme"], r["articles_count"], r["last_updated"]) for r in gold["articles_by_theme"]] == [
        ("autre", 5, later)
    ]
    assert gold["daily_article_trends"] == []  # none of them is dated
    assert gold["analytics_summary"][0]["total_articles"] == 5
    # an article gives its URL up; another one takes it in the next batch
    moved = articles(spark, 1, start=1, url="https://x.org/new")
    assert jobs.apply_batch(spark, root, moved, "other", 1, later)
    assert jobs.apply_batch(spark, root, clash, "other", 2, later)


def test_a_new_warehouse_makes_its_articles_once(spark):
    """Before, each of the five tables that hold something of them made them anew."""
    root, made = run_dir(spark, "warehouse"), spark.sparkContext.accumulator(0)
    judged = as_detail_batch(articles(spark, 4)).withColumn("created_at", F.lit(AS_OF).cast("timestamp_ntz"))
    rows = judged.select(*schemas.ARTICLES_DETAIL.names)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    jobs.create_warehouse(spark, root, AS_OF, rows.mapInArrow(seen, rows.schema))
    assert made.value == 4 and jobs.detail(spark, root).count() == 4
    tables = jobs.warehouse_store(spark, root)
    assert tables.current("url_owner").count() == rows.where("url IS NOT NULL").count() > 0
    assert tables.current("article_counts").agg(F.sum("n")).first()[0] == 4
    assert tables.current("keyword_counts").count() > 0


def test_a_failed_commit_leaves_no_trace(spark, monkeypatch):
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)

    def fail(*args, **given):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store.Store, "_commit", fail)
        with pytest.raises(OSError):
            jobs.apply_batch(spark, root, articles(spark, 3, title="Short"), "run", 1, AS_OF)
    assert jobs.detail(spark, root).count() == 0 and jobs.audit(spark, root).count() == 0
    assert jobs.apply_batch(spark, root, articles(spark, 3, title="Short"), "run", 1, AS_OF)
    assert jobs.detail(spark, root).count() == 3 and jobs.audit(spark, root).count() == 3


def test_another_writer_in_between_is_refused(spark):
    """A commit made after a batch has looked at the tables, and before its own."""
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)
    ours, theirs = (jobs.warehouse_store(spark, root) for _ in range(2))
    audit = maintenance.approve_audit(articles(spark, 1), AS_OF)
    state = ours.state()
    theirs.commit(AS_OF, rows={"quarantine_audit": audit})
    with pytest.raises(store.Conflict):
        ours.commit(AS_OF, rows={"quarantine_audit": audit}, state=state)
    assert ours.last() == 1 and jobs.audit(spark, root).count() == 1
    # the name of a record can be taken once only, whatever the state says
    assert not ours.log.add(f"{1:012d}", {"sequence": 1})


def test_writers_in_parallel_lose_nothing(spark):
    """Three writers with articles of their own and one that all of them change."""
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)

    def run(i):
        rows = articles(spark, 2, start=10 * i).unionByName(articles(spark, 1, start=99, title=f"By {i}"))
        return jobs.apply_batch(spark, root, rows, f"writer {i}", 1, AS_OF)

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(run, range(3))) == [True] * 3
    names = jobs.warehouse_store(spark, root).log.names()
    assert [n for n in names if not n.startswith("base")] == [f"{i:012d}" for i in (1, 2, 3)]
    rows = {r["article_id"]: r for r in jobs.detail(spark, root).collect()}
    assert sorted(rows) == sorted([f"id{10 * i + j}" for i in range(3) for j in range(2)] + ["id99"])
    # the one that came last has seen what the others did: the counts add up
    by_source = jobs.gold_tables(spark, root, AS_OF)["articles_by_source"].collect()
    assert [(r["source"], r["articles_count"]) for r in by_source] == [("s", 7)]


def opened(df):
    """The scans of the plan that will run: (columns, files they read)."""
    plan, out = df._jdf.queryExecution().executedPlan(), []
    leaves = (plan.initialPlan() if "Adaptive" in plan.nodeName() else plan).collectLeaves()
    for i in range(leaves.size()):
        if "Scan parquet" in leaves.apply(i).nodeName():
            parts = leaves.apply(i).inputRDD().partitions()
            found = [f.urlEncodedPath() for p in parts for f in p.files()]
            out.append((leaves.apply(i).output().toString(), found))
    return out


def test_the_last_hour_reads_its_days_only(spark):
    """Folders of other days are not opened for content, in the base and in later commits."""
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)
    for n, day in enumerate(("2024-01-27", "2024-01-28", "2024-01-31", "2024-01-29", "2024-01-31")):
        if n == 3:
            jobs.compact_warehouse(spark, root, AS_OF)
        given = articles(spark, 3, start=2 * n, scraped_at=f"{day}T00:30:00Z")
        jobs.apply_batch(spark, root, given, "run", n, AS_OF)
    since = AS_OF - timedelta(hours=1)
    recent = jobs.recent_detail(spark, root, since)
    # the commit of another day is read for its keys alone
    other = [c for c in jobs.warehouse_store(spark, root).state().commits
             if c["days"].get("articles_detail") == ["2024-01-29", "2024-01-29"]]
    assert len(other) == 1
    texts = [files for columns, files in opened(recent) if "content" in columns]
    files = [f for scan in texts for f in scan]
    assert any("/base-" in f for f in files) and any("/commit-" in f for f in files)
    assert all("_day=2024-01-31" in f for f in files if "/base-" in f)
    assert not any(other[0]["folder"].rsplit("/", 1)[1] in f for f in files)
    # and so does the silver of the hour, as planned over the stored tables
    hour = silver_plan.warehouse_silver(recent, AS_OF)
    assert {f for c, scan in opened(hour) if "content" in c for f in scan} == set(files)
    whole = jobs.detail(spark, root).where(F.col("ingested_at") > F.lit(since.isoformat(" ")).cast("timestamp_ntz"))
    assert sorted(recent.collect()) == sorted(whole.collect())
    # an article taken in anew moves to its new day, one that is gone from the day stays away
    ids = {r["article_id"] for r in recent.collect()}
    assert ids == {"id4", "id5", "id8", "id9", "id10"}


def small_store(spark):
    """Rows (k, at, n) by key and day, and counts (name, n) that add up."""
    tables = {
        "rows": store.Table(
            T.StructType.fromDDL("k string, at timestamp_ntz, n long"), "k", day=lambda: F.col("at")
        ),
        "counts": store.Table(T.StructType.fromDDL("name string, n long"), "name", False, sums=("n",)),
    }
    out = store.Store(spark, run_dir(spark, "store"), tables)
    out.create(AS_OF, buckets=16)
    return out


def keyed(spark, numbers, n=0, day=1):
    rows = [(f"k{i}", datetime(2024, 1, day), n) for i in numbers]
    return spark.createDataFrame(rows, "k string, at timestamp_ntz, n long")


def test_compaction_leaves_untouched_buckets_alone(spark, monkeypatch):
    tables = small_store(spark)
    one = spark.createDataFrame([("a", 2), ("b", 1)], "name string, n long")
    tables.commit(AS_OF, {"rows": keyed(spark, range(60)), "counts": one}, writer="run", batch=1)
    tables.compact(AS_OF)
    first = set(tables.current("rows").inputFiles())
    less = spark.createDataFrame([("a", -1), ("b", -1)], "name string, n long")
    tables.commit(AS_OF, {"rows": keyed(spark, [7], 5, day=2), "counts": less}, writer="run", batch=2)
    assert {r["n"] for r in tables.current("rows").where("k = 'k7'").collect()} == {5}
    tables.compact(AS_OF)
    kept = {f for columns, files in opened(tables.current("rows")) for f in files}
    assert len(first - kept) == 1 and len(kept - first) <= 2 and len(first & kept) > 10
    rows = {r["k"]: r["n"] for r in tables.current("rows").collect()}
    assert len(rows) == 60 and rows["k7"] == 5 and sum(rows.values()) == 5
    # counts that have become nothing are gone, others are one row
    assert sorted(map(tuple, tables.current("counts").collect())) == [("a", 1)]
    # what was committed before is still known, after its records are gone
    tables.commit(AS_OF, {"rows": keyed(spark, [61])}, writer="run", batch=3)
    tables.compact(AS_OF)
    assert [tables.note("run", i) for i in (1, 2, 3, 4)] == ["applied"] * 3 + [None]
    assert f"{1:012d}" not in tables.log.names()
    assert tables.commit(AS_OF, {"rows": keyed(spark, [7], 9)}, writer="run", batch=2) == "applied"
    assert {r["n"] for r in tables.current("rows").where("k = 'k7'").collect()} == {5}
    # many small bases become one again
    monkeypatch.setattr(store, "PARTS", 2)
    tables.commit(AS_OF, {"rows": keyed(spark, [3], 1)})
    tables.compact(AS_OF)
    assert len(tables.state().base["parts"]["rows"]) == 1 and tables.current("rows").count() == 61


def test_deleted_keys_stay_away_and_days_are_kept_apart(spark):
    tables = small_store(spark)
    tables.commit(AS_OF, {"rows": keyed(spark, range(6), day=1)})
    tables.commit(AS_OF, {"rows": keyed(spark, [0, 1, 9], 1, day=3)}, {"rows": keyed(spark, [5])})
    for _ in range(2):
        late = tables.current("rows", since=datetime(2024, 1, 2).date())
        assert {r["k"] for r in late.collect()} == {"k0", "k1", "k9"}
        assert {r["k"] for r in tables.current("rows").collect()} == {
            "k0", "k1", "k2", "k3", "k4", "k9"
        }
        tables.compact(AS_OF)
    # a row that moves back to an earlier day leaves its later one
    tables.commit(AS_OF, {"rows": keyed(spark, [9], 2, day=1)}, {"rows": keyed(spark, [0])})
    late = tables.current("rows", since=datetime(2024, 1, 2).date())
    assert {r["k"] for r in late.collect()} == {"k1"}


def test_columns_added_to_stored_tables(spark):
    """Rows of older folders have the default, also after a compaction and next to nulls."""
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)
    tables = jobs.warehouse_store(spark, root)
    jobs.apply_batch(spark, root, articles(spark, 2), "run", 1, AS_OF)
    for _ in range(2):  # repeatable
        tables.add_column(AS_OF, "articles_detail", "region", "string", "home")
    with pytest.raises(ValueError, match="region"):
        tables.add_column(AS_OF, "articles_detail", "region", "int")
    jobs.apply_batch(spark, root, articles(spark, 1, start=2), "run", 2, AS_OF)
    state = tables.state()
    new = tables.current("articles_detail", state=state).where("article_id = 'id1'")
    tables.commit(AS_OF, {"articles_detail": new.withColumn("region", F.lit(None).cast("string"))}, state=state)
    for _ in range(2):
        found = jobs.detail(spark, root)
        assert found.columns == [*schemas.ARTICLES_DETAIL.names, "region"]
        assert {r["article_id"]: r["region"] for r in found.collect()} == {
            "id0": "home", "id1": None, "id2": "home"
        }
        jobs.compact_warehouse(spark, root, AS_OF)
    # batches after that come with their own value or the default
    jobs.apply_batch(spark, root, articles(spark, 1, start=1), "run", 3, AS_OF)
    assert {r["region"] for r in jobs.detail(spark, root).collect()} == {"home"}


def test_a_batch_reads_only_the_buckets_of_its_keys(spark):
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF, as_detail_batch(articles(spark, 40)).withColumn(
        "created_at", F.lit(AS_OF)))
    near = articles(spark, 1, start=7)
    found = jobs.warehouse_store(spark, root).current("articles_detail", near=near)
    ids = {r["article_id"] for r in found.collect()}
    assert "id7" in ids and len(ids) < 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan


def test_maintenance_of_the_stored_tables(spark):
    root = run_dir(spark, "warehouse")
    old = AS_OF - timedelta(days=9)
    jobs.create_warehouse(spark, root, old)
    jobs.apply_batch(spark, root, articles(spark, 3, title="Short", scraped_at="2024-01-20T00:00:00Z"),
                     "run", 1, old)
    jobs.apply_batch(spark, root, articles(spark, 2, start=3, title="Short"), "run", 2, AS_OF)
    ids = spark.createDataFrame([("id0",), ("id3",)], "article_id string")
    jobs.approve_in_warehouse(spark, root, ids, AS_OF)
    jobs.backfill_warehouse(spark, root, AS_OF)
    jobs.backfill_warehouse(spark, root, AS_OF)
    actions = jobs.audit(spark, root).groupBy("action").count().collect()
    assert {tuple(r) for r in actions} == {("mark", 8), ("unmark", 2)}
    gone = jobs.purge_warehouse(spark, root, AS_OF).collect()
    assert tuple(gone[0]) == (2, 4)
    for _ in range(2):
        assert {r["article_id"]: r["quarantine"] for r in jobs.detail(spark, root).collect()} == {
            "id0": False, "id3": False, "id4": True
        }
        assert {r["article_id"] for r in jobs.audit(spark, root).collect()} == {"id0", "id3", "id4"}
        jobs.compact_warehouse(spark, root, AS_OF)
    # the URLs of purged articles are free
    taken = articles(spark, 1, start=8, url="https://x.org/1")
    assert jobs.apply_batch(spark, root, taken, "run", 3, AS_OF)


def test_streamed_upserts(spark):
    root, inbox = run_dir(spark, "table"), run_dir(spark, "in")
    jobs.create_warehouse(spark, root, AS_OF)
    messages.publish_files(articles(spark, 3).repartition(3), inbox)
    spark.createDataFrame([("{oops",)], "value string").write.mode("append").text(inbox)
    for checkpoint in "aab":  # the second drain finds nothing new, the third starts over
        raw = stream.read_files(spark, inbox, files_per_batch=2)
        table.drain_to_table(raw, root, f"{root}/{checkpoint}", lambda: AS_OF)
        jobs.compact_warehouse(spark, root, AS_OF)
    assert jobs.apply_batch(spark, root, articles(spark, 1, start=3), "run", 0, AS_OF)
    assert sorted(r["article_id"] for r in jobs.detail(spark, root).collect()) == [
        "id0", "id1", "id2", "id3"
    ]
    assert {r["record"] for r in jobs.set_aside(spark, root).collect()} == {"{oops"}


def test_lake_run(spark):
    root = run_dir(spark, "lake")
    bronze.write_hour(articles(spark, 3, title="A match"), f"{root}/bronze", AS_OF)
    streamed = articles(spark, 2, start=2, title="Streamed", scraped_at="2024-01-31T00:40:00Z")
    inbox = run_dir(spark, "in")
    messages.publish_files(streamed, inbox)
    stream.drain_to_hours(stream.read_files(spark, inbox), f"{root}/bronze", f"{root}/checkpoint")
    taught = spark.createDataFrame([("a match of the day", "en"), ("un jour de plus", "fr")], "t string, l string")
    profile = jobs.train_language(spark, root, taught, "t", "l", AS_OF)
    silver = jobs.lake_silver(spark, root, AS_OF, profile)
    assert {r["language"] for r in silver.collect()} == {"unknown"}
    assert {r["article_id"]: r["title"] for r in silver.collect()} == {
        "id0": "A match", "id1": "A match", "id2": "Streamed", "id3": "Streamed"
    }
    assert jobs.lake_quality(spark, root, AS_OF).collect()[0]["date_manquante"] == 4
    jobs.lake_gold(spark, root, AS_OF)
    themes = warehouse.read(spark, f"{root}/gold", "articles_by_theme").collect()
    assert {r["theme"]: r["articles_count"] for r in themes} == {"sport": 2, "autre": 2}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert run_dir(spark, "a") != run_dir(spark, "a")
    assert scale_conf(10**14, 8000)["spark.sql.shuffle.partitions"] == "745059"


def test_source_file(spark):
    path = f"{run_dir(spark, 'config')}/sources.yml"
    text = """# feeds
sources:
  - name: s  # short
    country: Maroc
    rss_url: https://s.org/feed#top
  - name: "L'Officiel"
    rss_url: 'https://o.org/feed' # quoted
  - country: France
    rss_url: https://nameless.org/
  - name: s
    rss_url: https://again.org/
  - name: t
    country: ''
  - name: t
    rss_url: https://t.org/
other:
  - name: not a source
"""
    spark.createDataFrame([(text,)], "v string").coalesce(1).write.text(path)
    found = config.load_sources(spark, path)
    assert found == [
        ("s", "Maroc", "https://s.org/feed#top"), ("L'Officiel", "Unknown", "https://o.org/feed"),
        ("t", "Unknown", "https://t.org/"),
    ]
    _, aside = config.checked(config.read_entries(spark, path))
    assert sorted((r["position"], r["reason"]) for r in aside.collect()) == [
        (3, config.NO_NAME), (4, config.REPEATED), (5, config.NO_URL)
    ]
    joined = lookups.with_country(articles(spark, 1).drop("source_country"), found)
    assert joined.collect()[0]["source_country"] == "Maroc"
    config.write_sources(spark, path, found)
    assert config.load_sources(spark, path) == found


def test_an_hour_of_silver_leaves_untouched_buckets_alone(spark):
    root = run_dir(spark, "lake")

    def hour(n, rows):
        at = AS_OF + timedelta(hours=n)
        bronze.write_hour(rows, f"{root}/bronze", at)
        jobs.lake_silver_hour(spark, root, at)
        files = {f.split("/articles_silver/")[1] for f in jobs.lake_silver_table(spark, root).inputFiles()}
        report = jobs.lake_quality(spark, root, at).drop("generated_at")
        whole = quality.lake_report(jobs.lake_silver_table(spark, root))
        assert report.collect() == whole.collect()
        return files

    first = hour(0, articles(spark, 50))
    assert len(first) > 20
    later = articles(spark, 1, start=7, title="", scraped_at="2024-01-31T03:00:00Z")
    second = hour(1, later)
    assert len(first - second) == 1 and len(second - first) == 1
    third = hour(1, later)  # a repeated hour changes no row
    assert len(second - third) <= 1
    rows = {r["article_id"]: r["title"] for r in jobs.lake_silver_table(spark, root).collect()}
    assert len(rows) == 50 and rows["id7"] == "" and rows["id8"] == "A headline number 8"
    # a run that was lost while it wrote: the counters are gathered anew
    jobs._keep_counters(spark, root, None)
    fourth = hour(2, articles(spark, 3, start=60, scraped_at=None))
    assert jobs.lake_silver_table(spark, root).count() == 53 and len(fourth - third) <= 3


def test_silver_hours_are_put_together_by_one_exchange(spark):
    """Wide rows travel once to be chosen and written, and the sources do not make them travel."""
    root = run_dir(spark, "lake")
    rows = articles(spark, 40).unionByName(articles(spark, 5, start=50, url=None))
    bronze.write_hour(rows, f"{root}/bronze", AS_OF)
    jobs.lake_silver_hour(spark, root, AS_OF)
    held = jobs.lake_silver_table(spark, root).checkpoint()
    later = articles(spark, 9, start=30, title="later", scraped_at="2024-01-31T03:00:00Z")
    gone = articles(spark, 1, start=60, url=None, scraped_at=None)
    fresh = silver_plan.lake_silver(bronze.stamp_batch(later.unionByName(gone), AS_OF)
                               .withColumn("stream_received_at", F.lit(None).cast("string"))).checkpoint()
    merged = jobs._merged(held, fresh)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange rebalance" not in plan
    whole = silver_plan.latest_by_url(held.unionByName(fresh))
    key = lambda r: (r["article_id"], r["title"])
    found = merged.drop("_bucket").collect()
    assert sorted(found, key=key) == sorted(whole.collect(), key=key) and len(found) == 41
    placed = lookups.with_country(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in placed and "BroadcastHashJoin" in placed


def test_quality_is_read_from_counters(spark, monkeypatch):
    """No article text or silver row is read for the checks."""
    root = run_dir(spark, "warehouse")
    jobs.create_warehouse(spark, root, AS_OF)
    odd = [
        articles(spark, 2, title=""), articles(spark, 2, start=2, author="Unknown"),
        articles(spark, 1, start=4, content=None),
        articles(spark, 1, start=5, published_at="2024-01-31T01:30:00Z"),
    ]
    batch = odd[0].unionByName(odd[1]).unionByName(odd[2]).unionByName(odd[3])
    run = jobs.warehouse_run(spark, root, batch, 1, AS_OF)

    def values(as_of):
        checks = jobs.kept_checks(spark, root, as_of)
        table, silver = jobs.detail(spark, root), jobs.silver_table(spark, root)
        plain = quality.warehouse_checks(table, jobs.audit(spark, root), silver, as_of)
        assert sorted(checks.collect()) == sorted(plain.collect())
        scans = opened(checks)
        assert not any("content" in columns or "title" in columns for columns, _ in scans)
        return {r["name"].split(".")[-1]: r["value"] for r in checks.collect()}

    assert sorted(run.checks.collect()) == sorted(jobs.kept_checks(spark, root, AS_OF).collect())
    assert values(AS_OF) == {
        "title_null": 2, "author_null": 2, "content_null": 1, "invalid_dates": 1,
        "orphaned_audit_records": 0, "negative_lengths": 0, "invalid_scores": 0,
    }
    # a title comes, and the time that lay ahead has passed
    later = AS_OF + timedelta(hours=1)
    jobs.apply_batch(spark, root, articles(spark, 1, title="A title at last"), "run", 2, later)
    jobs.compact_warehouse(spark, root, later)
    assert values(later) | {"title_null": 1, "invalid_dates": 0} == values(later)


def test_bounded_runs_go_on_where_they_ended(spark, monkeypatch):
    inbox, root = run_dir(spark, "in"), run_dir(spark, "out")
    assert bounded.drain(spark, inbox, root) == 0
    messages.publish_files(articles(spark, 25).repartition(3), inbox)

    def seen():
        return sorted(r["article_id"] for r in bronze.scan(spark, f"{root}/streaming").collect())

    assert bounded.drain(spark, inbox, root, 10, AS_OF) == 10
    assert len(set(seen())) == 10
    # a run that was lost before it noted how far it came is done again in its place
    with monkeypatch.context() as patch:
        add = CommitLog.add
        patch.setattr(CommitLog, "add", lambda self, n, r: n.endswith("-begun") and add(self, n, r))
        with pytest.raises(RuntimeError, match="another consumer"):
            bounded.drain(spark, inbox, root, 10, AS_OF)
    assert bounded.drain(spark, inbox, root, 10, AS_OF + timedelta(hours=5)) == 10
    assert len(seen()) == len(set(seen())) == 20
    lines = spark.createDataFrame([("{oops",), ("",), ('{"article_id": "last"}',)], "v string")
    lines.coalesce(1).write.mode("append").text(inbox)
    monkeypatch.setattr(bounded, "FOLDED", 2)
    counts = []
    while not counts or counts[-1]:
        counts.append(bounded.drain(spark, inbox, root, 3, AS_OF))
    assert sum(counts) == 8 and max(counts) == 3
    assert seen() == sorted([f"id{i}" for i in range(25)] + ["last"])
    aside = spark.read.json(f"{root}/set_aside").collect()
    assert sorted(r["reason"] for r in aside) == ["empty message", "not an article"]
    # names of finished files are put together, older records are gone
    assert len(CommitLog(spark, f"{root}/consumed").names()) < 8


def test_bounded_runs_that_follow_each_other_are_one_job(spark, monkeypatch):
    inbox, root = run_dir(spark, "in"), run_dir(spark, "out")
    messages.publish_files(articles(spark, 25).repartition(3), inbox)
    assert bounded.drain(spark, inbox, root, 4, AS_OF) == 4

    def runs(folder):
        found = spark.read.json(f"{root}/{folder}").groupBy("run").count().collect()
        return {int(r["run"]): r["count"] for r in found}

    with monkeypatch.context() as patch:
        add = CommitLog.add
        patch.setattr(CommitLog, "add", lambda self, n, r: n.endswith("-begun") and add(self, n, r))
        with pytest.raises(RuntimeError, match="another consumer"):
            bounded.drain(spark, inbox, root, 4, AS_OF, runs=2)
    # lost runs are done again together, at the time they began
    assert bounded.drain(spark, inbox, root, 4, AS_OF + timedelta(hours=5), runs=None) == 8
    lines = spark.createDataFrame([("{oops",), ('{"article_id": "last"}',)], "v string")
    lines.coalesce(1).write.mode("append").text(inbox)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("drain", "drain")
    assert bounded.drain(spark, inbox, root, 4, AS_OF, runs=None) == 15
    jobs_used = len(status.getJobIdsForGroup("drain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_used < 12
    assert runs("streaming") == {1: 4, 2: 4, 3: 4, 4: 4, 5: 4, 6: 4, 7: 2} and runs("set_aside") == {7: 1}
    ids = [r["article_id"] for r in bronze.scan(spark, f"{root}/streaming").collect()]
    assert sorted(ids) == sorted([f"id{i}" for i in range(25)] + ["last"])
    assert [r["run"] for r in bounded.consumed(spark, root).orderBy("run").collect()] == list(range(1, 8))
    assert bounded.drain(spark, inbox, root, 4, AS_OF, runs=None) == 0


def test_bounded_runs_read_large_files_in_splits(spark):
    inbox, root = run_dir(spark, "in"), run_dir(spark, "out")
    folder = Path(inbox.removeprefix("file:"))
    folder.mkdir(parents=True)
    texts = [json.dumps({"article_id": f"id{i}", "title": "é" * (i % 7 * 40)}, ensure_ascii=False) for i in range(600)]
    texts[10], texts[333] = "", '{"article_id": "in\rside"'
    given = {"b.txt": "\r\n".join(texts[:400]) + "\r\n", "a 1%.txt": "\n".join(texts[400:]), "c.txt": "\n\n"}
    for name, written in given.items():
        (folder / name).write_text(written, encoding="utf-8", newline="")
        os.utime(folder / name, (1000 + ord(name[0]), 1000 + ord(name[0])))
    expected = [*texts[400:], *texts[:400], "", ""]
    conf = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    spark.sparkContext.setJobGroup("splits", "splits")
    try:
        counts = [bounded.drain(spark, inbox, root, 30, AS_OF, runs) for runs in (1, 7, 2, None, None)]
        status = spark.sparkContext.statusTracker()
        stages = [s for j in status.getJobIdsForGroup("splits") for s in status.getJobInfo(j).stageIds]
        tasks = max(x.numTasks for s in stages if (x := status.getStageInfo(s)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for key in conf:
            spark.conf.unset(key)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    assert counts == [30, 210, 60, len(expected) - 300, 0]
    taken = spark.read.json(f"{root}/streaming").select("run", "article_id").collect()
    aside = spark.read.json(f"{root}/set_aside").select("run", "record").collect()
    whole = [json.loads(x)["article_id"] if x.endswith("}") else x for x in expected]
    assert Counter((int(run), x) for run, x in [*taken, *aside]) == Counter((i // 30 + 1, x) for i, x in enumerate(whole))
    # no task has a whole file
    assert tasks > 20


def test_a_bounded_run_fails_if_files_are_split_anew(spark, monkeypatch):
    inbox, root = run_dir(spark, "in"), run_dir(spark, "out")
    messages.publish_files(articles(spark, 25).repartition(3), inbox)
    counted = bounded._splits

    def other(lines, names):
        return {n: [x._replace(first=x.first - 1) for x in found] for n, found in counted(lines, names).items()}

    with monkeypatch.context() as patch:
        patch.setattr(bounded, "_splits", other)
        with pytest.raises(Exception, match="split anew"):
            bounded.drain(spark, inbox, root, 10, AS_OF, runs=2)
    assert bounded.drain(spark, inbox, root, 10, AS_OF + timedelta(hours=5)) == 20
    assert bounded.drain(spark, inbox, root, 10, AS_OF) == 5
    ids = [r["article_id"] for r in bronze.scan(spark, f"{root}/streaming").collect()]
    assert sorted(ids) == sorted(f"id{i}" for i in range(25))


def test_statements_bind_their_values(spark):
    name = "L'Officiel; DROP TABLE x --\" OR 1=1"
    counts = spark.createDataFrame([(name, 3), ("s", 4), (None, 9)], "source string, articles_count long")
    tables = {"articles_by_source": counts}
    assert statements.run(spark, tables, "source_total", source=name).collect()[0][0] == 3
    assert statements.run(spark, tables, "source_total", source="' OR ''='").collect()[0][0] == 0
    assert tuple(statements.run(spark, tables, "top_source").collect()[0]) == (None, 9)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("articles")]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["theme", "articles_count"]
    assert rows.agg(F.sum("articles_count")).collect()[0][0] > 0


@pytest.mark.parametrize(
    "name",
    ["quarantine_reasons", "pages_best_title", "pages_paragraphs", "content_final",
     "articles_by_theme", "top_keywords_content", "dedup_keep_last", "quality_suite",
     "normalize_published_at", "daily_article_trends", "silver_lake"],
)
def test_query_agrees_with_its_sql(spark, name):
    assert check.compare(spark, check.database(SMALL), SMALL, name).same


def test_no_query_leaves_the_jvm_or_crosses(spark):
    for name in ["silver_lake", "silver_warehouse", "purge_counts", "quality_suite",
                 "extract_articles", "top_keywords_content", "approve_articles"]:
        plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        for operator in ("Python", "InArrow", "InPandas", "CartesianProduct", "NestedLoopJoin"):
            assert operator not in plan, (name, operator)


def test_scans_read_only_what_they_need(spark):
    plan = queries()["articles_by_source"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
    assert corpus.table(spark, SMALL, "documents").columns

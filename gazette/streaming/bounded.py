"""A consumer that takes a bounded number of messages a run and goes on from there.

The position is a message: files count in the order of their time and name, and
within a file by line. Each run has a number in a log of its own: it first notes
when it received its messages, writes them to a folder that follows from both,
and then notes how far it came. A run that failed in between is done again with
the same number and time, and so replaces what it had written. Runs that follow
each other can be done by one job; then they are noted and done again together.

Files are read by line and in splits, so a task holds one message at a time however
large a file is. What is counted before tells where in its file a split begins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette import constants as C
from gazette.operators.filters import moment
from gazette.sources.commits import CommitLog
from gazette.streaming.ingest import aside, decode

#: Records whose file names are put together in one.
FOLDED = 50
_LEAST_SPLITS = "spark.sql.files.minPartitionNum"


class Split(NamedTuple):
    """A split of a file: the file's last name, where it starts, the number of its first line, its lines."""

    tail: str
    start: int
    first: int
    n: int


def _files(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Message files that hold anything, by time and name."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [(f.getModificationTime(), f.getPath().toString(), f.getLen()) for f in files.listStatus(folder) if f.isFile()]
    return sorted((t, name) for t, name, size in found if size and name.rsplit("/", 1)[1][0] not in "._")


def _position(log: CommitLog) -> tuple[int, set[str], dict[str, int], dict[str, int], list[str]]:
    """Number of the next run, files read to their end, lines read of others, lines they have, records in use."""
    names = [n for n in log.names() if not n.endswith("-begun")]
    folded = [n for n in names if n.startswith("all-")]
    last = max(folded, default=None)
    since = int(last[4:]) if last else 0
    later = [n for n in names if not n.startswith("all-") and int(n) > since]
    records = [log.read(n) for n in ([last] if last else []) + later]
    done = {name for record in records for name in record["done"]}
    partial, known = (records[-1].get(k, {}) if records else {} for k in ("partial", "lines"))
    runs = sum(log.read(n).get("runs", 1) for n in later)
    return since + runs + 1, done, partial, known, later


def _lines(spark: SparkSession, names: list[str]) -> DataFrame:
    """The messages of files: value, file and split, and a number that counts up within the split."""
    return spark.read.text(names, lineSep="\n").select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("tail"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
        F.regexp_replace("value", r"\r\z", "").alias("value"),
    )


def _splits(lines: DataFrame, names: list[str]) -> dict[str, list[Split]]:
    """The splits of each of the files that have lines, in order."""
    found = lines.groupBy("tail", "start").agg(F.min("id"), F.count("*")).collect()
    named = {name.rsplit("/", 1)[1]: name for name in names}
    splits: dict[str, list[Split]] = {name: [] for name in names}
    for split in sorted(Split(*row) for row in found):
        splits[named[unquote(split.tail)]].append(split)
    return splits


def _placed(lines: DataFrame, splits: dict[str, list[Split]], before: dict[str, int], skipped: dict[str, int]) -> DataFrame:
    """value and place of the messages; the first line of a file has the place before[name], skipped ones have none.

    Fails where a line is not in the split that was counted, as its place would be another's.
    """
    rows = []
    for name, found in splits.items():
        lines_before = 0
        for split in found:
            skip = min(max(skipped[name] - lines_before, 0), split.n)
            rows.append((*split, skip, before[name] + lines_before))
            lines_before += split.n
    schema = "tail string, start long, first long, n long, skip long, place long"
    given = F.broadcast(lines.sparkSession.createDataFrame(rows, schema))
    line = F.col("id") - F.col("first")
    place = (
        F.when(line.between(F.col("skip"), F.col("n") - 1), F.col("place") + line)
        .when(line.between(0, F.col("skip") - 1), F.lit(None))
        .otherwise(F.raise_error(F.concat(F.lit("split anew since it was counted: "), "tail")))
    )
    return lines.join(given, ["tail", "start"], "left").select("value", place.alias("place"))


@contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Files are split in one way within, whatever executors come or go."""
    before = spark.conf.get(_LEAST_SPLITS, None)
    spark.conf.set(_LEAST_SPLITS, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LEAST_SPLITS)
        else:
            spark.conf.set(_LEAST_SPLITS, before)


def drain(
    spark: SparkSession,
    path: str,
    root: str,
    max_messages: int = C.MAX_MESSAGES,
    received_at: datetime | None = None,
    runs: int | None = 1,
) -> int:
    """Take up to max_messages from the folder to the hour folders of root; how many were taken.

    Articles go to streaming/date=/hour=/, other messages to set_aside, as in
    drain_to_hours. At most max_messages files are read. A run that another one
    overtook raises RuntimeError and changes nothing.

    With `runs`, so many runs that follow each other, or as many as there are
    messages for if it is None, are done by one job: each has its number and its
    folder with up to max_messages, as if it had been called alone, but the messages
    are read and the position is noted once for all of them.
    """
    with _same_splits(spark):
        return _drain(spark, path, root, max_messages, received_at, runs)


def _drain(
    spark: SparkSession, path: str, root: str, max_messages: int, received_at: datetime | None, runs: int | None
) -> int:
    log = CommitLog(spark, f"{root}/consumed")
    number, done, partial, known, later = _position(log)
    begun = f"{number:012d}-begun"
    lost = log.read(begun) if begun in log.names() else None
    runs = lost.get("runs", 1) if lost else runs
    pending = [name for _, name in _files(spark, path) if name not in done]
    pending = pending[: None if runs is None else max_messages * runs]
    if not pending:
        return 0
    ends = {n: known[n] for n in pending if n in known}
    if new := [n for n in pending if n not in ends]:
        lines = _lines(spark, new)
        splits = _splits(lines, new)
        ends.update({name: sum(x.n for x in found) for name, found in splits.items()})
    # how many messages wait before a file's first line, if its lines were all waiting
    waiting, before = 0, {}
    for name in pending:
        before[name] = waiting - partial.get(name, 0)
        waiting += ends[name] - partial.get(name, 0)
    if runs is None:
        runs = max(1, math.ceil(waiting / max_messages))
    count = min(waiting, max_messages * runs)
    now = (received_at or datetime.now(UTC).replace(tzinfo=None)).isoformat()
    log.add(begun, {"received_at": now, "runs": runs})
    when = datetime.fromisoformat(log.read(begun)["received_at"])
    used = [n for n in pending if before[n] + partial.get(n, 0) < count]
    hour = {"date": F.lit(f"{when:%Y-%m-%d}"), "hour": F.lit(f"{when:%H}")}
    if lost:
        folders = (f"streaming/date={when:%Y-%m-%d}/hour={when:%H}", "set_aside")
        _drop(spark, [f"{root}/{f}/run={number + i:012d}" for f in folders for i in range(runs)])
    if used:
        if used != new:
            lines = _lines(spark, used)
            splits = _splits(lines, used)
        placed = _placed(lines, splits, before, {n: partial.get(n, 0) for n in used})
        run = F.lpad((F.lit(number) + F.floor(F.col("place") / max_messages)).cast("string"), 12, "0")
        messages = placed.where(F.col("place") < count).select("value", run.alias("run"))
        _replace(decode(messages, moment(when), ["run"]).withColumns(hour), f"{root}/streaming", "date", "hour", "run")
        _replace(aside(messages, ["run"]), f"{root}/set_aside", "run")
    read = {n: min(ends[n], count - before[n]) for n in used}
    finished = [n for n in pending if read.get(n, partial.get(n, 0)) >= ends[n]]
    left = {n: c for n, c in {**partial, **read}.items() if n not in finished}
    lengths = {n: c for n, c in ends.items() if n not in finished}
    if not log.add(f"{number:012d}", {"done": finished, "partial": left, "lines": lengths, "runs": runs}):
        raise RuntimeError(f"another consumer took run {number} of {root}")
    if len(later) >= FOLDED:
        record = {"done": sorted(done | set(finished)), "partial": left, "lines": lengths}
        log.add(f"all-{number + runs - 1:012d}", record)
        log.remove([n for n in log.names() if not n.startswith("all-") and int(n[:12]) < number])
    return count


def _drop(spark: SparkSession, folders: list[str]) -> None:
    """Remove what a lost run has left."""
    for folder in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _replace(rows: DataFrame, folder: str, *by: str) -> None:
    """Write the folders of the rows anew, others stay."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).json(folder)


def consumed(spark: SparkSession, root: str) -> DataFrame:
    """The runs so far: number, and when their messages were received."""
    log = CommitLog(spark, f"{root}/consumed")
    begun = [(int(n[:12]), log.read(n)) for n in log.names() if n.endswith("-begun")]
    rows = [(n + i, r["received_at"]) for n, r in begun for i in range(r.get("runs", 1))]
    schema = T.StructType.fromDDL("run long, received_at string")
    return spark.createDataFrame(rows, schema)

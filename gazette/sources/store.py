"""Tables that change in batches, under one log of commits.

A batch writes its rows to a new folder and becomes visible, with all its
tables at once, by one record in the log. The log gives out the numbers and names
the writer and the writer's own batch number, so a repeated batch is found and
left out. Folders are never used twice. A compaction folds what is committed into
the base: it writes the buckets anew that were touched and keeps the others where
they are. Those who read the folders before are not disturbed.

The base is bucketed by key and, for tables with a time, cut by its day, so that
a read of some keys or of the last days finds its folders by name. Each commit
notes the days it holds, so later ones are skipped the same way. Columns can be
added; rows of earlier folders get the default when they are read.

Of two writers that start from one state only one commits; the other one gets a
Conflict and nothing of its batch is visible.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.sources.commits import CommitLog

BUCKETS = 32
#: A table whose base lies in more folders than this is written anew as a whole.
PARTS = 8
BUCKET_BYTES = 1 << 30
#: Tables that are written at the same time.
WRITERS = 4
_SEQUENCE, _DELETED, _BUCKET, _DAY = "_sequence", "_deleted", "_bucket", "_day"
NO_DAY = "none"
_NOTES = "writer string, batch long, note string"


class Conflict(RuntimeError):
    """Another writer committed in between; nothing of this batch is visible."""


@dataclass(frozen=True)
class Table:
    """A schema with the key of its rows.

    `latest` tables hold the last row of a key. `day` gives the time whose day
    partitions the base. Rows of a table with `sums` that agree in all other
    columns stand for one row with these added up; compaction adds them.
    """

    schema: T.StructType
    key: str = "article_id"
    latest: bool = True
    day: Callable[[], Column] | None = None
    sums: tuple[str, ...] = ()


@dataclass(frozen=True)
class State:
    """What is visible at one moment: the base and the commits since."""

    base: dict
    commits: list[dict] = field(default_factory=list)

    @property
    def last(self) -> int:
        return self.commits[-1]["sequence"] if self.commits else self.base["sequence"]

    @property
    def columns(self) -> list[dict]:
        """Added columns, with the number of the commit that added them."""
        added = [{**c["column"], "sequence": c["sequence"]} for c in self.commits if c["column"]]
        return [*self.base["columns"], *added]


class Store:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self.log = CommitLog(spark, f"{self.root}/commits")

    # The log

    def state(self) -> State:
        """The base and the commits since, for reading several tables as of one moment."""
        names = self.log.names()
        base = self.log.read(max(n for n in names if n.startswith("base-")))
        later = [n for n in names if not n.startswith("base-") and int(n) > base["sequence"]]
        return State(base, [self.log.read(n) for n in later])

    def last(self) -> int:
        """Number of the last commit."""
        return self.state().last

    def note(self, writer: str, batch: int, state: State | None = None) -> str | None:
        """What a writer's batch left in the log, None if it is not committed."""
        state = state or self.state()
        for commit in state.commits:
            if (commit["writer"], commit["batch"]) == (writer, batch):
                return commit["note"]
        if not state.base["notes"]:
            return None
        folded = self.spark.read.schema(_NOTES).parquet(*state.base["notes"])
        row = folded.where((F.col("writer") == writer) & (F.col("batch") == batch)).first()
        return row and row["note"]

    def _commit(self, sequence: int, **given) -> None:
        record = {
            "sequence": sequence, "folder": None, "tables": [], "days": {}, "column": None,
            "writer": "", "batch": None, "note": "applied", **given,
        }
        if not self.log.add(f"{sequence:012d}", record):
            raise Conflict(f"commit {sequence} of {self.root} was taken by another writer")

    # Writing

    def create(
        self,
        as_of: datetime,
        rows: dict[str, DataFrame] | None = None,
        buckets: int = BUCKETS,
        derive: Callable[[Callable[[str], DataFrame]], dict[str, DataFrame]] | None = None,
    ) -> None:
        """Start the store, with rows for some tables.

        What follows from these rows is given by derive(stored), where stored(name) reads
        a table of `rows` as it was written, so its rows are made once.
        """
        if self.log.names():
            raise Conflict(f"{self.root} is a store already")
        found = dict(rows or {})
        folder = self._folder("base", 0)

        def write(name: str) -> None:
            df = found[name].select(*self.tables[name].schema.names)
            self._write_buckets(folder, name, df, buckets)

        def stored(name: str) -> DataFrame:
            schema = self.tables[name].schema
            return self.spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names)

        _together(write, list(found))
        if derive:
            found.update(derive(stored))
        left = [name for name in self.tables if name not in (rows or {})]
        for name in left:
            found.setdefault(name, self.spark.createDataFrame([], self.tables[name].schema))
        _together(write, left)
        parts = {name: [[folder, 0, None]] for name in found}
        if not self._base(0, as_of, buckets=buckets, parts=parts, columns=[], notes=[]):
            raise Conflict(f"{self.root} is a store already")

    def _folder(self, kind: str, sequence: int) -> str:
        return f"{self.root}/data/{kind}-{sequence:012d}-{uuid.uuid4().hex}"

    def _base(self, sequence: int, as_of: datetime, **given) -> bool:
        record = {"sequence": sequence, "committed_at": as_of.isoformat(), **given}
        return self.log.add(f"base-{sequence:012d}", record)

    def commit(
        self,
        as_of: datetime,
        rows: dict[str, DataFrame] | None = None,
        deletes: dict[str, DataFrame] | None = None,
        writer: str = "",
        batch: int | None = None,
        note: str = "applied",
        state: State | None = None,
    ) -> str:
        """Add rows and delete keys (frames with the key column) in one step.

        Returns the note in the log: that of the first time if the writer has
        committed this batch before. A key must not be in both rows and deletes.
        With `state`, the commit goes right on top of it or fails with a Conflict:
        what was decided from that state still holds.
        """
        rows, deletes, state = rows or {}, deletes or {}, state or self.state()
        if batch is not None and (known := self.note(writer, batch, state)) is not None:
            return known
        number = state.last + 1
        folder = self._folder("commit", number)
        names = sorted({*rows, *deletes})
        days = {}

        def write(name: str) -> None:
            table = self.tables[name]
            parts = []
            if name in rows:
                df = self._complete(name, rows[name], state)
                day = _day(table) if table.day else F.lit(None).cast("string")
                parts.append(df.withColumns({_DELETED: F.lit(False), _DAY: day}))
            if name in deletes:
                gone = deletes[name].select(table.key).distinct()
                parts.append(gone.withColumn(_DELETED, F.lit(True)))
            change = parts[0]
            for part in parts[1:]:
                change = change.unionByName(part, allowMissingColumns=True)
            numbered = change.withColumn(_SEQUENCE, F.lit(number).cast("long"))
            if table.day and name in rows:
                seen = Observation()
                numbered = numbered.observe(seen, F.min(_DAY).alias("first"), F.max(_DAY).alias("last"))
            numbered.write.parquet(f"{folder}/{name}")
            if table.day:
                found = seen.get if name in rows else {}
                days[name] = [found.get("first"), found.get("last")]

        _together(write, names)
        self._commit(
            number, folder=folder, tables=names, days=days, writer=writer, batch=batch, note=note,
            committed_at=as_of.isoformat(),
        )
        return note

    def add_column(self, as_of: datetime, table: str, name: str, kind: str, default=None) -> None:
        """Add a column of a type to a table; rows so far have the default. Repeatable."""
        state = self.state()
        known = {f.name: f.dataType.simpleString() for f in self.schema(table, state).fields}
        if name in known:
            if known[name] != kind:
                raise ValueError(f"{table}.{name} is a {known[name]} already")
            return
        column = {"table": table, "name": name, "kind": kind, "default": default}
        self._commit(state.last + 1, column=column, committed_at=as_of.isoformat())

    def compact(self, as_of: datetime) -> None:
        """Fold all commits so far into the base; nothing to do without any.

        Buckets that no commit touched stay where they are. Log records that the
        base before last has folded are removed.
        """
        state = self.state()
        base, number = state.base, state.last
        if not state.commits:
            return
        folder, buckets = self._folder("base", number), base["buckets"]
        parts = dict(base["parts"])

        def fold(name: str) -> None:
            table, changes = self.tables[name], self.changes(name, state)
            if changes is None:
                return
            own = bucket(F.col(table.key), buckets)
            touched = sorted(r[0] for r in changes.select(own.alias("b")).distinct().collect())
            if not touched:
                return
            left = [
                [f, s, [b for b in (held if held is not None else range(buckets)) if b not in touched]]
                for f, s, held in parts[name]
            ]
            left = [part for part in left if part[2]]
            if len(left) >= PARTS:
                left, touched = [], list(range(buckets))
            df = self.current(name, state=state, buckets=touched)
            if table.sums:
                others = [c for c in df.columns if c not in table.sums]
                df = df.groupBy(*others).agg(*(F.sum(c).cast(df.schema[c].dataType).alias(c) for c in table.sums))
                df = df.where(" or ".join(f"{c} <> 0" for c in table.sums))
            self._write_buckets(folder, name, df, buckets)
            parts[name] = [*left, [folder, number, touched]]

        _together(fold, self.tables)
        notes = [
            (c["writer"], c["batch"], c["note"]) for c in state.commits if c["batch"] is not None
        ]
        if notes:
            self.spark.createDataFrame(notes, _NOTES).coalesce(1).write.parquet(f"{folder}/_notes")
        kept = [*base["notes"], *([f"{folder}/_notes"] if notes else [])]
        self._base(number, as_of, buckets=buckets, parts=parts, columns=state.columns, notes=kept)
        old = [n for n in self.log.names() if int(n.removeprefix("base-")) < base["sequence"]]
        self.log.remove(old)

    def _write_buckets(self, folder: str, name: str, df: DataFrame, buckets: int) -> None:
        """Rows by day and bucket; Spark cuts large buckets and joins small ones in a task."""
        table = self.tables[name]
        by = [_DAY, _BUCKET] if table.day else [_BUCKET]
        placed = df.withColumn(_BUCKET, bucket(F.col(table.key), buckets))
        if table.day:
            placed = placed.withColumn(_DAY, _day(table))
        placed.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{folder}/{name}")

    # Reading

    def schema(self, name: str, state: State | None = None) -> T.StructType:
        """The table's columns, added ones last."""
        fields = list(self.tables[name].schema.fields)
        for column in (state or self.state()).columns:
            if column["table"] == name:
                kind = T.StructType.fromDDL(f"x {column['kind']}").fields[0].dataType
                fields.append(T.StructField(column["name"], kind))
        return T.StructType(fields)

    def _complete(self, name: str, rows: DataFrame, state: State) -> DataFrame:
        """Rows for a table with its added columns, at their default if they lack them."""
        out = rows
        for column in state.columns:
            if column["table"] == name and column["name"] not in rows.columns:
                out = out.withColumn(column["name"], _default(column))
        return out.select(*self.schema(name, state).names)

    def _dated(self, name: str, df: DataFrame, state: State) -> DataFrame:
        """Rows from folders that are older than an added column get its default."""
        older = {
            c["name"]: F.when(F.col(_SEQUENCE) < c["sequence"], _default(c)).otherwise(F.col(c["name"]))
            for c in state.columns if c["table"] == name
        }
        return df.withColumns(older) if older else df

    def changes(self, name: str, state: State, since: date | None = None) -> DataFrame | None:
        """Rows and deletions of commits, with their numbers; with since, of its days only."""
        wanted = [c for c in state.commits if name in c["tables"]]
        if since is not None:
            wanted = [c for c in wanted if (c["days"][name][1] or "") >= since.isoformat()]
        if not wanted:
            return None
        extra = [T.StructField(_DELETED, T.BooleanType()), T.StructField(_SEQUENCE, T.LongType())]
        if self.tables[name].day:
            extra.append(T.StructField(_DAY, T.StringType()))
        schema = T.StructType([*self.schema(name, state).fields, *extra])
        paths = [f"{c['folder']}/{name}" for c in wanted]
        return self._dated(name, self.spark.read.schema(schema).parquet(*paths), state)

    def base(self, name: str, state: State, buckets: list[int] | None, since: date | None) -> DataFrame:
        """The table as of the last compaction; some buckets, the days from since on."""
        table = self.tables[name]
        extra = [T.StructField(_BUCKET, T.IntegerType())]
        if table.day:
            extra.insert(0, T.StructField(_DAY, T.StringType()))
        fields = self.schema(name, state).fields
        rows = None
        for folder, sequence, held in state.base["parts"][name]:
            part = self.spark.read.schema(T.StructType([*fields, *extra])).parquet(f"{folder}/{name}")
            if held is not None:
                part = part.where(F.col(_BUCKET).isin(held))
            if buckets is not None:
                part = part.where(F.col(_BUCKET).isin(buckets))
            if since is not None:
                part = part.where(F.col(_DAY).between(since.isoformat(), "9999"))
            part = self._dated(name, part.withColumn(_SEQUENCE, F.lit(sequence).cast("long")), state)
            part = part.select(*[f.name for f in fields])
            rows = part if rows is None else rows.unionByName(part)
        return rows

    def current(
        self,
        name: str,
        near: DataFrame | None = None,
        state: State | None = None,
        since: date | None = None,
        buckets: list[int] | None = None,
    ) -> DataFrame:
        """A table as of the last commit, or of a state read before.

        With `near` (a frame with the key column), only the buckets of its keys are
        read: every row with one of these keys, and some others. With `since`, the
        rows whose time lies on this day or later, from the folders of these days;
        of other commits only the keys are read.
        """
        table, state = self.tables[name], state or self.state()
        key, number = table.key, bucket(F.col(table.key), state.base["buckets"])
        if near is not None:
            buckets = [r[0] for r in near.select(number.alias("b")).distinct().collect()]
        base = self.base(name, state, buckets, since)
        newer = self.changes(name, state)
        if newer is None:
            return base
        if buckets is not None:
            newer = newer.where(number.isin(buckets))
        names = base.columns
        if table.latest:
            newest = newer.groupBy(key).agg(F.max(_SEQUENCE).alias(_SEQUENCE))
            kept = base.join(newest, key, "left_anti").select(*names)
            fresh = self.changes(name, state, since)
            if fresh is None:
                return kept
            if buckets is not None:
                fresh = fresh.where(number.isin(buckets))
            if since is not None:
                fresh = fresh.where(F.col(_DAY).between(since.isoformat(), "9999"))
            last = fresh.where(~F.col(_DELETED)).join(newest, [key, _SEQUENCE], "left_semi")
            return kept.unionByName(last.select(*names))
        rows = base.withColumn(_SEQUENCE, F.lit(state.base["sequence"]).cast("long")).unionByName(
            newer.where(~F.col(_DELETED)).select(*names, _SEQUENCE)
        )
        gone = newer.where(_DELETED).groupBy(F.col(key).alias("_gone")).agg(
            F.max(_SEQUENCE).alias("_until")
        )
        left = rows.join(
            gone, (F.col(key) == F.col("_gone")) & (F.col(_SEQUENCE) < F.col("_until")), "left_anti"
        )
        return left.select(*names)


def _together(act: Callable[[str], None], names) -> None:
    """act for each name, some at the same time; the first failure is raised."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(act, name) for name in names]:
            done.result()


def _day(table: Table) -> Column:
    return F.coalesce(F.date_format(table.day(), "yyyy-MM-dd"), F.lit(NO_DAY))


def _default(column: dict) -> Column:
    return F.lit(column["default"]).cast(column["kind"])


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_for(table_bytes: int) -> int:
    """Buckets for a table that will grow to so many bytes."""
    return max(BUCKETS, math.ceil(table_bytes / BUCKET_BYTES))

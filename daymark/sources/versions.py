"""Tables that are replaced as a whole or in buckets, and never seen half written.

A table is a folder::

    data/version=<id>/...                 rows of one write, in Parquet
    data/version=<id>/bucket=<n>/...      the same for a table in buckets
    commits/                              one small JSON file for each finished write

A write puts its rows into a new folder and appends its commit last. Readers
go by the commits, so a job that fails midway leaves the old rows in place, and
folders without a commit are never read. A commit names the versions of the
tables that its rows were made from; :func:`staleness` tells which tables are
older than what they were made from.

A commit of buckets replaces just these; the other buckets stay in the folders
of earlier versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "number long, version string, rows_schema string, replaced array<int>, present array<int>, inputs map<string,string>"
BUCKET = "bucket"


class Conflict(RuntimeError):
    """Another write of the table was finished first."""


@dataclass(frozen=True)
class Commit:
    """One finished write; ``replaced`` is None for a whole table."""

    number: int
    version: str
    rows_schema: str
    replaced: list[int] | None = None
    present: list[int] | None = None
    inputs: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class State:
    """What the commits of a table add up to."""

    number: int = 0
    version: str | None = None
    rows_schema: str | None = None
    buckets: dict[int, str] | None = None
    inputs: dict[str, str] = field(default_factory=dict)


def _folder(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/data/version={version}"


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """The finished writes of a table, oldest first; of two with one number the first by id counts."""
    log = spark.read.schema(COMMIT).json(f"{path.rstrip('/')}/commits")
    first = {}
    for row in sorted(log.collect(), key=lambda r: (r.number, r.version)):
        first.setdefault(row.number, Commit(**(row.asDict() | {"inputs": dict(row.inputs or {})})))
    return list(first.values())


def state(spark: SparkSession, path: str) -> State:
    """The current state; a table without a finished write has no version."""
    try:
        done = commits(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done = []
    now = State()
    for commit in done:
        buckets = None
        if commit.replaced is not None:
            kept = {b: v for b, v in (now.buckets or {}).items() if b not in set(commit.replaced)}
            buckets = kept | {b: commit.version for b in commit.present or []}
        now = State(commit.number, commit.version, commit.rows_schema, buckets, commit.inputs)
    return now


def _rows_schema(now: State) -> T.StructType:
    return T.StructType.fromJson(json.loads(now.rows_schema))


def read(spark: SparkSession, path: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """The rows of the last finished write; with ``buckets``, of these buckets only."""
    now = state(spark, path)
    if now.version is None:
        raise ValueError(f"{path} has no finished write")
    schema = _rows_schema(now)
    if now.buckets is None:
        if buckets is not None:
            raise ValueError(f"{path} has no buckets")
        return spark.read.schema(schema).parquet(_folder(path, now.version))
    wanted = now.buckets if buckets is None else {b: now.buckets[b] for b in buckets if b in now.buckets}
    folders = [f"{_folder(path, v)}/{BUCKET}={b}" for b, v in sorted(wanted.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _commit(
    df: DataFrame, path: str, before: State, version: str, replaced=None, present=None, inputs=None
) -> str:
    spark = df.sparkSession
    row = (before.number + 1, version, df.schema.json(), replaced, present, dict(inputs or {}))
    record = spark.createDataFrame([row], COMMIT).coalesce(1)
    record.write.mode("append").json(f"{path.rstrip('/')}/commits")
    if version not in {c.version for c in commits(spark, path)}:
        raise Conflict(f"{path} was written by another job")
    return version


def replace(df: DataFrame, path: str, inputs: Mapping[str, str] | None = None) -> str:
    """Replace the whole table by ``df``, which may be read from the table itself.

    ``inputs`` are the versions of the tables that ``df`` was made from, by
    path. Returns the new version.
    """
    before, version = state(df.sparkSession, path), uuid.uuid4().hex
    df.write.parquet(_folder(path, version))
    return _commit(df, path, before, version, inputs=inputs)


def create_if_absent(df: DataFrame, path: str, inputs: Mapping[str, str] | None = None) -> str:
    """As :func:`replace`, for a table without a finished write; any other stays as it is."""
    now = state(df.sparkSession, path)
    return now.version or replace(df, path, inputs)


def replace_buckets(
    df: DataFrame,
    path: str,
    bucket: Column,
    changed: Iterable[int] | None = None,
    inputs: Mapping[str, str] | None = None,
) -> str:
    """Replace the buckets ``changed`` (all of them by default) by the rows of ``df``.

    ``bucket`` gives a row's bucket, a small whole number. Rows outside of
    ``changed`` are an error. A bucket that has no more rows is emptied.
    """
    spark = df.sparkSession
    before, version = state(spark, path), uuid.uuid4().hex
    if changed is not None:
        if before.version is not None and before.buckets is None:
            raise ValueError(f"{path} has no buckets")
        if before.rows_schema and _rows_schema(before).simpleString() != df.schema.simpleString():
            raise ValueError(f"the columns of {path} differ")
        changed = sorted(set(changed))
    place = bucket
    if changed is not None:
        outside = F.raise_error(F.lit("a row outside of the buckets to replace")).cast("int")
        place = F.when(bucket.isin(*changed), bucket).otherwise(outside) if changed else outside
    folder = _folder(path, version)
    # Rows of a bucket come together, but adaptive execution deals a large bucket to several tasks.
    dealt = df.withColumn(BUCKET, place.cast("int")).hint("rebalance", BUCKET)
    dealt.write.partitionBy(BUCKET).parquet(folder)
    present = _buckets_in(spark, folder)
    replaced = changed if changed is not None else sorted({*present, *(before.buckets or {})})
    return _commit(df, path, before, version, replaced, present, inputs)


def _buckets_in(spark: SparkSession, folder: str) -> list[int]:
    """The buckets that a write made, from the names of its folders."""
    written = spark.read.schema(f"{BUCKET} int").option("basePath", folder).parquet(folder)
    return sorted(r[0] for r in written.select(BUCKET).distinct().collect())


def versions_of(spark: SparkSession, paths: Iterable[str]) -> dict[str, str]:
    """The current version of each table, to be handed on as ``inputs``."""
    found = {path: state(spark, path).version for path in paths}
    return {path: version for path, version in found.items() if version is not None}


def staleness(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """One row for each table: its name, version, and whether it is older than what it was made from.

    ``because`` names the inputs that have a newer version or are themselves
    stale. A table without a finished write is stale, with a NULL version.
    """
    states = {path: state(spark, path) for path in tables.values()}
    names = {path: name for name, path in tables.items()}

    def newer(path: str) -> str | None:
        if path not in states:
            states[path] = state(spark, path)
        return states[path].version

    def reasons(path: str) -> list[str]:
        made_from = states[path].inputs
        return sorted(
            names.get(p, p) for p, v in made_from.items() if newer(p) != v or reasons(p)
        )

    rows = []
    for name, path in tables.items():
        because = reasons(path) if states[path].version else []
        rows.append((name, states[path].version, bool(because) or states[path].version is None, because))
    return spark.createDataFrame(rows, "table_name string, version string, stale boolean, because array<string>")


def unread_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of finished writes that no reader of the current state needs; their removal is the caller's."""
    now = state(spark, path)
    needed = {now.version} if now.buckets is None else set(now.buckets.values())
    return [_folder(path, c.version) for c in commits(spark, path) if c.version not in needed]

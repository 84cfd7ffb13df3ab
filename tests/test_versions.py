import os

import pytest
from pyspark.sql import functions as F

from daymark.sources import versions
from tests.build import rows_of


def table(spark, *values, extra=None):
    df = spark.createDataFrame([(v, v % 4) for v in values], "v long, b int")
    return df if extra is None else df.withColumn("w", F.lit(extra))


def values(spark, path, buckets=None):
    return sorted(r.v for r in versions.read(spark, path, buckets).collect())


def test_replace_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.state(spark, path).version is None
    with pytest.raises(ValueError, match="no finished write"):
        versions.read(spark, path)
    first = versions.replace(table(spark, 1, 2), path, {"input": "v0"})
    second = versions.replace(versions.read(spark, path).withColumn("w", F.lit("x")), path)
    assert first != second and versions.read(spark, path).columns == ["v", "b", "w"]
    assert versions.create_if_absent(table(spark, 7), path) == second
    assert values(spark, path) == [1, 2]
    assert [c.inputs for c in versions.commits(spark, path)] == [{"input": "v0"}, {}]
    assert [os.path.basename(f) for f in versions.unread_folders(spark, path)] == [f"version={first}"]
    versions.replace(table(spark), path)
    assert values(spark, path) == []


def test_a_failed_job_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(table(spark, *range(100)), path)
    before = versions.state(spark, path)
    dying = table(spark, *range(50)).withColumn(
        "v", F.when(F.col("v") == 33, F.raise_error(F.lit("dies")).cast("long")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="dies"):
        versions.replace(dying, path)
    assert versions.state(spark, path) == before and values(spark, path) == list(range(100))


def test_a_write_without_a_commit_is_not_read(spark, tmp_path, monkeypatch):
    """The job is killed after its rows, before its commit."""
    path = str(tmp_path / "t")
    versions.replace_buckets(table(spark, 1, 2, 3), path, F.col("b"))

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "_commit", killed)
    for write in (versions.replace, lambda df, p: versions.replace_buckets(df, p, F.col("b"), [1])):
        with pytest.raises(KeyboardInterrupt):
            write(table(spark, 5), path)
    assert values(spark, path) == [1, 2, 3]


def test_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace_buckets(table(spark, *range(10)), path, F.col("b"))
    before = versions.state(spark, path).buckets
    versions.replace_buckets(table(spark, 101), path, F.col("b"), [1, 2])
    after = versions.state(spark, path).buckets
    assert values(spark, path) == [0, 3, 4, 7, 8, 101]
    assert set(after) == {0, 1, 3} and after[0] == before[0] and after[3] == before[3] and after[1] != before[1]
    assert values(spark, path, [1, 2]) == [101] and values(spark, path, [2]) == []
    assert rows_of(versions.read(spark, path)) == rows_of(table(spark, 0, 3, 4, 7, 8, 101))
    with pytest.raises(Exception, match="outside"):
        versions.replace_buckets(table(spark, 1, 3), path, F.col("b"), [1])
    with pytest.raises(ValueError, match="differ"):
        versions.replace_buckets(table(spark, 1, extra=0), path, F.col("b"), [1])
    versions.replace_buckets(table(spark, 5), path, F.col("b"))
    assert values(spark, path) == [5] and set(versions.state(spark, path).buckets) == {1}
    versions.replace_buckets(table(spark), path, F.col("b"))
    assert values(spark, path) == []
    versions.replace(table(spark, 9), path)
    with pytest.raises(ValueError, match="no buckets"):
        versions.replace_buckets(table(spark, 9), path, F.col("b"), [1])


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.replace(table(spark, 1), path)
    stand = versions.state(spark, path)
    monkeypatch.setattr(versions, "state", lambda *_: stand)  # both begin from the same state
    outcomes = []
    for v in (2, 3, 4):
        try:
            outcomes.append((versions.replace(table(spark, v), path), v))
        except versions.Conflict:
            outcomes.append(None)
    monkeypatch.undo()
    log = versions.commits(spark, path)
    assert len(log) == 2 and outcomes[0] is not None
    winners = {x[0]: x[1] for x in outcomes if x}
    assert values(spark, path) == [winners[log[-1].version]]


def test_staleness(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in "abc")
    versions.replace(table(spark, 1), a)
    versions.replace(table(spark, 1), b, versions.versions_of(spark, [a]))
    versions.replace(table(spark, 1), c, versions.versions_of(spark, [b]))

    def report():
        rows = versions.staleness(spark, {"a": a, "b": b, "c": c, "none": str(tmp_path / "none")}).collect()
        return {r.table_name: (r.stale, r.because) for r in rows}

    fresh = {"a": (False, []), "b": (False, []), "c": (False, []), "none": (True, [])}
    assert report() == fresh
    versions.replace(table(spark, 2), a)
    assert report() == fresh | {"b": (True, ["a"]), "c": (True, ["b"])}
    versions.replace(table(spark, 2), b, versions.versions_of(spark, [a]))
    assert report() == fresh | {"c": (True, ["b"])}

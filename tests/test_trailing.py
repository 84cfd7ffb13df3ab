import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daymark.operators.features import Measure
from daymark.operators.trailing import trailing_values

MEASURES = [
    Measure("n", "count"),
    Measure("mean", "avg"),
    Measure("total", "sum", items=("a",)),
    Measure("low", "min", excluding=("b",)),
    Measure("high", "max", items=("b", "c")),
    Measure("n_b", "count", items=("b",)),
]
START = datetime(1969, 12, 30)


def values_before(rows, stay, at, hours):
    return [
        (item, v) for s, t, item, v in rows
        if None not in (*s, t, at, *stay) and s == stay and at - timedelta(hours=hours) <= t < at
    ]


def brute(rows, stay, at, hours):
    found = values_before(rows, stay, at, hours)

    def of(items):
        return [v for item, v in found if item in items and v is not None]

    every = of("abc")
    return (
        len(every),
        sum(every) / len(every) if every else None,
        sum(of("a")) if of("a") else None,
        min(of("ac"), default=None),
        max(of("bc"), default=None),
        len(of("b")),
    )


def draw(seed, n_rows, n_anchors):
    """Times on and around full hours, ties, a hot stay, a hot hour, NULLs and moments before 1970."""
    rng = random.Random(seed)
    stays = [(1, 10), (1, 11), (2, 20)]

    def moment():
        if rng.random() < 0.1:
            return None
        t = START + timedelta(hours=rng.choice([30, rng.randrange(100)]))
        return t + rng.choice([timedelta(0), timedelta(microseconds=rng.choice([-1, 1])), timedelta(seconds=rng.randrange(3600)), timedelta(microseconds=rng.randrange(3_600_000_000))])

    def stay():
        return rng.choice([stays[0], rng.choice(stays), rng.choice(stays), (None, 10), (1, None)])

    rows = [(stay(), moment(), rng.choice("abc"), rng.choice([None, rng.randrange(-50, 50)])) for _ in range(n_rows)]
    anchors = [(stay(), rng.choice([moment(), (rows[rng.randrange(n_rows)][1])])) for _ in range(n_anchors)]
    anchors += [anchors[0], anchors[0]]
    return rows, anchors


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("hours", [1, 3, 24])
def test_against_range_join(spark, hours, kind):
    rows, anchors = draw(hours, 600, 150)
    keys = f"subject_id long, stay_id long, {{}} {kind}"
    long = spark.createDataFrame([(*s, t, i, v) for s, t, i, v in rows], keys.format("charttime") + ", item string, value long")
    marks = spark.createDataFrame([(*s, t, k, "x") for k, (s, t) in enumerate(anchors)], keys.format("at") + ", k long, item string")
    got = trailing_values(long, marks, MEASURES, hours=hours)
    assert got.columns == ["subject_id", "stay_id", "at", "k", "item", *[m.name for m in MEASURES]]
    found = {r.k: tuple(r)[5:] for r in got.collect()}
    assert found == {k: brute(rows, s, t, hours) for k, (s, t) in enumerate(anchors)}
    assert any(v[0] > 5 for v in found.values()) and any(v[0] == 0 for v in found.values())


def test_empty_tables_and_taken_names(spark):
    long = spark.createDataFrame([], "subject_id long, stay_id long, charttime timestamp, item string, value long")
    marks = spark.createDataFrame([(1, 1, START)], "subject_id long, stay_id long, at timestamp")
    assert tuple(trailing_values(long, marks, MEASURES).first())[3:] == (0, None, None, None, None, 0)
    assert trailing_values(long, marks.limit(0), MEASURES).count() == 0
    with pytest.raises(ValueError, match="mean"):
        trailing_values(long, marks.withColumn("mean", F.lit(1)), MEASURES)


def test_measurements_are_combined_before_the_shuffle(spark):
    """A hot hour of a stay reaches the exchange as one row per task."""
    long = spark.range(20_000).selectExpr(
        "1L AS subject_id", "1L AS stay_id", "timestamp'2024-01-01 05:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 3000 / 1000) AS charttime", "'a' AS item", "id AS value"
    )
    marks = spark.createDataFrame([(1, 1, datetime(2024, 1, 1, h)) for h in (5, 6, 30 - 24, 23)], "subject_id long, stay_id long, at timestamp")
    got = trailing_values(long, marks, MEASURES)
    assert sorted(r.n for r in got.collect()) == [0, 20_000, 20_000, 20_000]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan

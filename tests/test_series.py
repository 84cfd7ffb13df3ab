import hashlib
import json
import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from daymark.operators import series
from daymark.operators.series import over_stays
from tests.build import START


def ahead_and_back(rows, neighbour):
    return neighbour(
        rows, {"next": ("rid", 1), "next2": ("rid", 2), "prev": ("rid", -1), "prev2": ("rid", -2)}
    )


def stays(seed):
    """Stays with repeated days, NULL ids and NULL days; ``rid`` tells rows apart."""
    rng = random.Random(seed)
    rows = []
    for stay in [(1, 1), (1, 2), (2, 1), (None, 1), (None, None)]:
        for _ in range(rng.choice([1, 4, 12, 30])):
            rows.append((*stay, rng.choice([None, 0, 1, 1, 1, 2, 5, 9]), len(rows)))
    return rows


def frame(spark, rows):
    data = [(s, t, None if d is None else START + timedelta(days=d), r) for s, t, d, r in rows]
    schema = "subject_id bigint, stay_id bigint, chart_date date, rid int"
    return spark.createDataFrame(data, schema)


def walk(mine):
    """The rows of one stay in the order that ``next`` gives them."""
    onward = {r.rid: r.next for r in mine}
    first = set(onward) - set(onward.values())
    assert len(first) == 1 and len(onward) == len(mine)
    order, here = [], first.pop()
    while here is not None:
        order.append(here)
        here = onward[here]
    return order


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("digits", [0, 1, 2])
def test_neighbours_form_one_walk_through_each_stay(spark, seed, digits, monkeypatch):
    monkeypatch.setattr(series, "SLICE_DIGITS", digits)
    rows = stays(seed)
    got = over_stays(frame(spark, rows), ahead_and_back).collect()
    assert sorted((r.rid for r in got)) == list(range(len(rows)))
    day_of = {rid: -1 if d is None else d for _, _, d, rid in rows}
    for stay in {row[:2] for row in rows}:
        mine = [r for r in got if (r.subject_id, r.stay_id) == stay]
        order = walk(mine)
        assert sorted(order) == [rid for s, t, _, rid in rows if (s, t) == stay]
        assert [day_of[rid] for rid in order] == sorted(day_of[rid] for rid in order)
        places = [None, None, *order, None, None]
        expected = {
            here: places[i + 3 : i + 5] + places[i + 1 : i - 1 if i else None : -1]
            for i, here in enumerate(order)
        }
        assert {r.rid: [r.next, r.next2, r.prev, r.prev2] for r in mine} == expected


def two_steps(rows, neighbour):
    """A second look over the rows that the first one keeps."""
    rows = neighbour(rows, {"next": ("rid", 1), "prev2": ("rid", -2)})
    return neighbour(rows.filter("next IS NOT NULL"), {"later": ("next", 2), "before": ("rid", -1)})


def in_plain_python(rows):
    """``two_steps`` over all rows, copies side by side, in the order of the documented tie-break."""

    def order(row):
        _, _, d, rid = row
        day = None if d is None else (START + timedelta(days=d)).isoformat()
        fields = {"subject_id": row[0], "stay_id": row[1], "chart_date": day, "rid": rid}
        text = json.dumps({k: v for k, v in fields.items() if v is not None}, separators=(",", ":"))
        return (d is not None, d or 0, hashlib.md5(text.encode()).hexdigest())

    out = []
    for stay in {row[:2] for row in rows}:
        rids = [r[3] for r in sorted((r for r in rows if r[:2] == stay), key=order)]
        seen = [(rids[i], rids[i + 1], rids[i - 2] if i > 1 else None) for i in range(len(rids) - 1)]
        for i, (rid, following, prev2) in enumerate(seen):
            later = seen[i + 2][1] if i + 2 < len(seen) else None
            out.append((*stay, rid, following, prev2, later, seen[i - 1][0] if i else None))
    return Counter(out)


@pytest.mark.parametrize("partitions", [1, 7])
def test_copies_and_ties_do_not_depend_on_partitions(spark, partitions):
    rng = random.Random(4)
    rows = [(1, 1, rng.choice([None, 0, 0, 1]), rng.randrange(4)) for _ in range(60)]
    rows += [(None, 2, 3, rng.randrange(9)) for _ in range(20)] + [(5, 5, 0, 1)] * 2
    rng.shuffle(rows)
    got = over_stays(frame(spark, rows).repartition(partitions), two_steps)
    names = ["subject_id", "stay_id", "rid", "next", "prev2", "later", "before"]
    assert Counter(tuple(r) for r in got.select(*names).collect()) == in_plain_python(rows)


def test_unique_days_agree_with_the_window(spark):
    rows = [(1 + i % 3, 1, i, i) for i in range(60)]
    usual = over_stays(frame(spark, rows), ahead_and_back, unique_days=True)
    other = over_stays(frame(spark, rows), ahead_and_back)
    assert other.columns == usual.columns
    assert sorted(map(tuple, other.collect()), key=str) == sorted(map(tuple, usual.collect()), key=str)


def test_ties_name_the_order(spark):
    rows = frame(spark, [(1, 1, 0, i) for i in range(9)]).withColumn("load", F.rand())
    got = over_stays(rows, lambda r, look: look(r, {"next": ("rid", 1)}), ties=["rid"]).collect()
    order = sorted(range(9), key=lambda i: hashlib.md5(f'{{"rid":{i}}}'.encode()).hexdigest())
    assert walk(got) == order


def test_many_copies_are_spread_and_kept(spark, monkeypatch):
    monkeypatch.setattr(series, "COPIES_AT_ONCE", 1000)
    rows = frame(spark, [(1, 1, 0, 1), (1, 1, 9, 2), (2, 1, 0, 3)])
    many = rows.unionByName(
        spark.range(50_000).selectExpr(
            "1L AS subject_id", "1L AS stay_id", "date'2024-01-02' AS chart_date", "7 AS rid"
        )
    )
    got = over_stays(many, lambda r, neighbour: neighbour(r, {"next": ("rid", 1)}))
    links = Counter((r.rid, r.next) for r in got.collect())
    assert links == {(1, 7): 1, (7, 7): 49_999, (7, 2): 1, (2, None): 1, (3, None): 1}
    largest = got.groupBy(F.spark_partition_id()).count().agg({"count": "max"}).first()[0]
    assert largest < 40_000


def test_a_hot_null_stay_is_spread(spark):
    rows = spark.range(20_000).selectExpr(
        "CAST(NULL AS BIGINT) AS subject_id", "CAST(NULL AS BIGINT) AS stay_id",
        "date'2024-01-02' AS chart_date", "CAST(id AS INT) AS rid",
    )
    counted = series._counted(rows, ())
    largest = counted.groupBy(*series.SLICED_DAY).count().agg({"count": "max"}).first()[0]
    assert largest < 200
    got = over_stays(rows, lambda r, neighbour: neighbour(r, {"next": ("rid", 1)}))
    assert got.filter("next IS NULL").count() == 1 and got.select("next").distinct().count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(subject_id" not in plan


def test_days_must_be_dates(spark):
    rows = spark.sql("SELECT 1L AS subject_id, 1L AS stay_id, timestamp'2024-01-01 10:00:00' AS chart_date, 1 AS rid")
    for over in ({}, {"unique_days": True}):
        with pytest.raises(ValueError, match="date"):
            over_stays(rows, ahead_and_back, **over)

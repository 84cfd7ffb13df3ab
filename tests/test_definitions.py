"""Looks ahead by date, slopes, gaps and times to transition against plain Python."""

import math
import random
from collections import Counter, defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from daymark.functions.criteria import SIC
from daymark.functions.keys import DAY, KEYS, STAY
from daymark.operators import gaps, slopes, survival
from daymark.operators.calendar import follow_up_distances, label_days_by_date, with_status_by_date
from tests.build import START, by_key, days_of, rows_of
from tests.build import SIC as SIC_VALUES

NAN = float("nan")


def stays_of(rows):
    stays = defaultdict(dict)
    for subject, stay, n, values in rows:
        stays[subject, stay][n] = values
    return stays


def random_rows(seed, values, n_stays=25, days=20):
    rng = random.Random(seed)
    return [
        (s, s * 10, n, values(rng)) for s in range(n_stays) for n in sorted(rng.sample(range(days), rng.randrange(1, days)))
    ]


def sic_rows(seed):
    return random_rows(seed, lambda rng: rng.choice([SIC_VALUES[0], SIC_VALUES[1], {}]))


def status(values):
    return {repr(SIC_VALUES[0]): 0, repr(SIC_VALUES[1]): 1}.get(repr(values))


def onset(now, then):
    return None if then is None else int(now == 0 and then == 1)


@pytest.mark.parametrize("over", [{"unique_days": True}, {"ties": KEYS}])
def test_labels_by_date(spark, over):
    rows = sic_rows(1)
    got = label_days_by_date(days_of(spark, rows), SIC, **over)
    found = {
        (r.subject_id, (r.chart_date - START).days): (
            r.sic_today, r.sic_tomorrow, r.sic_next_day, r.sic_tomorrow_by_date, r.sic_next_day_by_date
        )
        for r in got.collect()
    }
    expected = {}
    for (subject, _), days in stays_of(rows).items():
        order = sorted(days)
        for n, following in zip(order, [*order[1:], None], strict=True):
            now = status(days[n])
            by_row = status(days[following]) if following is not None else None
            by_date = status(days[n + 1]) if n + 1 in days else None
            expected[subject, n] = (now, by_row, onset(now, by_row), by_date, onset(now, by_date))
    assert found == expected
    assert any(e[1] != e[3] for e in expected.values())


def test_status_by_date_of_repeated_and_null_keys(spark):
    data = [(1, 1, 0, "a", 1), (1, 1, 0, "b", 1), (1, 1, 1, "c", 2), (1, 1, 1, "a", 3), (1, 1, 3, "d", 9)]
    data += [(None, 1, 0, "e", 4), (None, 1, 1, "f", 5), (1, 1, None, "g", 6), (1, 1, None, "h", 7), (1, 2, 1, "i", 8)]
    rows = spark.createDataFrame(data, "subject_id long, stay_id long, n int, name string, v int")
    days = rows.withColumn(DAY, F.date_add(F.lit(START), F.col("n")))
    got = with_status_by_date(days, {"next_v": "v"}, ties=["name"]).collect()
    first = min(((F_hash(name), v) for s, t, n, name, v in data if (s, t, n) == (1, 1, 1)))[1]
    assert {r.name + str(r.v): r.next_v for r in got} == {
        "a1": first, "b1": first, "c2": None, "a3": None, "d9": None, "e4": 5, "f5": None, "g6": None, "h7": None, "i8": None
    }
    with pytest.raises(ValueError, match="next_v"):
        with_status_by_date(days.withColumn("next_v", F.lit(1)), {"next_v": "v"}, ties=["name"])


def F_hash(name):
    import hashlib

    return hashlib.md5(f'{{"name":"{name}"}}'.encode()).hexdigest()


def test_distances(spark):
    rows = sic_rows(2)
    got = {r.distance: tuple(r)[1:] for r in follow_up_distances(days_of(spark, rows), SIC).collect()}
    expected = defaultdict(lambda: [0] * 6)
    for days in stays_of(rows).values():
        order = sorted(days)
        for n, following in zip(order, [*order[1:], None], strict=True):
            now, by_row = status(days[n]), status(days[following]) if following is not None else None
            by_date = status(days[n + 1]) if n + 1 in days else None
            ends = (onset(now, by_row), onset(now, by_date))
            e = expected[following - n if following is not None else None]
            for i, x in enumerate((1, ends[0] is not None, ends[1] is not None, ends[0] == 1, ends[1] == 1, ends[0] != ends[1])):
                e[i] += x
    assert got == {k: tuple(v) for k, v in expected.items()}


def least_squares(points):
    n = len(points)
    if len({x for x, _ in points}) < 2:
        return None
    mx, my = sum(x for x, _ in points) / n, sum(y for _, y in points) / n
    return sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)


@pytest.mark.parametrize("unique_days", [True, False])
def test_slopes(spark, unique_days):
    rows = random_rows(3, lambda rng: {"inr_avg": rng.choice([None, NAN, rng.randrange(400) / 100])})
    if not unique_days:
        rows += random_rows(4, lambda rng: {"inr_avg": rng.randrange(400) / 100})
        rows.append((1, 10, None, {"inr_avg": 3.0}))
    sloped = slopes.with_slopes(days_of(spark, rows), {"inr_avg": 0.01}, last_days=4, unique_days=unique_days)
    assert sloped.columns[-1] == "inr_avg_slope4" and sloped.count() == len(rows)
    for r in sloped.collect():
        n = None if r.chart_date is None else (r.chart_date - START).days
        points = [
            (m, v["inr_avg"]) for s, t, m, v in rows
            if n is not None and m is not None and (s, t) == (r.subject_id, r.stay_id) and n - 4 < m <= n
            and v["inr_avg"] is not None and not math.isnan(v["inr_avg"])
        ]
        expected = least_squares(points)
        assert r.inr_avg_slope4 == (None if expected is None else pytest.approx(expected, abs=1e-9))


def test_slopes_of_whole_units_are_exact(spark):
    rows = [(1, 1, n, {"platelet_avg": 1e12 + n / 4}) for n in range(5)]
    got = slopes.with_slopes(days_of(spark, rows), {"platelet_avg": 0.25}, last_days=5, unique_days=True)
    assert by_key(got, "platelet_avg_slope5") == {0: (None,)} | {n: (0.25,) for n in range(1, 5)}


LABS = ["platelet_avg", "inr_avg"]


def lab_rows(seed):
    return random_rows(seed, lambda rng: {c: rng.choice([None, None, 1.0]) for c in LABS})


def test_missing_runs_and_days_since(spark):
    rows = lab_rows(5)
    days = days_of(spark, rows)
    expected, since = [], {}
    for (subject, stay), by_day in stays_of(rows).items():
        order = sorted(by_day)
        for c in LABS:
            run, last = [], None
            for k, n in enumerate([*order, None]):
                missing = n is not None and by_day[n][c] is None
                if n is not None:
                    last = last if missing else n
                    since[subject, n, c] = None if last is None else n - last
                if missing:
                    run.append((k, n))
                elif run:
                    ks, ns = zip(*run, strict=True)
                    expected.append((c, subject, stay, ns[0], ns[-1], len(ns), ks[0] == 0, ks[-1] == len(order) - 1))
                    run = []
    runs = gaps.missing_runs(days, LABS)
    found = [
        (r.column_name, r.subject_id, r.stay_id, (r.first_day - START).days, (r.last_day - START).days, r.n_days, r.opens, r.closes)
        for r in runs.collect()
    ]
    assert sorted(found) == sorted(expected)
    lengths = Counter((c, n) for c, _, _, _, _, n, _, _ in expected)
    assert {(r.column_name, r.n_days): r.n_runs for r in gaps.run_lengths(runs).collect()} == lengths
    got = gaps.with_days_since_known(days, LABS)
    assert {
        (r.subject_id, (r.chart_date - START).days, c): r[f"{c}_days_since"] for r in got.collect() for c in LABS
    } == since


def test_joint_missingness(spark):
    columns = [*LABS, "pt_avg"]
    rows = random_rows(6, lambda rng: {c: rng.choice([None, 1.0]) for c in columns})
    got = gaps.joint_missingness(days_of(spark, rows), columns).collect()
    for r in got:
        a, b = r.first_column, r.second_column
        sets = Counter((v[a] is None, v[b] is None) for _, _, _, v in rows)
        assert tuple(r)[2:] == (sets[True, True], sets[True, False], sets[False, True], sets[False, False])
    assert len(got) == 3
    assert all(tuple(r)[2:] == (0, 0, 0, 0) for r in gaps.joint_missingness(days_of(spark, []), columns).collect())


def product_limit(times):
    free, spread, out = 1.0, 0.0, {}
    for t in sorted({t for t, _ in times}):
        n = sum(u >= t for u, _ in times)
        d = sum(u == t and e for u, e in times)
        free *= 1 - d / n
        spread += d / (n * (n - d)) if n > d else 0
        out[t] = (n, d, sum(u == t and not e for u, e in times), free, free * math.sqrt(spread) if free > 0 else None)
    return out


@pytest.mark.parametrize("seed, last", [(7, 0), (8, 1)])
def test_product_limit_curve(spark, seed, last):
    rng = random.Random(seed)
    times = [(rng.randrange(12), int(rng.random() < 0.4)) for _ in range(120)] + [(30, last)]
    df = spark.createDataFrame([(t, e, g) for g in "xy" for t, e in times], "days int, event int, g string")
    expected = product_limit(times)
    for g in "xy":
        got = survival.product_limit(df, ["g"]).filter(F.col("g") == g).collect()
        assert {r.days for r in got} == set(expected)
        for r in got:
            n, d, c, free, error = expected[r.days]
            assert (r.n_at_risk, r.n_events, r.n_censored) == (n, d, c)
            assert r.free == pytest.approx(free, abs=1e-12)
            assert r.std_error == (None if error is None else pytest.approx(error, abs=1e-12))
    if last:
        assert expected[30][3] == 0.0


def test_times_to_event(spark):
    def days(stay, *flags):
        return [(1, stay, n, {"sic": s, "dic": d}) for n, s, d in flags]

    rows = [
        *days(1, (0, 0, 1), (2, 1, 0), (5, 0, 1), (6, 1, 1)),  # events before the start don't count
        *days(2, (0, 1, 0), (1, 0, 0), (4, None, None)),  # censored at the last known day
        *days(3, (0, 0, 0), (1, None, 1)),  # never starts
        *days(4, (3, 1, 1)),  # at once
        *days(5, (0, 0, 0), (2, 1, None)),  # never known
        (1, 6, None, {"sic": 1, "dic": 1}),
    ]
    table = days_of(spark, rows, extra=["sic int", "dic int"]).withColumn("ward", F.lit("w"))
    got = survival.times_to_event(table, "dic", F.col("sic") == 1, keep=["ward"])
    assert got.columns == [*STAY, "ward", "days", "event"]
    assert {r.stay_id: (r.days, r.event) for r in got.collect()} == {1: (3, 1), 2: (1, 0), 4: (0, 1)}
    whole = survival.times_to_event(table, "dic")
    assert {r.stay_id: (r.days, r.event) for r in whole.collect()} == {1: (0, 1), 2: (1, 0), 3: (1, 1), 4: (0, 1), 5: (0, 0)}


def test_a_stay_of_any_size(spark):
    """Rows of one stay are combined before the shuffle, however many they are."""
    many = spark.range(30_000).select(
        F.lit(1).cast("long").alias("subject_id"), F.lit(1).cast("long").alias("stay_id"),
        F.date_add(F.lit(START), (F.col("id") % 50).cast("int")).alias(DAY), (F.col("id") % 50 == 40).cast("int").alias("dic"),
    )
    assert rows_of(survival.times_to_event(many, "dic").select("days", "event")) == ["(40, 1)"]
    assert START + timedelta(days=40) == many.agg(F.max(F.when(F.col("dic") == 1, F.col(DAY)))).first()[0]

from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from daymark.functions.keys import KEYS
from daymark.operators import features
from daymark.operators.features import Measure
from tests.build import by_key, days_of


def test_daily_values(spark):
    rows = [
        (1, 1, datetime(2024, 1, 1, 0, 0), "hr", 80.0),
        (1, 1, datetime(2024, 1, 1, 23, 59), "hr", 100.0),
        (1, 1, datetime(2024, 1, 1, 12, 0), "inr", 1.2),
        (1, 1, datetime(2024, 1, 2, 0, 0), "hr", 70.0),
        (1, 1, datetime(2024, 1, 2, 1, 0), "temp", None),
    ]
    keys = "subject_id bigint, stay_id bigint, charttime timestamp_ntz"
    long = spark.createDataFrame(rows, f"{keys}, item string, value double")
    daily = features.daily_values(
        long,
        [
            Measure("mean_heart_rate", "avg", items=("hr",)),
            Measure("max_heart_rate", "max", items=("hr",)),
            Measure("inr_avg", "avg", items=("inr",)),
            Measure("max_temperature", "max", items=("temp",)),
            Measure("n_not_hr", "count", excluding=("hr",)),
        ],
    )
    names = ["mean_heart_rate", "max_heart_rate", "inr_avg", "max_temperature", "n_not_hr"]
    assert by_key(daily, *names) == {
        0: (90.0, 100.0, 1.2, None, 1),
        1: (70.0, 70.0, None, None, 0),
    }


@pytest.mark.parametrize("over", [{"unique_days": True}, {"ties": KEYS}])
def test_trends(small_days, over):
    got = features.with_trends(
        small_days, lags={"inr_avg": [1, 3]}, deltas=["inr_avg", "platelet_avg"], **over
    )
    assert got.columns == small_days.columns + [
        "inr_avg_lag1", "inr_avg_lag3", "inr_avg_delta", "platelet_avg_delta"
    ]
    stays = defaultdict(list)
    for r in small_days.orderBy("chart_date").collect():
        stays[r.subject_id, r.stay_id].append(r)

    def minus(a, b):
        return None if a is None or b is None else a - b

    expected = {}
    for rows in stays.values():
        for i, r in enumerate(rows):
            before = rows[i - 1] if i else None
            expected[tuple(r[k] for k in KEYS)] = (
                before and before.inr_avg,
                rows[i - 3].inr_avg if i >= 3 else None,
                before and minus(r.inr_avg, before.inr_avg),
                before and minus(r.platelet_avg, before.platelet_avg),
            )
    assert {tuple(r[k] for k in KEYS): tuple(r)[-4:] for r in got.collect()} == expected


def test_trends_reject_taken_names(small_days):
    with pytest.raises(ValueError, match="inr_avg_delta"):
        features.with_trends(small_days.withColumn("inr_avg_delta", F.lit(0)), deltas=["inr_avg"])


def test_cohort(spark):
    days = days_of(spark, [(s, 1, n, {}) for s in (1, 2, 3, 4, 5) for n in (0, 1)])
    patients = spark.createDataFrame(
        [(1, 17), (2, 18), (3, 80), (4, 30), (5, None)], "subject_id bigint, age int"
    )
    infections = spark.createDataFrame([(2,), (2,), (1,), (None,), (4,), (5,)], "subject_id bigint")
    kept = features.cohort(days, patients, infections)
    assert sorted(r.subject_id for r in kept.collect()) == [2, 2, 4, 4]
    assert set(kept.columns) == {*days.columns, "age"}
    assert features.cohort(days, patients, infections, at_least=31).count() == 0
    assert features.adults(patients).count() == 3


def test_split_keeps_subjects_together(spark):
    days = spark.range(20_000).selectExpr("id % 2000 AS subject_id")
    split = features.with_split(days, train=60, validation=20)
    sides = split.groupBy("subject_id").agg(F.countDistinct("split").alias("n"))
    assert sides.filter("n <> 1").count() == 0
    share = {r.split: r["count"] / 20_000 for r in split.groupBy("split").count().collect()}
    assert abs(share["train"] - 0.6) < 0.05 and abs(share["test"] - 0.2) < 0.05

from itertools import product

import pytest
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC, isth, jaam, sirs
from daymark.functions.scoring import onset_of, score_days
from tests.build import days_of

NAN = float("nan")
BOUNDARIES = [
    (SIC, "platelet_avg", "platelet_score", {49.999: 2, 50.0: 1, 99.999: 1, 100.0: 0}),
    (ISTH, "platelet_avg", "dic_platelet_score", {49.999: 2, 50.0: 1, 99.999: 1, 100.0: 0}),
    (JAAM, "platelet_avg", "jaam_platelet_score", {79.999: 3, 80.0: 1, 119.999: 1, 120.0: 0}),
    (SIC, "inr_avg", "inr_score", {1.199: 0, 1.2: 1, 1.4: 1, 1.401: 2}),
    (JAAM, "inr_avg", "jaam_inr_score", {1.199: 0, 1.2: 1, 5.0: 1}),
    (SIC, "average_sofa_score", "sofa_indicator", {1.999: 0, 2.0: 1}),
    (ISTH, "pt_avg", "dic_pt_score", {14.999: 0, 15.0: 1, 17.999: 1, 18.0: 2}),
    (ISTH, "fibrinogen_avg", "dic_fibrinogen_score", {99.999: 1, 100.0: 0}),
    (ISTH, "d_dimer_avg", "dic_d_dimer_score", {499.9: 0, 500.0: 2, 5000.0: 2, 5000.1: 3}),
    (JAAM, "mean_heart_rate", "sirs_hr", {90.0: 0, 90.1: 1}),
    (JAAM, "mean_resp_rate", "sirs_rr", {20.0: 0, 20.1: 1}),
    (JAAM, "max_temperature", "sirs_temp", {35.9: 1, 36.0: 0, 38.0: 0, 38.1: 1}),
    (JAAM, "wbc_avg", "sirs_wbc", {8.0: 1, 3999.9: 1, 4000.0: 0, 12000.0: 0, 12000.1: 1}),
]


@pytest.mark.parametrize("criterion,source,name,expected", BOUNDARIES)
def test_boundaries_null_and_nan(spark, criterion, source, name, expected):
    values = [*expected, None, NAN]
    days = days_of(spark, [(1, 1, i, {source: v}) for i, v in enumerate(values)])
    got = score_days(days, criterion).orderBy("chart_date").select(name).collect()
    missing = 0 if name.startswith("sirs") else None
    assert [r[0] for r in got] == [*expected.values(), missing, 0]


COMBINATIONS = [
    # criterion, points per score column, positives
    (SIC, {"platelet_score": range(3), "inr_score": range(3), "sofa_indicator": range(2)}, 4),
    (
        ISTH,
        {
            "dic_platelet_score": range(3),
            "dic_pt_score": range(3),
            "dic_fibrinogen_score": range(2),
            "dic_d_dimer_score": (0, 2, 3),
        },
        24,
    ),
    (
        JAAM,
        {
            "sirs_score": range(5),
            "jaam_platelet_score": (0, 1, 3),
            "jaam_inr_score": range(2),
        },
        17,
    ),
]
VALUE = {
    "platelet_score": {0: 200.0, 1: 70.0, 2: 10.0},
    "inr_score": {0: 1.0, 1: 1.3, 2: 2.0},
    "sofa_indicator": {0: 0.0, 1: 3.0},
    "dic_platelet_score": {0: 200.0, 1: 70.0, 2: 10.0},
    "dic_pt_score": {0: 12.0, 1: 16.0, 2: 20.0},
    "dic_fibrinogen_score": {0: 200.0, 1: 50.0},
    "dic_d_dimer_score": {0: 1.0, 2: 1000.0, 3: 9000.0},
    "jaam_platelet_score": {0: 200.0, 1: 100.0, 3: 10.0},
    "jaam_inr_score": {0: 1.0, 1: 1.3},
}
SIGNS = ["mean_heart_rate", "mean_resp_rate", "max_temperature", "wbc_avg"]


@pytest.mark.parametrize("criterion,points,positives", COMBINATIONS)
def test_all_score_combinations(spark, criterion, points, positives):
    source = {s.name: s.source for s in criterion.scores}
    rows, sums = [], []
    for i, combination in enumerate(product(*points.values())):
        values = {}
        for name, p in zip(points, combination):
            if name == "sirs_score":
                values |= {sign: 1e6 for sign in SIGNS[:p]}
            else:
                values[source[name]] = VALUE[name][p]
        rows.append((1, 1, i, values))
        sums.append(sum(combination))
    scored = score_days(days_of(spark, rows), criterion).orderBy("chart_date").collect()
    assert [r[criterion.today] for r in scored] == [int(s >= criterion.cut) for s in sums]
    assert sum(r[criterion.today] for r in scored) == positives
    if criterion.total:
        assert [r[criterion.total] for r in scored] == sums


@pytest.mark.parametrize("criterion", [SIC, ISTH, JAAM])
def test_one_missing_lab_makes_the_day_unknown(spark, criterion):
    labs = [s.source for s in criterion.scores]
    rows = [(1, 1, i, {lab: 1.0 for lab in labs if lab != gone}) for i, gone in enumerate(labs)]
    today = score_days(days_of(spark, rows), criterion).select(criterion.today).collect()
    assert [r[0] for r in today] == [None] * len(labs)


def test_score_types_are_int(spark):
    days = days_of(spark, [(1, 1, 0, {})])
    types = dict(score_days(score_days(days, ISTH), JAAM).dtypes)
    assert {types[c] for c in ISTH.day_columns + JAAM.day_columns} == {"int"}


def test_onset_truth_table(spark):
    flags = [(t, n) for t in (0, 1, None) for n in (0, 1, None)]
    df = spark.createDataFrame(flags, "t int, n int").withColumn("onset", onset_of("t", "n"))
    got = {(r.t, r.n): r.onset for r in df.collect()}
    assert got == {
        (0, 0): 0, (0, 1): 1, (0, None): None,
        (1, 0): 0, (1, 1): 0, (1, None): None,
        (None, 0): 0, (None, 1): 0, (None, None): None,
    }


def test_parameters(spark):
    days = days_of(spark, [(1, 1, 0, {"wbc_avg": 8.0, "pt_avg": 16.0})])
    thousands = days.select(sirs(white_cell_unit=1000)[3].column().alias("s")).first().s
    assert thousands == 0
    assert score_days(days, jaam(white_cell_unit=1000)).first().sirs_wbc == 0
    assert score_days(days, isth(pt_control=10)).first().dic_pt_score == 2


def test_other_numeric_types(spark):
    days = days_of(spark, [(1, 1, 0, {"inr_avg": 1.4, "platelet_avg": 50.0})])
    for kind in ("decimal(6,2)", "double"):
        typed = days.withColumn("inr_avg", F.col("inr_avg").cast(kind))
        assert score_days(typed, SIC).first().inr_score == 1

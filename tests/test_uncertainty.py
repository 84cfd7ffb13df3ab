import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.operators import evaluate, models, recalibrate, selection, uncertainty
from tests.test_evaluate import SPREADS, brute_auroc, draw, scored


@pytest.mark.parametrize("name", SPREADS)
def test_auroc_from_totals_handed_up(spark, name):
    parts = {0: draw(3, SPREADS[name]), None: draw(4, SPREADS[name])}
    both = scored(spark, parts[0]).union(scored(spark, parts[None]).withColumn("grp", F.lit(None).cast("int")))
    got = {r.grp: (r.n_pos, r.n_neg, r.auroc) for r in evaluate.auroc(both, groups=["grp"]).collect()}
    for g, rows in parts.items():
        n_pos = sum(y for y, _ in rows)
        assert got[g] == (n_pos, len(rows) - n_pos, pytest.approx(brute_auroc(rows), abs=1e-12))
    curve = evaluate.ranking_curve(both, groups=["grp"]).groupBy("grp").agg(*evaluate.auroc_columns())
    assert {r.grp: tuple(r)[1:] for r in curve.collect()} == got


def test_weights_count_as_repeated_rows(spark):
    rng = random.Random(1)
    rows = [(y, s, rng.randrange(4)) for y, s in draw(5, SPREADS["ties"])]
    df = spark.createDataFrame(rows, "label int, score double, w int")
    repeated = [(y, s) for y, s, w in rows for _ in range(w)]
    got = evaluate.auroc(df, weight="w").first()
    assert got.auroc == pytest.approx(brute_auroc(repeated), abs=1e-12) and got.n_pos == sum(y for y, _ in repeated)


def weight(subject, replicate):
    draw = int(hashlib.md5(f"{subject}:{replicate}".encode()).hexdigest()[:8], 16)
    total, k = 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        if draw < math.floor(2**32 * total) or k == 12:
            return k
        k += 1


def test_weights_are_poisson_and_the_same_everywhere(spark):
    ids = spark.range(3000).withColumn("r", (F.col("id") % 7).cast("int"))
    got = ids.select("id", "r", uncertainty.subject_weight(F.col("id"), F.col("r")).alias("w")).collect()
    assert all(r.w == weight(r.id, r.r) for r in got)
    share = [sum(r.w == k for r in got) / len(got) for k in range(4)]
    assert share == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(4)], abs=0.03)


def test_a_hash_is_worked_out_once_for_all_cuts(spark):
    df = spark.createDataFrame([(1, 0, 0.5, "a")], "subject_id long, label int, score double, g string")

    def hashes(rows):
        return rows._jdf.queryExecution().optimizedPlan().toString().count("md5(")

    # Once in the filter and once for the rows that it leaves; it was 24 times.
    assert 1 <= hashes(uncertainty.auroc_replicates(df, 5, groups=["g"])) <= 2
    assert hashes(df.select(uncertainty.subject_weight(F.col("subject_id"), F.col("label")).alias("w"))) == 1


def test_replicates_against_repeated_subjects(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(30), rng.randrange(2), rng.randrange(40) / 40, rng.choice("ab")) for _ in range(600)]
    df = spark.createDataFrame([*rows, (None, 1, 0.5, "a")], "subject_id long, label int, score double, g string")
    by_replicate = uncertainty.auroc_replicates(df, 15, groups=["g"]).cache()
    got = {(r.g, r.replicate): r.auroc for r in by_replicate.collect()}
    expected = {}
    for g in "ab":
        for b in range(16):
            drawn = [(y, s) for i, y, s, h in rows if h == g for _ in range(1 if b == 0 else weight(i, b))]
            expected[g, b] = pytest.approx(brute_auroc(drawn), abs=1e-12)
    assert got == expected
    for r in uncertainty.auroc_intervals(by_replicate, ["g"], level=0.8).collect():
        drawn = [got[r.g, b] for b in range(1, 16)]
        assert (r.auroc, r.n_replicates) == (got[r.g, 0], 15)
        assert (r.low, r.high) == pytest.approx(tuple(np.quantile(drawn, [0.1, 0.9])), abs=1e-12)
    apart = uncertainty.auroc_differences(by_replicate, "g", level=0.8).collect()
    assert len(apart) == 1
    drawn = [got["a", b] - got["b", b] for b in range(1, 16)]
    assert apart[0].difference == pytest.approx(got["a", 0] - got["b", 0], abs=1e-12)
    assert (apart[0].low, apart[0].high) == pytest.approx(tuple(np.quantile(drawn, [0.1, 0.9])), abs=1e-12)


def modelling_rows(spark, n=600):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        x, y = rng.random(), rng.random()
        rows.append((i % 60, i % 60, None, int(x + 0.3 * rng.random() > 0.7), x, y))
    schema = "subject_id long, stay_id long, chart_date date, label int, x double, y double"
    return spark.createDataFrame(rows, schema)


def test_every_row_is_scored_once_by_a_model_that_has_not_seen_its_subject(spark):
    rows = modelling_rows(spark)
    seen = []

    def fit(train, features):
        seen.append({r.subject_id for r in train.select("subject_id").distinct().collect()})
        return models.fit_logistic(train, features, maxIter=5)

    got = selection.out_of_fold(rows, ["x", "y"], {"a": fit, "b": fit}, folds=3)
    assert got.groupBy("candidate").count().collect() and got.count() == 2 * rows.count()
    folds = {}
    for r in got.select("fold", "subject_id").distinct().collect():
        folds.setdefault(r.fold, set()).add(r.subject_id)
    assert len(folds) == 3 and sum(map(len, folds.values())) == 60
    everyone = set(range(60))
    assert sorted(map(sorted, seen)) == sorted(sorted(everyone - f) for f in folds.values() for _ in range(2))


def test_candidates_are_ranked(spark):
    rows = modelling_rows(spark)
    fits = {
        "good": lambda train, _: models.fit_logistic(train, ["x"]),
        "blind": lambda train, _: models.fit_logistic(train, ["y"]),
    }
    ranked = selection.best_candidate(selection.out_of_fold(rows, ["x", "y"], fits, folds=3)).collect()
    assert [(r.place, r.candidate) for r in ranked] == [(1, "good"), (2, "blind")]
    assert ranked[0].auroc > 0.85 > ranked[1].auroc


def test_penalty_search(spark):
    found = selection.search_penalty(modelling_rows(spark), ["x", "y"], [0.0, 100.0], folds=3)
    assert len(found.avgMetrics) == 2 and found.avgMetrics[0] > 0.85
    assert found.bestModel.getRegParam() == 0.0


def pool_adjacent(counts):
    blocks = []
    for s, n, p in sorted(counts):
        blocks.append([[s], n, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return {s: p / n for scores, n, p in blocks for s in scores}


@pytest.mark.parametrize("seed", [1, 2])
def test_isotonic_rates(spark, seed):
    rng = random.Random(seed)
    rows = [(int(rng.random() < s * s + 0.1 * math.sin(20 * s)), s) for s in (rng.randrange(101) / 100 for _ in range(900))]
    df = spark.createDataFrame([*rows, (None, 0.5), (1, None)], "label int, score double")
    model = recalibrate.fit_isotonic(df, digits=2)
    counts = {}
    for y, s in rows:
        n, p = counts.get(s, (0, 0))
        counts[s] = (n + 1, p + y)
    expected = pool_adjacent([(s, n, p) for s, (n, p) in counts.items()])
    got = recalibrate.recalibrated(model, df)
    assert got.columns == ["label", "score", "calibrated"]
    rates = {}
    for r in got.collect():
        if r.score is None:
            assert r.calibrated is None
        elif r.score in expected:
            rates[r.score] = r.calibrated
            assert r.calibrated == pytest.approx(expected[r.score], abs=1e-9)
    assert [rates[s] for s in sorted(rates)] == sorted(rates.values())
    with pytest.raises(ValueError, match="digits"):
        recalibrate.fit_isotonic(df, digits=9)

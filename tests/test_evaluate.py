import random

import pytest
from pyspark.sql import functions as F

from daymark.operators import evaluate


def brute_auroc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_average_precision(rows):
    area, positives = 0.0, sum(y for y, _ in rows)
    for threshold in {s for _, s in rows}:
        above = [y for y, s in rows if s >= threshold]
        here = sum(y for y, s in rows if s == threshold)
        area += here / positives * sum(above) / len(above)
    return area


def scored(spark, rows, grp=0):
    return spark.createDataFrame([(y, s, grp) for y, s in rows], "label int, score double, grp int")


def draw(seed, spread):
    rng = random.Random(seed)
    return [(rng.randrange(3) // 2, spread(rng)) for _ in range(400)]


SPREADS = {
    "ties": lambda rng: rng.randrange(20) / 20,
    "uniform": lambda rng: rng.random(),
    "crowded": lambda rng: 0.3 + rng.randrange(500) * 1e-11,
    "ends": lambda rng: rng.choice([0.0, 1.0, 1e-12, 0.5]),
    "tiny": lambda rng: rng.randrange(50) * 1e-300,
    "subnormal": lambda rng: rng.randrange(9) * 5e-324,
    "one bit apart": lambda rng: 0.7 + rng.randrange(40) * 2.0**-53,
}


@pytest.mark.parametrize("name", SPREADS)
def test_ranking_metrics_against_all_pairs(spark, name):
    rows = draw(7, SPREADS[name])
    got = evaluate.summary(scored(spark, rows)).first()
    assert got.auroc == pytest.approx(brute_auroc(rows), abs=1e-12)
    assert got.auprc == pytest.approx(brute_average_precision(rows), abs=1e-9)
    called = [(y, s >= 0.5) for y, s in rows]
    assert (got.tp, got.fp, got.tn, got.fn) == tuple(
        called.count(c) for c in [(1, True), (0, True), (0, False), (1, False)]
    )


def test_groups_keep_apart_and_null_is_a_group(spark):
    parts = {
        0: draw(1, SPREADS["uniform"]),
        1: draw(2, SPREADS["ties"]),
        None: draw(3, SPREADS["ties"]),
    }
    df = None
    for grp, rows in parts.items():
        one = scored(spark, rows, grp)
        df = one if df is None else df.union(one)
    for got in evaluate.summary(df, groups=["grp"]).collect():
        assert got.auroc == pytest.approx(brute_auroc(parts[got.grp]), abs=1e-12)
    direct = evaluate.confusion(df, groups=["grp"])
    summary = evaluate.summary(df, groups=["grp"])
    names = ["grp", "tp", "fp", "tn", "fn", "sensitivity", "specificity", "ppv", "npv", "f1"]
    rows = [sorted(map(str, t.select(*names).collect())) for t in (direct, summary)]
    assert rows[0] == rows[1]


def test_curve_ends_at_the_totals(spark):
    rows = draw(4, SPREADS["uniform"])
    last = evaluate.ranking_curve(scored(spark, rows)).orderBy("score").first()
    assert (last.tp, last.fp) == (sum(y for y, _ in rows), sum(1 - y for y, _ in rows))


def test_one_class_has_no_rates(spark):
    got = evaluate.summary(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (got.auroc, got.auprc, got.sensitivity, got.specificity) == (None, None, None, 1.0)


def test_unknown_labels_and_scores_are_left_out(spark):
    got = evaluate.auroc(scored(spark, [(1, 0.9), (0, 0.1), (None, 0.5), (1, None)])).first()
    assert (got.n_pos, got.n_neg, got.auroc) == (1, 1, 1.0)


@pytest.mark.parametrize("bad", [-0.1, 1.5, float("nan")])
@pytest.mark.parametrize(
    "metric", [evaluate.auroc, evaluate.confusion, evaluate.calibration, evaluate.summary]
)
def test_scores_must_be_probabilities(spark, metric, bad):
    with pytest.raises(Exception, match="probability"):
        metric(scored(spark, [(1, bad), (0, 0.1)])).collect()


def test_close_scores_are_told_apart(spark):
    for low, high in [(1e-13, 3e-13), (0.9999999999996, 0.9999999999999), (0.0, 5e-324)]:
        assert evaluate.auroc(scored(spark, [(1, high), (0, low)])).first().auroc == 1.0


def test_the_threshold_is_exact(spark):
    rows = [(1, 0.4999999999999), (1, 0.5), (0, 0.49999999999999994)]
    got = evaluate.summary(scored(spark, rows), threshold=0.5).first()
    assert (got.tp, got.fn, got.tn, got.fp) == (1, 1, 1, 0)


def test_order_keys_follow_the_scores(spark):
    rng = random.Random(3)
    values = [0.0, 1.0, 5e-324, 2.0**-1022, 0.5, 1 / 3]
    values += [rng.random() * 2.0 ** -rng.randrange(0, 1070) for _ in range(3000)]
    values += [v * (1 - 2.0**-53) for v in values[1:1500]]
    values = sorted(set(values))
    df = spark.createDataFrame([(v,) for v in values], "score double")
    keyed = df.withColumn("k", evaluate._order_key(F.col("score")))
    got = keyed.withColumn("back", evaluate._score_of(F.col("k"))).collect()
    assert all(r.back == r.score for r in got)
    keys = [r.k for r in sorted(got, key=lambda r: r.score)]
    assert all(a < b for a, b in zip(keys, keys[1:]))
    assert max(keys) < 1 << (3 * evaluate.LEVEL_BITS)


def test_calibration(spark):
    rows = [(0, 0.0), (1, 0.05), (1, 0.95), (1, 1.0), (0, 0.5)]
    got = {
        r.bin: (r.n_rows, r.n_pos, r.mean_score, r.observed_rate)
        for r in evaluate.calibration(scored(spark, rows)).collect()
    }
    assert got == {
        0: (2, 1, pytest.approx(0.025), 0.5),
        5: (1, 0, 0.5, 0.0),
        9: (2, 2, pytest.approx(0.975), 1.0),
    }

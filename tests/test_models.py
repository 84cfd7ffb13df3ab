import pytest
from pyspark.sql import functions as F

from daymark import session
from daymark.operators import evaluate, models
from tests.build import START


@pytest.fixture(scope="module")
def rows(spark):
    """A label that follows ``told`` and has nothing to do with ``noise``."""
    days = spark.range(600).selectExpr(
        "id AS subject_id",
        "id AS stay_id",
        f"date'{START}' AS chart_date",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(id % 10 AS DOUBLE) END AS told",
        "CAST(xxhash64(id) % 100 AS DOUBLE) AS noise",
        "CASE WHEN id % 37 = 0 THEN NULL ELSE CAST(id % 10 >= 5 AS INT) END AS onset",
    )
    return models.modelling_table(days, "onset", ["told", "noise"])


def test_modelling_table(rows):
    assert rows.columns == ["subject_id", "stay_id", "chart_date", "label", "told", "noise"]
    assert rows.count() == 600 - 17
    assert rows.rdd.isCheckpointed() or "Scan ExistingRDD" in str(
        rows._jdf.queryExecution().executedPlan()
    )


@pytest.mark.parametrize("fit", [models.fit_logistic, models.fit_boosted_trees])
def test_models_learn_and_rank(rows, fit):
    model = fit(rows, ["told", "noise"], maxIter=5)
    predicted = models.predict(model, rows)
    assert predicted.columns == ["subject_id", "stay_id", "chart_date", "label", "score"]
    assert predicted.count() == rows.count()
    assert evaluate.auroc(predicted).first().auroc > 0.9


def test_importance(spark, rows):
    features = ["told", "noise"]
    trees = models.fit_boosted_trees(rows, features, maxIter=3)
    weights = models.tree_importance(trees, features, spark).collect()
    assert {r.feature: r.importance for r in weights}["told"] > 0.8
    loss = {
        r.feature: r.auroc_loss
        for r in models.permutation_importance(trees, rows, features).collect()
    }
    assert loss["told"] > 0.3 and abs(loss["noise"]) < 0.1


def test_each_row_borrows_from_one_other(spark, rows, monkeypatch):
    seen = []

    def watched(scored, groups):
        seen.append(scored)
        return evaluate.auroc(scored, groups=groups)

    monkeypatch.setattr(models, "auroc", watched)
    model = models.fit_logistic(rows, ["told", "noise"])
    models.permutation_importance(model, rows, ["told", "noise"]).collect()
    assert seen[0].groupBy("feature").count().select("count").distinct().collect() == [(583,)]


def test_convergence_is_reported(rows):
    assert not models.converged(models.fit_logistic(rows, ["noise"], maxIter=1))
    assert models.converged(models.fit_logistic(rows, ["noise"]))


def test_a_feature_without_values_is_refused(rows):
    with pytest.raises(ValueError, match="empty"):
        empty = rows.withColumn("empty", F.lit(float("nan")))
        models.fit_logistic(empty, ["told", "empty"])


def test_checkpoint_folder_is_the_sessions(spark):
    assert spark.sparkContext.getCheckpointDir() is not None
    before = spark.sparkContext.getCheckpointDir()
    session.cut_lineage(spark.range(3).withColumn("x", F.lit(1)))
    assert spark.sparkContext.getCheckpointDir() == before

"""Choosing a model by folds that keep the days of a subject together."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.evaluate import auroc
from daymark.operators.features import split_bucket
from daymark.operators.models import predict
from daymark.session import cut_lineage

Fit = Callable[[DataFrame, Sequence[str]], PipelineModel]


def with_fold(rows: DataFrame, folds: int = 5, subject: str = "subject_id") -> DataFrame:
    """Add ``fold``, from a hash of the subject alone; needs no shuffle."""
    return rows.withColumn("fold", split_bucket(subject, folds))


def out_of_fold(
    rows: DataFrame,
    features: Sequence[str],
    candidates: Mapping[str, Fit],
    folds: int = 5,
    at_once: int = 4,
    subject: str = "subject_id",
) -> DataFrame:
    """Each row scored once by each candidate, by a model that has not seen its subject.

    Returns what :func:`daymark.operators.models.predict` returns, with
    ``candidate`` and ``fold``. The rows are written to reliable storage once
    and read by all fits; ``at_once`` fits run side by side, so that one's
    short jobs fill the executors that another leaves idle.
    """
    placed = cut_lineage(with_fold(rows, folds, subject))

    def scores(name: str, fold: int) -> DataFrame:
        model = candidates[name](placed.filter(F.col("fold") != fold), features)
        scored = predict(model, placed.filter(F.col("fold") == fold))
        return scored.withColumn("candidate", F.lit(name))

    with ThreadPoolExecutor(at_once) as pool:
        task = inheritable_thread_target(rows.sparkSession)(scores)
        parts = list(pool.map(lambda at: task(*at), [(c, k) for c in candidates for k in range(folds)]))
    return reduce(DataFrame.unionByName, parts)


def best_candidate(scored: DataFrame) -> DataFrame:
    """AUROC over all out-of-fold scores of each candidate, best first by ``place``; ties by name."""
    by_candidate = auroc(scored, groups=["candidate"])
    # One row for each candidate.
    ranked = by_candidate.orderBy(F.desc_nulls_last("auroc"), "candidate")
    order = ranked.agg(F.collect_list(F.struct("candidate", "n_pos", "n_neg", "auroc")).alias("all"))
    return order.select(F.posexplode("all").alias("place", "one")).select(
        (F.col("place") + 1).alias("place"), "one.*"
    )


def search_penalty(
    rows: DataFrame,
    features: Sequence[str],
    penalties: Sequence[float],
    folds: int = 5,
    at_once: int = 4,
    subject: str = "subject_id",
) -> CrossValidatorModel:
    """The penalty of a logistic regression with the best mean AUROC over folds of whole subjects.

    Spark ML's own search, told which fold a row is in; ``avgMetrics`` of the
    result has one figure for each penalty, in their order.
    """
    placed = cut_lineage(with_fold(rows, folds, subject))
    filled = [f"{f}_filled" for f in features]
    prepared = Imputer(inputCols=list(features), outputCols=filled).fit(placed).transform(placed)
    vectors = VectorAssembler(inputCols=filled, outputCol="features").transform(prepared)
    estimator = LogisticRegression()
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=ParamGridBuilder().addGrid(estimator.regParam, list(penalties)).build(),
        evaluator=BinaryClassificationEvaluator(labelCol="label"),
        numFolds=folds,
        foldCol="fold",
        parallelism=at_once,
    )
    return search.fit(vectors.select("label", "features", "fold"))

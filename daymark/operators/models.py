"""Next-day models on a labelled table, fitted and applied by Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.keys import KEYS
from daymark.operators.evaluate import auroc
from daymark.session import cut_lineage

def modelling_table(labelled: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Keys, label and features of the rows with a known label, in reliable storage.

    Training reads its rows many times; after this a lost executor costs a
    read instead of a rerun of the labelling windows.
    """
    return cut_lineage(
        labelled.filter(F.col(label).isNotNull()).select(
            *KEYS,
            F.col(label).cast("int").alias("label"),
            *[F.col(f).cast("double").alias(f) for f in features],
        )
    )


def _fit(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    counts = train.agg(*[F.count(F.nanvl(f, F.lit(None))).alias(f) for f in features]).first()
    unknown = [f for f in features if not counts[f]]
    if unknown:
        raise ValueError(f"no known value in training: {', '.join(unknown)}")
    filled = [f"{f}_filled" for f in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="features"),
        estimator,
    ]
    return Pipeline(stages=stages).fit(train)


def fit_logistic(train: DataFrame, features: Sequence[str], **params) -> PipelineModel:
    """Logistic regression; missing values take the training mean."""
    return _fit(train, features, LogisticRegression(**params))


def converged(model: PipelineModel) -> bool:
    """Whether a fitted logistic regression stopped by itself, before its last allowed step."""
    fitted = model.stages[-1]
    return fitted.summary.totalIterations < fitted.getMaxIter()


def fit_boosted_trees(train: DataFrame, features: Sequence[str], **params) -> PipelineModel:
    """Gradient-boosted trees; missing values take the training mean."""
    defaults = {"maxIter": 20, "maxDepth": 4, "seed": 42}
    return _fit(train, features, GBTClassifier(**(defaults | params)))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Keys, label and the predicted probability of the label being 1."""
    return model.transform(rows).select(
        *[c for c in (*KEYS, "feature", "split", "fold", "label") if c in rows.columns],
        vector_to_array("probability")[1].alias("score"),
    )


def tree_importance(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Importance of each feature inside a fitted tree ensemble."""
    weights = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame(
        [(f, float(w)) for f, w in zip(features, weights)], "feature string, importance double"
    )


def permutation_importance(
    model: PipelineModel, rows: DataFrame, features: Sequence[str], seed: int = 42
) -> DataFrame:
    """Loss of AUROC when one feature is taken from another, random row.

    All rows stand in one random order, and each borrows from the next, the last
    from the first. The order is dealt into as many blocks as the session has
    shuffle partitions; the last row of a block borrows from the first of the next.
    All features are scored in one pass; per feature only the counts by distinct score are
    shuffled.
    """
    rows = cut_lineage(rows)
    blocks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = F.struct(*features)
    # Over checkpointed rows a seeded draw repeats itself on recomputation.
    dealt = rows.withColumns(
        {"_block": F.floor(F.rand(seed) * blocks), "_draw": F.rand(seed + 1)}
    )
    firsts = dealt.groupBy("_block").agg(F.min_by(values, "_draw").alias("_first"))
    # One row per block: this window is a handful of rows.
    by_block = Window.partitionBy().orderBy("_block")
    every = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    beyond = firsts.select(
        "_block",
        F.coalesce(F.lead("_first").over(by_block), F.first("_first").over(every)).alias("_beyond"),
    )
    order = Window.partitionBy("_block").orderBy("_draw")
    dealt = dealt.withColumn("_near", F.lead(values).over(order)).join(beyond, "_block")
    lent = F.coalesce("_near", "_beyond")

    def variant(name, borrowed):
        taken = [F.col(f"_lent.{f}") if f == borrowed else F.col(f) for f in features]
        return F.struct(
            F.lit(name).alias("feature"), *[t.alias(f) for t, f in zip(taken, features)]
        )

    variants = [variant("(none)", None)] + [variant(f, f) for f in features]
    rescored = dealt.select("label", *features, lent.alias("_lent")).select(
        "label", F.inline(F.array(*variants))
    )
    by_feature = auroc(predict(model, rescored), groups=["feature"])
    # One row per feature: a window over the whole result is a handful of rows.
    intact = F.max(F.when(F.col("feature") == "(none)", F.col("auroc"))).over(Window.partitionBy())
    return (
        by_feature.select("feature", "auroc", (intact - F.col("auroc")).alias("auroc_loss"))
        .filter(F.col("feature") != "(none)")
    )

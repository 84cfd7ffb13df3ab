"""Probabilities that agree with observed rates: an isotonic fit of labels on scores."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.evaluate import checked

MOST_DIGITS = 6


def score_counts(
    scored: DataFrame, digits: int = MOST_DIGITS, label: str = "label", score: str = "score"
) -> DataFrame:
    """Rows and positives of each score, rounded to ``digits``: at most ``10 ** digits + 1`` rows."""
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must be 1 to {MOST_DIGITS}")
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(F.round(checked(score), digits).alias("score")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(label) == 1, 1)).alias("n_pos")
    )


def fit_isotonic(
    scored: DataFrame, digits: int = MOST_DIGITS, label: str = "label", score: str = "score"
) -> IsotonicRegressionModel:
    """The rate that never falls as the score rises and is closest to the labels.

    Adjacent scores whose rates fall are pooled into blocks. Rows are counted
    per score first, so what is pooled is bounded by ``digits``, whatever the
    number of rows, and so is the model.
    """
    counts = score_counts(scored, digits, label, score)
    rates = counts.select(
        F.col("score").alias("features"),
        (F.col("n_pos") / F.col("n_rows")).alias("label"),
        F.col("n_rows").cast("double").alias("weight"),
    )
    return IsotonicRegression(weightCol="weight").fit(rates)


def recalibrated(model: IsotonicRegressionModel, rows: DataFrame, score: str = "score") -> DataFrame:
    """Add ``calibrated``: the fitted rate at a score, between two blocks on the line that joins them.

    A NULL score stays NULL; a score outside of those seen takes the nearest block's rate.
    """
    fitted = model.copy().setFeaturesCol("_score").setPredictionCol("_rate")
    placed = rows.withColumn("_score", F.coalesce(score, F.lit(0.0)))
    return (
        fitted.transform(placed)
        .withColumn("calibrated", F.when(F.col(score).isNotNull(), F.col("_rate")))
        .drop("_score", "_rate")
    )

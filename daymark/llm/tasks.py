"""Python steps of the operators, in tasks that Spark deals out."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, if it isn't installed."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow``: ``function`` turns an iterator of record batches into another."""
    let_workers_import(df.sparkSession)
    return df.mapInArrow(function, schema)

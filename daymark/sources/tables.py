"""Reading and writing tables by path or by catalog name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.parquet(source) if is_path(source) else spark.table(source)


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    bucket_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Write Parquet; ``mode`` is "overwrite" (replace) or "ignore" (create if absent).

    A catalog table can be bucketed and sorted, which lets later windows and
    joins on the bucket columns run without an exchange. Give ``df`` that
    partitioning beforehand, so that each bucket becomes one file.
    """
    if mode not in ("overwrite", "ignore"):
        raise ValueError(f"mode must be overwrite or ignore, not {mode}")
    if buckets and is_path(target):
        raise ValueError("bucketing needs a catalog table, not a path")
    if sort_by and not buckets:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode).format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        writer = writer.sortBy(*sort_by) if sort_by else writer
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)

"""Tables in the shared folder, which cut lineage and outlive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from daymark.session import shared_folder


def shared_path(df: DataFrame, name: str) -> str:
    return f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder, and read back."""
    path = shared_path(df, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""A local session for tests and measurements, and the settings that suit these jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Joins on all three keys may reuse the exchange of the window on two of them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # Plans are built with far fewer calls when call sites are not recorded.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daymark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder of this session that all executors reach, for tables and checkpoints.

    It lies in the folder named by ``spark.checkpoint.dir``. A local session
    without one uses its warehouse; a cluster without one is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None
        )
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` from reliable storage, so that a lost executor costs a read, not a rerun."""
    shared_folder(df.sparkSession)
    return df.checkpoint()

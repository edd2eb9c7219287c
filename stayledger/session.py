"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call-site capture costs more than most expressions it is captured for
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(
    cores: int | str = "*", *, shuffle_partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stayledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, for checkpoints and hand-over tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset
    (tests, local runs) a fresh temporary folder is used.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="stayledger-")
    return _local_folders[context.applicationId]


def stable(df: DataFrame) -> DataFrame:
    """Write a table that several later steps read to the checkpoint folder.

    Its lineage ends there: a lost executor re-reads files, and the plans that
    follow neither recompute it nor carry its history.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()

"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 32

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tideline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-"))
    return context.getCheckpointDir()


def spread(scan: DataFrame) -> DataFrame:
    """A scan in at least as many tasks as there are cores.

    Only a scan with fewer splits is shuffled, as one small file is; parsing
    would otherwise keep most cores idle.  For plain scans: on a plan that
    already shuffles, counting partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def small_side(df: DataFrame, column: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df``, marked for broadcast if its only column measures less than ``limit`` bytes.

    Measuring runs ``df``, so it should be persisted or staged.
    """
    size = df.agg(F.coalesce(F.sum(F.octet_length(column) + ROW_OVERHEAD), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the scratch folder and read it back.

    The result no longer depends on the tasks that computed it, so it is the
    same rows in every later use, also after executors are lost.  The files stay
    until the folder is cleaned.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

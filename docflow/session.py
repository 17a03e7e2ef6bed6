"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast by measured sizes only: estimates from compressed files can be far too low
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    # hash joins only where every partition of the small side is measured to fit
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # a union whose branches AQE splits differently must not zip their partitions
    "spark.sql.unionOutputPartitioning": "false",
    # rows placed by document need not be moved again to be joined by document and block id
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # rows that hold a whole response are read one by one, not by thousands at once
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "false",
    # a hot document must be split even where the split costs another exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


COMPRESSION = "zstd"  # of written intermediates


def configure(spark: SparkSession) -> SparkSession:
    """Set what results or skew handling depend on; sizes stay the cluster's choice."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A machine-local folder is only used where the whole session is one
    process; on a cluster the setting must name a shared folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/docflow/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table, and delete at once what was shuffled for it, not when the driver happens to collect its garbage.

    Only for writes: rows that a caller fetches one by one may need shuffles after their query has ended.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.mode(mode).option("compression", COMPRESSION).parquet(path)
    finally:
        conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Stored tables as folders of batches, and the mark of a finished batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def read_batches(spark: SparkSession, path: str, name: str | None = None) -> DataFrame | None:
    """All batches of a stored table, or None before the first.

    With ``name`` the table is one of several below ``path``, and only batches
    that are marked finished there are read: they follow each other, so the last one is enough to know.
    """
    folder = path if name is None else f"{path}/{name}"
    try:
        found = spark.read.option("basePath", folder).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if name is None:
        return found
    done = last_finished(spark, path)
    return None if done is None else found.where(F.col("batch") <= done)


def last_finished(spark: SparkSession, path: str) -> int | None:
    """The last batch that wrote all its tables below ``path``."""
    done = read_batches(spark, f"{path}/finished_batches")
    return None if done is None else done.agg(F.max("batch")).first()[0]


def finish_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """The last thing a batch does."""
    write_batch(spark.range(1), f"{path}/finished_batches", batch_id)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_batch_path(path, batch_id))

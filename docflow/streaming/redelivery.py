"""Messages that fail are tried again with later batches, and are dead after so many attempts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from docflow.operators import Outcome
from docflow.streaming.batches import finish_batch, last_finished, read_batches, write_batch

ATTEMPTS = 3


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def stream_redelivered(
    messages: DataFrame, path: str, checkpoint: str, handle: Callable[[DataFrame], Outcome], attempts: int = ATTEMPTS,
) -> DataStreamWriter:
    """Hand every message to ``handle`` until it is accepted, at most ``attempts`` times.

    A batch tries its own messages and those that wait since the batch before,
    and stores what is ``accepted``, what is ``waiting`` for the next batch (with its
    ``reason``) and what is ``dead``; ``attempt`` counts from 1. The rejected rows
    of ``handle`` are its input with a ``reason``. It is called once for each number of
    attempts, so rows need no key, and must give the same answer when a batch
    is replayed.
    """
    if attempts < 1:
        raise ValueError("a message is tried at least once")
    columns = messages.columns

    def put(df: DataFrame, n: int) -> None:
        spark, fresh = df.sparkSession, df.persist()
        before = read_batches(spark, path, "waiting")
        before = None if before is None else before.where(F.col("batch") == n - 1)
        tried, waiting, dead = [], [], []
        for attempt in range(1, attempts + 1):
            rows = fresh
            if attempt > 1:
                if before is None:
                    break
                rows = before.where(F.col("attempt") == attempt - 1).select(*columns)
            out, number = handle(rows), F.lit(attempt).alias("attempt")
            tried.append(out.accepted.select("*", number))
            (waiting if attempt < attempts else dead).append(out.rejected.select(*columns, "reason", number))
        none = (waiting or dead)[0].limit(0)
        write_batch(_union(tried), f"{path}/accepted", n)
        write_batch(_union(waiting or [none]), f"{path}/waiting", n)
        write_batch(_union(dead or [none]), f"{path}/dead", n)
        finish_batch(spark, path, n)
        fresh.unpersist()

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)


def accepted_messages(spark: SparkSession, path: str) -> DataFrame:
    """What ``handle`` accepted in all batches, with the ``attempt`` that worked."""
    return read_batches(spark, path, "accepted")


def waiting_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages that the next batch tries again."""
    rows = read_batches(spark, path, "waiting")
    return rows.where(F.col("batch") == last_finished(spark, path))


def dead_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages that failed ``attempts`` times, with their last reason; input for a person or a mended ``handle``."""
    return read_batches(spark, path, "dead")

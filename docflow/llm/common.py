"""What several operators share: written intermediates, Arrow text, graph components."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import configure, scratch_dir

CHUNK_BYTES = 2_000_000
BATCH_BYTES = 16_000_000
BROADCAST_ROWS = 1_000_000
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and this package sent to the executors once per application."""
    configure(spark)
    # texts are long: batches of few rows bound what a task holds twice
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="ship-")  # on the driver, which serves the file
        path = shutil.make_archive(os.path.join(folder, f"docflow-{os.getpid()}"), "zip", os.path.dirname(package), "docflow")
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def when_small(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow table of keys, marked for broadcast where it is counted and found small; else it is joined by a shuffle."""
    return F.broadcast(keys) if keys.count() <= rows else keys


def with_key(docs: DataFrame, id_col: str, *order: str, key: str = "key") -> DataFrame:
    """Add a unique number that orders rows as their ids do.

    That is the id itself, unless ids are no whole numbers, missing or repeated; then
    the rows are sorted by id (null first) and ``order``, and numbered in a written table.
    """
    if docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        odd = docs.groupBy(F.col(id_col).alias("id")).count().where("count > 1 or id is null")
        if odd.isEmpty():
            return docs.withColumn(key, F.col(id_col).cast("bigint"))
    return written(docs.orderBy(id_col, *order).withColumn(key, F.monotonically_increasing_id()), "numbered")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def text_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]


def text_buffers(column, chunk_bytes: int = CHUNK_BYTES):
    """Whole texts of an Arrow column, some at a time.

    Yields ``(first row, bytes as uint8, offsets)``; a text is never cut, so a
    text above ``chunk_bytes`` makes a chunk of its own.
    """
    texts = text_bytes(column)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = 0
    while first < len(texts):
        total = np.cumsum(sizes[first:])
        n = max(1, int(np.searchsorted(total, chunk_bytes, side="right")))
        offsets = np.concatenate([[0], total[:n]])
        yield first, np.frombuffer(b"".join(texts[first : first + n]), dtype=np.uint8), offsets
        first += n


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of an edge: the least node it reaches.

    ``edges`` has two columns of one ordered type. Alternates large and small
    stars: every round links a node to the least of its neighbours, so the
    number of rounds grows with the logarithm of the longest path. Each round is
    aggregates and joins on the node; a hub is combined before the shuffle and
    its join is left to adaptive skew handling. Null ends and loops are ignored.
    """
    a, b = edges.columns
    now = written(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        now = written(smaller, name)
        state = now.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state

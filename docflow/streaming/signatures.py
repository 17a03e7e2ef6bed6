"""The first document of each signature, in generations with Bloom filters.

A batch adds a generation: its signatures in buckets, and a filter of 32,768 bits for
every few thousand of them. Generations of like size are merged into one, so
there are as many as the logarithm of the rows, and a row is written again as often as that.
A lookup asks the filters, which take about a byte and a half for a row, and reads the
buckets that may hold what it wants. The list of live generations is
written last and by batch, so a replayed batch starts from the list it had.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.streaming.batches import read_batches, write_batch

FAN = 4  # generations of one size that are merged
BASE_ROWS = 10_000  # smaller generations count as one size
BITS = 32_768
BLOCK_KEYS = 2_700  # 12 bits each: about one wrong yes in 300
HASHES = 8
BUCKET_BLOCKS = 400  # a bucket has about a million signatures
MAX_FOLDERS = 10_000  # beyond as many buckets their generations are read whole


class Generation(NamedTuple):
    name: str
    rows: int  # no fewer than there are
    blocks: int


def _block(blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64("documentSignature"), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def _bucket() -> Column:
    return F.floor(F.col("block") / BUCKET_BLOCKS).cast("int")


def _positions() -> Column:
    """Bits of a signature inside its block."""
    return F.array(*[F.pmod(F.xxhash64("documentSignature", F.lit(i)), F.lit(BITS)) for i in range(1, HASHES + 1)])


def live(spark: SparkSession, path: str, before: int | None = None) -> list[Generation]:
    """Generations as of the last batch, or the last one before ``before``; there are few."""
    lists = read_batches(spark, f"{path}/generations")
    if lists is None:
        return []
    lists = lists if before is None else lists.where(F.col("batch") < before)
    last = lists.agg(F.max("batch")).first()[0]
    found = [] if last is None else lists.where(F.col("batch") == last).where("rows > 0").orderBy("name").collect()
    return [Generation(r.name, r.rows, r.blocks) for r in found]


def _write(rows: DataFrame, path: str, gen: Generation) -> None:
    placed = rows.withColumn("block", _block(gen.blocks)).withColumn("bucket", _bucket())
    placed.repartition("bucket").sortWithinPartitions("bucket", "documentSignature").write.mode("overwrite").partitionBy(
        "bucket").parquet(f"{path}/rows/generation={gen.name}")
    stored = rows.sparkSession.read.parquet(f"{path}/rows/generation={gen.name}")
    bits = stored.select("block", F.explode(_positions()).alias("at")).groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))
    bits.write.mode("overwrite").parquet(f"{path}/filters/generation={gen.name}")


def _read(spark: SparkSession, path: str, table: str, names: list[str]) -> DataFrame:
    """``table`` of these generations, named by text even where names look like numbers."""
    parts = [spark.read.parquet(f"{path}/{table}/generation={n}").withColumn("generation", F.lit(n)) for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _size(rows: int) -> int:
    size = 0
    while rows > BASE_ROWS * FAN**size:
        size += 1
    return size


def add(spark: SparkSession, path: str, first: DataFrame, batch: int) -> list[Generation]:
    """Add a batch's first documents: ``documentSignature`` (distinct), ``timestamp``, ``documentId``."""
    columns = ["documentSignature", "timestamp", "documentId"]
    first = first.select(*columns).persist()
    rows, gens = first.count(), live(spark, path, batch)
    merged: list[Generation] = []
    if rows:
        while True:
            alike = [g for g in gens if _size(g.rows) == _size(rows)]
            if len(alike) + 1 < FAN:
                break
            merged += alike
            rows += sum(g.rows for g in alike)
            gens = [g for g in gens if g not in alike]
        if merged:
            older = _read(spark, path, "rows", [g.name for g in merged]).select(*columns)
            least = older.unionByName(first).groupBy("documentSignature").agg(F.min(F.struct("timestamp", "documentId")).alias("_doc"))
            first = least.select("documentSignature", "_doc.*")
        fresh = Generation(f"b{batch}", rows, -(-rows // BLOCK_KEYS))
        _write(first, path, fresh)
        gens = [*gens, fresh]
    # an empty list is a row of its own
    listed = [tuple(g) for g in gens] or [("", 0, 0)]
    write_batch(spark.createDataFrame(listed, "name STRING, rows BIGINT, blocks BIGINT").coalesce(1), f"{path}/generations", batch)
    first.unpersist()
    return gens


def may_hold(spark: SparkSession, path: str, wanted: DataFrame, gens: list[Generation]) -> DataFrame:
    """``(generation, bucket)`` whose filter says yes to one of ``wanted`` (``documentSignature``)."""
    sizes = F.array(*[F.struct(F.lit(g.name).alias("generation"), F.lit(g.blocks).alias("blocks")) for g in gens])
    asked = wanted.distinct().select("documentSignature", F.inline(sizes)).select(
        "documentSignature", "generation", _block(F.col("blocks")).alias("block"))
    filters = _read(spark, path, "filters", [g.name for g in gens])
    byte = lambda p: F.conv(F.hex(F.substring("bits", (p / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    has = F.forall(_positions(), lambda p: (F.floor(byte(p) / F.pow(F.lit(2), p % 8)) % 2) == 1)
    return asked.join(filters, ["generation", "block"]).where(has).select("generation", _bucket().alias("bucket")).distinct()


def known(spark: SparkSession, path: str, wanted: DataFrame, batch: int) -> DataFrame | None:
    """What the batches before ``batch`` stored in all buckets that may hold one of ``wanted``; None where no one may."""
    gens = live(spark, path, batch)
    if not gens or wanted.isEmpty():
        return None
    hits = may_hold(spark, path, wanted, gens).limit(MAX_FOLDERS + 1).collect()
    if not hits:
        return None
    # a lookup for that many buckets reads about everything in any case
    folders = {f"{path}/rows/generation={r.generation}" + (f"/bucket={r.bucket}" if len(hits) <= MAX_FOLDERS else "") for r in hits}
    if len(hits) > MAX_FOLDERS:
        folders = {f"{path}/rows/generation={g.name}" for g in gens}
    return spark.read.option("basePath", f"{path}/rows").parquet(*sorted(folders)).select("documentSignature", "timestamp", "documentId")


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete generations that neither the last list nor the one before it names; a replay needs no others."""
    lists = read_batches(spark, f"{path}/generations")
    if lists is None:
        return []
    last = [r.batch for r in lists.select("batch").distinct().orderBy(F.desc("batch")).limit(2).collect()]
    keep = {f"generation={r.name}" for r in lists.where(F.col("batch").isin(last)).select("name").collect()}
    gone = []
    for table in ("rows", "filters"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{table}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(folder) if files.exists(folder) else []:
            if status.getPath().getName() not in keep:
                files.delete(status.getPath(), True)
                gone.append(f"{table}/{status.getPath().getName()}")
    return sorted(gone)

"""Item operations on keyed tables: get, query, put, delete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators.ordered import collect_in_order, latest_by_key

FILTER_BITS = 27  # 16 MB
MOST_FILTER_BITS = 29  # 64 MB
BITS_PER_VALUE, PROBES = 16, 4  # one row in some hundred is let by that should not be


def get_document(ops: DataFrame, document_id: str) -> DataFrame:
    return ops.where(F.col("documentId") == document_id)


def items_by_key(df: DataFrame, key: str, value, cols: list[str]) -> DataFrame:
    """Rows of one key, reduced to the key and the named columns."""
    return df.where(F.col(key) == value).select(key, *[c for c in cols if c != key])


def delete_documents(df: DataFrame, ids: DataFrame, key: str = "documentId") -> DataFrame:
    """Drop the rows of the given keys; unknown keys are no error."""
    return df.join(ids.select(key), key, "left_anti")


def upsert_items(df: DataFrame, rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Put rows unconditionally.

    Of several rows of one key the latest by ``order`` wins; without it, the
    greatest by its other columns as JSON text. The stored side is only
    filtered, never aggregated.
    """
    rest = F.to_json(F.struct(*[c for c in rows.columns if c not in keys]), {"ignoreNullFields": "false"})
    fresh = latest_by_key(rows, keys, F.col(order) if order else rest)
    kept = df.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh.select(*df.columns))


def may_be_among(df: DataFrame, others: DataFrame, column: str, expected: int | None = None) -> DataFrame:
    """Rows whose ``column`` is found in that of ``others``, and some more: a Bloom filter in blocks of 8 KB.

    It is broadcast, so rows are passed over before a join moves them; an exact join must follow.
    With the number of values that ``others`` is ``expected`` to have it is made for them, up to ``MOST_FILTER_BITS``, and asks
    ``PROBES`` bits of a block; otherwise it has one size and asks one bit, and the more values there are, the fewer rows are passed over.
    """
    size = FILTER_BITS if expected is None else min(max(FILTER_BITS, (BITS_PER_VALUE * expected).bit_length()), MOST_FILTER_BITS)
    at = F.xxhash64(column).bitwiseAND(F.lit(2**size - 1))
    # places in a block: one from the hash that names the block, the others from a second hash
    more = F.xxhash64(column, F.lit(1))
    places = [F.col("_at").bitwiseAND(F.lit(65535)), *[
        F.shiftrightunsigned("_more", 16 * i).bitwiseAND(F.lit(65535)) for i in range(0 if expected is None else PROBES - 1)]]
    held = others.select(at.alias("_at"), more.alias("_more")).select(
        F.shiftright("_at", 16).alias("_block"), F.explode(F.array(*places)).alias("_place")).selectExpr(
        "_block * 1024 + shiftright(_place, 6) as _word", "shiftleft(1L, cast(_place & 63L as int)) as _set")
    all_words = df.sparkSession.range(2 ** (size - 6)).selectExpr("id as _word", "0L as _set")
    bits = held.unionByName(all_words).groupBy("_word").agg(F.bit_or("_set").alias("_set")).groupBy(
        F.shiftright("_word", 10).alias("_part")).agg(collect_in_order("_word", "_set").alias("_bits"))
    found = F.shiftright("_at", 16) == F.col("_part")
    for place in places:
        word = F.get("_bits", F.shiftright(place, 6).cast("int"))
        found = found & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return df.withColumns({"_at": at, "_more": more}).join(F.broadcast(bits), found, "left_semi").drop("_at", "_more")

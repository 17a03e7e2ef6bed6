"""Object catalog: listing and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.names import present
from docflow.operators.ordered import latest_by_key


def object_catalog(df: DataFrame) -> DataFrame:
    """Catalog rows: ``bucket``, ``key``, ``tags`` (empty map where there are none)."""
    return df.select(
        "bucket", "key", F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags")
    )


def list_objects(catalog: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """All keys of a bucket with a prefix, in key order."""
    hit = (F.col("bucket") == bucket) & F.col("key").startswith(prefix)
    return catalog.where(hit).orderBy("key")


def put_tags(catalog: DataFrame, tags: DataFrame) -> DataFrame:
    """Replace the whole tag set of each named object; the latest ``seq`` wins."""
    keys = ["bucket", "key"]
    fresh = latest_by_key(tags.select(*keys, "tags", "seq"), keys, "seq").drop("seq")
    return (
        catalog.join(fresh.withColumnRenamed("tags", "_new"), keys, "left")
        .withColumn("tags", F.coalesce("_new", "tags"))
        .drop("_new")
    )


def get_tags(catalog: DataFrame, keys: DataFrame) -> DataFrame:
    """Tags of the named objects; null for an object that is not in the catalog."""
    return keys.select("bucket", "key").join(catalog.select("bucket", "key", "tags"), ["bucket", "key"], "left")


def document_tags(objects: DataFrame, *extra: str) -> DataFrame:
    """The tags that objects of a document carry: rows (``bucket``, ``key``, ``documentId``) as catalog rows.

    An object without a document has no tags. ``extra`` columns are kept, such
    as a ``seq`` for ``put_tags``.
    """
    tags = F.when(present("documentId"), F.create_map(F.lit("documentId"), F.col("documentId")))
    return objects.select("bucket", "key", tags.alias("tags"), *extra)


def ingested_tags(events: DataFrame) -> DataFrame:
    """Tags of every created object, from routed events with document ids."""
    return document_tags(events.where(F.col("action") == "create"), "seq")


def output_tags(lines: DataFrame, bucket: str) -> DataFrame:
    """Tags of every file of ``page_outputs`` or ``annotation_lines``, one row per file."""
    files = lines.select("documentId", F.lit(bucket).alias("bucket"), F.col("path").alias("key")).distinct()
    return document_tags(files)

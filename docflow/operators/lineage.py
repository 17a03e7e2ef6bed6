"""Lineage: deletes resolved to documents, keyed append, stage outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docflow import schemas as S
from docflow.functions.names import document_link, document_signature
from docflow.operators import Outcome
from docflow.operators.ordered import SLICE_ROWS, latest_by_key, running
from docflow.session import written


def with_signature(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "documentSignature", document_signature("targetBucketName", "targetFileName", "versionId")
    )


def first_documents(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The least (timestamp, document) of each key, combined before the shuffle."""
    return rows.groupBy(*keys).agg(F.min(F.struct("timestamp", "documentId")).alias("_doc"))


def resolve_deleted_ids(lineage: DataFrame | None, events: DataFrame, slice_rows: int = SLICE_ROWS) -> Outcome:
    """Give each ``ObjectRemoved`` event the id of the document it deleted.

    That is the earliest document, by timestamp, among the rows with the same
    signature that are stored or arrived before the delete. A delete without
    one is refused, and so is every event whose time cannot be read. Other
    events pass unchanged. ``seq`` is a number or, as from
    ``flatten_notifications``, a struct that starts with one.
    """
    events = with_signature(events)
    kind = events.schema["seq"].dataType
    number = F.col("seq")[kind.fieldNames()[0]] if isinstance(kind, StructType) else F.col("seq")
    timed, untimed = events.where(number.isNotNull()), events.where(number.isNull())
    removed = F.col("s3Event").startswith("ObjectRemoved")
    rows = timed.withColumn("_removed", F.coalesce(removed, F.lit(False)))
    document = F.when(~F.col("_removed"), F.struct("timestamp", "documentId"))
    found = running(
        rows, ["documentSignature"], ["seq", "_removed", "documentId"], {"_first": ("min", document)},
        slice_on=number, slice_rows=slice_rows)
    if lineage is not None:
        deleted = timed.where(removed).select("documentSignature").distinct()
        stored = first_documents(
            lineage.join(deleted, "documentSignature", "left_semi"), ["documentSignature"]).withColumnRenamed("_doc", "_stored")
        found = found.join(stored, "documentSignature", "left").withColumn("_first", F.least("_first", "_stored"))
    columns = events.columns
    resolved = found.withColumn("documentId", F.when(F.col("_removed"), F.col("_first")["documentId"]).otherwise(F.col("documentId")))
    missing = F.col("_removed") & F.col("documentId").isNull()
    return Outcome(
        resolved.where(~missing).select(*columns),
        resolved.where(missing).select(*columns, F.lit("no earlier document with this signature").alias("reason")).unionByName(
            untimed.withColumn("reason", F.lit("event time cannot be read"))),
    )


def append_lineage(
    lineage: DataFrame | None, events: DataFrame, keep_sources: bool = False
) -> DataFrame:
    """Put events by (documentId, timestamp), last write wins.

    Source columns are kept for copies only, unless ``keep_sources``.
    """
    rows = with_signature(events)
    if not keep_sources:
        is_copy = F.col("s3Event") == S.EVENT_COPY
        for c in ("sourceBucketName", "sourceFileName"):
            rows = rows.withColumn(c, F.when(is_copy, F.col(c)))
    keys = ["documentId", "timestamp"]
    fresh = latest_by_key(rows, keys, "seq")
    if lineage is None:
        return fresh
    return lineage.join(fresh.select(*keys), keys, "left_anti").unionByName(
        fresh.select(*lineage.columns)
    )


def lineage_of(lineage: DataFrame, document_id: str) -> DataFrame:
    """All objects that come from one document, oldest first."""
    return lineage.where(F.col("documentId") == document_id).orderBy("timestamp")


def lineage_edges(lineage: DataFrame) -> DataFrame:
    """Source to target pairs."""
    return lineage.where(F.col("sourceFileName").isNotNull()).select(
        "documentId", "timestamp", "sourceBucketName", "sourceFileName",
        "targetBucketName", "targetFileName",
    )


def derivations(edges: DataFrame) -> DataFrame:
    """``(source, target, depth)``: every object and all that come from it, by the fewest steps.

    ``edges`` are source to target pairs (``lineage_edges``); objects are named by
    their links. Round ``k`` finds what lies up to ``2 ** (k + 1)`` steps apart:
    a shortest way of more than ``2 ** k`` steps starts with one of just that many, so
    only those are continued, by the ways known so far, and each pair is found
    in one round. Objects on a cycle come from each other, but none from itself. Edges without
    a file name on either side are passed over.
    """
    ways = written(edges.where(F.col("targetFileName").isNotNull()).select(
        document_link("sourceBucketName", "sourceFileName").alias("source"),
        document_link("targetBucketName", "targetFileName").alias("target"),
    ).where("source <> target").distinct().withColumn("depth", F.lit(1)), "derivations")
    known, reach = ways, 1
    while True:
        begun = known.where(F.col("depth") == reach).select("source", F.col("target").alias("_via"), F.col("depth").alias("_before"))
        onward = known.select(F.col("source").alias("_via"), "target", "depth")
        longer = begun.join(onward, "_via").where("source <> target").groupBy("source", "target").agg(
            F.min(F.col("_before") + F.col("depth")).alias("depth"))
        fresh = written(longer.join(known.select("source", "target"), ["source", "target"], "left_anti"), "derivations")
        if fresh.isEmpty():
            return known
        known, reach = known.unionByName(fresh), 2 * reach


def origins(ways: DataFrame) -> DataFrame:
    """``(target, origin, depth)`` from ``derivations``: the objects that come from no other.

    What only comes out of a cycle has no origin.
    """
    derived = ways.select(F.col("target").alias("source")).distinct()
    return ways.join(derived, "source", "left_anti").select("target", F.col("source").alias("origin"), "depth")


def record_lineage(events: DataFrame, present_key: str = "s3Event") -> DataFrame:
    """Name the event as a plain put unless it is already named."""
    return events.withColumn("s3Event", F.coalesce(F.col(present_key), F.lit(S.EVENT_PUT)))


def record_lineage_of_copy(events: DataFrame) -> DataFrame:
    """Name the event as a copy, whatever it was called."""
    return events.withColumn("s3Event", F.lit(S.EVENT_COPY))


def stage_lineage(
    outputs: DataFrame, target_bucket: str, caller: str, copy: bool = False,
    target_name: Column | str = "objectName",
) -> DataFrame:
    """Lineage events for what a stage wrote about (documentId, bucketName, objectName)."""
    rows = outputs.select(
        "documentId", F.lit(caller).alias("callerId"),
        F.col("bucketName").alias("sourceBucketName"), F.lit(target_bucket).alias("targetBucketName"),
        F.col("objectName").alias("sourceFileName"),
        (F.col(target_name) if isinstance(target_name, str) else target_name).alias("targetFileName"),
        F.lit(None).cast("string").alias("s3Event"),
    )
    return record_lineage_of_copy(rows) if copy else record_lineage(rows)

"""The state tables under Structured Streaming.

Every stored table is a folder of batches. A batch writes its own sub-folder,
``batch=<id>``, and overwrites it when it is replayed, so a lost executor or a
restart changes nothing. A batch that writes several tables marks itself finished at
the end, and readers pass over what is not: they see all of a batch or
nothing. Readers fold the batches with the same aggregates the
batch operators use; ``compact`` folds a folder into a new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from docflow.operators import Outcome, registry, tracking
from docflow.operators import lineage as lin
from docflow.operators.ordered import latest_by_key
from docflow.sources import events as ev
from docflow.streaming import signatures
from docflow.streaming.batches import finish_batch, read_batches, write_batch


def dedupe_messages(stream: DataFrame, columns: list[str], delay: str, time: str = "ts") -> DataFrame:
    """Drop repeats of a message: equal ``columns`` at the same ``time``.

    A stream remembers a message for ``delay`` after its time and drops what
    comes later than that, so it gives the same rows as a batch.
    """
    hashed = stream.withColumn(
        "_hash", F.sha2(F.to_json(F.struct(*dict.fromkeys([*columns, time])), {"ignoreNullFields": "false"}), 256)
    )
    if stream.isStreaming:
        unique = hashed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_hash"])
    else:
        unique = hashed.dropDuplicates(["_hash"])
    return unique.drop("_hash")


def stream_object_events(records: DataFrame, metadata=None) -> tuple[DataFrame, DataFrame]:
    """Registry and lineage messages of a stream (or batch) of notifications or of their records."""
    if "Records" in records.columns:
        records = ev.flatten_notifications(records)
    events = ev.assign_document_id(ev.route_object_events(records))
    return ev.build_registry_events(events, metadata), ev.build_lineage_events(events)


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append a stream to a stored table, one folder per batch."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, n: write_batch(df, path, n)
    )


def stream_tracking(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Store status events as they arrive, with the fold of each batch.

    A batch writes its events and one narrow row per document it changed, and
    reads nothing. ``tracked`` merges the folds, which are minima and maxima.
    """
    def put(df: DataFrame, n: int) -> None:
        rows = df.persist()
        write_batch(rows, f"{path}/events", n)
        write_batch(tracking.fold_state(rows), f"{path}/state", n)
        finish_batch(df.sparkSession, path, n)
        rows.unpersist()

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)


def _folded(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, path, "state").groupBy("documentId").agg(
        F.min_by("init", "init.seq").alias("init"), F.max_by("last", "last.seq").alias("last"))


def tracked_operations(spark: SparkSession, path: str) -> DataFrame:
    """Operations items as of the last finished batch."""
    return tracking.state_items(_folded(spark, path))


def tracked(spark: SparkSession, path: str) -> tracking.Tracked:
    """Operations, timeline and refused events of a stored stream, as the batch fold gives them."""
    events = read_batches(spark, path, "events").drop("batch")
    return tracking.fold_status_events(events)._replace(operations=tracked_operations(spark, path))


def stream_registry(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Register documents as messages arrive; the first message of an id wins.

    A batch stores its own first message per id and those it refuses, without
    reading what is stored; the reader picks the first over all batches.
    """
    def put(df: DataFrame, n: int) -> None:
        rows = df.persist()
        out = registry.register_documents(None, rows)
        write_batch(out.accepted, f"{path}/documents", n)
        write_batch(out.rejected, f"{path}/rejected", n)
        finish_batch(df.sparkSession, path, n)
        rows.unpersist()

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)


def registered(spark: SparkSession, path: str) -> Outcome:
    """Registered documents, and all refused messages with their reason."""
    offered = read_batches(spark, path, "documents")
    first = offered.groupBy("documentId").agg(F.min("batch").alias("_first"))
    judged = offered.join(first, "documentId")
    late = judged.where("batch > _first").drop("batch", "_first").withColumn(
        "reason", F.lit("document is already registered"))
    refused = read_batches(spark, path, "rejected")
    return Outcome(
        judged.where("batch = _first").drop("batch", "_first"),
        late if refused is None else late.unionByName(refused.drop("batch"), allowMissingColumns=True),
    )


def registered_documents(spark: SparkSession, path: str) -> DataFrame:
    return registered(spark, path).accepted


def stream_lineage(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append lineage as messages arrive; deletes look up documents of the batches before theirs.

    Besides its rows and the refused ones, a batch stores the first document of
    each signature it has seen (``signatures``). A later batch reads only the
    parts of that table whose filter knows one of its deletes, never the lineage.
    """
    def put(df: DataFrame, n: int) -> None:
        rows, spark, table = df.persist(), df.sparkSession, f"{path}/signatures"
        deletes = lin.with_signature(rows.where(F.col("s3Event").startswith("ObjectRemoved")))
        out = lin.resolve_deleted_ids(signatures.known(spark, table, deletes.select("documentSignature"), n), rows)
        write_batch(lin.append_lineage(None, out.accepted), f"{path}/lineage", n)
        write_batch(out.rejected, f"{path}/rejected", n)
        first = lin.first_documents(out.accepted.where(~F.col("s3Event").startswith("ObjectRemoved")), ["documentSignature"])
        signatures.add(spark, table, first.select("documentSignature", "_doc.*"), n)
        finish_batch(spark, path, n)
        rows.unpersist()

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)


def stored_lineage(spark: SparkSession, path: str) -> DataFrame:
    return latest_by_key(
        read_batches(spark, path, "lineage"), ["documentId", "timestamp"], ["batch", "seq"]
    ).drop("batch")


def rejected_lineage(spark: SparkSession, path: str) -> DataFrame:
    """Refused lineage messages with their reason."""
    return read_batches(spark, path, "rejected").drop("batch")


def stream_changes(records: DataFrame, path: str, checkpoint: str, handle) -> DataStreamWriter:
    """Hand the changes of every micro-batch to ``handle``, which returns an ``Outcome``; store both sides.

    ``records`` are change records as JSON text (``value``); what cannot be read
    is refused along with what ``handle`` refuses.
    """
    def put(df: DataFrame, n: int) -> None:
        rows = df.persist()
        changes = ev.read_changes(rows)
        out = handle(changes.accepted)
        write_batch(out.accepted, f"{path}/accepted", n)
        write_batch(out.rejected.unionByName(changes.rejected, allowMissingColumns=True), f"{path}/rejected", n)
        finish_batch(df.sparkSession, path, n)
        rows.unpersist()

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put)


def classify_changes(changes: DataFrame, rules: dict[str, bool] | None = None) -> Outcome:
    """Classify the registry items of inserted and changed documents; other changes are passed over."""
    image = F.col("new_image")
    items = ev.filter_changes(changes, ["INSERT", "MODIFY"]).select(
        *[image[c].alias(c) for c in ("documentId", "bucketName", "documentName")],
        ev.attribute_map(image["documentMetadata"]).alias("documentMetadata"))
    return registry.classify_documents(items, rules)


def compact(table: DataFrame, path: str) -> None:
    """Write a folded table as batch 0 of a new folder, a table of the folder above; readers move there when it is done."""
    write_batch(table, path, 0)
    finish_batch(table.sparkSession, path.rsplit("/", 1)[0], 0)


def _comparable(value: Column, kind: DataType) -> Column:
    """A value whose maps, at any depth, are sorted entries, so that equal maps compare as equal."""
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(
            e["key"].alias("k"), _comparable(e["value"], kind.valueType).alias("v")))
        return F.array_sort(pairs)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_comparable(value[f.name], f.dataType).alias(f.name) for f in kind]))
    return value


def change_feed(old: DataFrame, new: DataFrame, key: str = "documentId") -> DataFrame:
    """Changes between two snapshots: INSERT, MODIFY or REMOVE with the new image."""
    def image(df, name):
        return df.select(key, F.struct(*df.columns).alias(name))

    kind = StructType([new.schema[c] for c in old.columns if c in new.columns])
    both = image(old, "_old").join(image(new, "new_image"), key, "full_outer")
    kind = (
        F.when(F.col("_old").isNull(), "INSERT")
        .when(F.col("new_image").isNull(), "REMOVE")
        .when(~_comparable(F.col("_old"), kind).eqNullSafe(_comparable(F.col("new_image"), kind)), "MODIFY")
    )
    return both.withColumn("eventName", kind).where(F.col("eventName").isNotNull()).select(
        key, "eventName", "new_image"
    )


def replay_rejected(rejected: DataFrame) -> DataFrame:
    """Refused rows as input for another attempt."""
    return rejected.drop("reason")

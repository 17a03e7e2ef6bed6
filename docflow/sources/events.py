"""Object events, queue messages, change records; metadata messages and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.functions.names import caller_map, document_id, document_link, message_time, present
from docflow.operators import Outcome


# --- object events --------------------------------------------------------------

def read_object_events(spark: SparkSession, path: str, streaming: bool = False) -> Outcome:
    """Records of notification files (JSON lines), with an arrival order ``seq``.

    Lines that are not JSON or hold no records are refused, with their ``file``
    and ``value``; blank lines are none. As streams, both sides are run as
    queries of their own.
    """
    reader = spark.readStream if streaming else spark.read
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.trim("value") != "")
    parsed = lines.withColumn("n", F.from_json("value", f"{S.NOTIFICATION}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}))
    reason = (
        F.when(F.col("n").isNull() | F.col("n._bad").isNotNull(), "failed to parse notification")
        .when(F.coalesce(F.size("n.Records"), F.lit(0)) < 1, "no records in notification")
    )
    judged = parsed.withColumn("reason", reason)
    return Outcome(
        flatten_notifications(judged.where(F.col("reason").isNull()).select("file", "n.Records")),
        judged.where(F.col("reason").isNotNull()).select("file", "value", "reason"),
    )


def flatten_notifications(notifications: DataFrame, decode_keys: bool = False) -> DataFrame:
    """One row per record of a notification; keys stay URL-encoded unless ``decode_keys``."""
    file = F.col("file") if "file" in notifications.columns else F.lit("")
    records = notifications.select(file.alias("file"), F.posexplode("Records").alias("n", "r"))
    key = F.col("r.s3.object.key")
    return records.select(
        F.col("r.eventName").alias("eventName"), F.col("r.eventSource").alias("eventSource"),
        F.col("r.eventTime").alias("eventTime"),
        F.col("r.userIdentity.principalId").alias("principalId"),
        F.col("r.s3.bucket.name").alias("bucket"),
        (F.url_decode(key) if decode_keys else key).alias("key"),
        F.col("r.s3.object.versionId").alias("versionId"),
        F.struct(
            event_micros(F.col("r.eventTime")).alias("micros"), F.col("r.eventTime").alias("eventTime"), F.col("file"),
            F.col("r.s3.bucket.name").alias("bucket"), F.col("r.s3.object.key").alias("key"), F.col("n"),
        ).alias("seq"),
    )


def event_micros(event_time: Column) -> Column:
    """Microseconds of an event time text; null where it is no time. Texts of different length do not sort by time."""
    return F.unix_micros(F.try_to_timestamp(event_time))


def route_object_events(events: DataFrame) -> DataFrame:
    """Add ``action``: create, delete or ignore."""
    return events.withColumn(
        "action",
        F.when(F.col("eventName") == S.EVENT_DELETE, "delete")
        .when(F.col("eventName").startswith("ObjectCreated"), "create")
        .otherwise("ignore"),
    )


def assign_document_id(events: DataFrame) -> DataFrame:
    """Id per object version, the same on every recompute."""
    return events.withColumn("documentId", document_id("bucket", "key", "versionId", "eventTime"))


def event_timestamp(event_time: Column | str) -> Column:
    """Event time (ISO 8601, UTC) as message time text."""
    return F.concat(
        F.regexp_replace(F.regexp_replace(event_time, "T", " "), r"(\.0+)?Z$", ""), F.lit(" +0000 UTC")
    )


def _caller() -> Column:
    return F.create_map(F.lit("principalId"), F.col("principalId"))


def build_registry_events(events: DataFrame, metadata: dict[str, str] | Column | None = None) -> DataFrame:
    """Registry messages of create events (routed, with ``documentId``)."""
    given = S.DEFAULT_METADATA if metadata is None else metadata
    if isinstance(given, dict):
        given = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
    return events.where(F.col("action") == "create").select(
        "documentId", F.col("bucket").alias("bucketName"), F.col("key").alias("documentName"),
        document_link("bucket", "key").alias("documentLink"),
        _caller().alias("principalIAMWriter"), given.alias("documentMetadata"),
        F.when(present("versionId"), F.col("versionId")).alias("documentVersion"),
        event_timestamp("eventTime").alias("timestamp"), "seq",
    )


def build_lineage_events(events: DataFrame) -> DataFrame:
    """Lineage messages of create and delete events; a delete's document is not known yet."""
    return events.where(F.col("action").isin("create", "delete")).select(
        F.when(F.col("action") == "create", F.col("documentId"))
        .otherwise(S.UNKNOWN_DOCUMENT).alias("documentId"),
        _caller().alias("callerId"),
        F.col("bucket").alias("targetBucketName"), F.col("key").alias("targetFileName"),
        F.col("eventName").alias("s3Event"),
        F.when(present("versionId"), F.col("versionId")).alias("versionId"),
        F.lit(None).cast("string").alias("sourceBucketName"),
        F.lit(None).cast("string").alias("sourceFileName"),
        event_timestamp("eventTime").alias("timestamp"), "seq",
    )


# --- metadata messages ------------------------------------------------------------

def stamp_payload(df: DataFrame, payload: str, defaults: dict[str, Column], timestamp: Column) -> DataFrame:
    """Set the client's defaults and the timestamp in a MAP payload; both replace what was there."""
    fixed = F.create_map(*[
        x for name, value in {**defaults, "timestamp": timestamp}.items() for x in (F.lit(name), value)
    ])
    kept = F.map_filter(payload, lambda k, _: ~k.isin(*defaults, "timestamp"))
    return df.withColumn(payload, F.map_concat(kept, fixed))


def validate_payload(messages: DataFrame, metadata_type: str, payload: str = "payload") -> Outcome:
    """All required keys must be present in the JSON payload; a null value is present."""
    required = F.array(*[F.lit(k) for k in S.REQUIRED_KEYS[metadata_type]])
    missing = F.array_except(required, F.json_object_keys(payload))
    valid = F.coalesce(F.size(missing) == 0, F.lit(False))
    return Outcome(
        messages.where(valid),
        messages.where(~valid).withColumn("reason", F.lit("incorrect client payload structure")),
    )


def to_messages(df: DataFrame, metadata_type: str) -> DataFrame:
    """Typed rows as messages with a JSON ``payload`` (absent where null)."""
    fields = [c for c in df.columns if c != "seq"]
    return df.select(
        F.lit(metadata_type).alias("metadataType"), "documentId", "timestamp",
        F.to_json(F.struct(*fields)).alias("payload"), *[c for c in df.columns if c == "seq"],
    )


def fan_out_by_type(messages: DataFrame) -> dict[str, DataFrame]:
    """Messages of each consumer; prunes partitions on a table partitioned by the type."""
    return {
        kind: messages.where(F.col("metadataType") == kind)
        for kind in (S.REGISTRY, S.LINEAGE, S.OPERATIONS)
    }


def write_metadata_events(messages: DataFrame, path: str) -> None:
    """Append messages to the log, partitioned by type.

    Each task writes its own messages: one document, or the placeholder id of
    all deletes, may hold most rows, so nothing is brought together by key.
    """
    messages.write.mode("append").partitionBy("metadataType").parquet(path)


def unwrap_envelope(queue: DataFrame, schema: str, expected_source: str) -> Outcome:
    """Parse queue messages: check the source, parse ``body``, parse its ``Message`` text."""
    inner = F.get_json_object("body", "$.Message")
    parsed = queue.withColumn("_text", inner).withColumn("message", F.from_json("_text", schema))
    # a malformed message parses to a row of nulls, so test the text itself
    reason = (
        F.when(~F.col("eventSourceARN").eqNullSafe(expected_source), "unexpected event source")
        .when(F.try_parse_json("body").isNull(), "failed to parse message body")
        .when(F.try_parse_json("_text").isNull(), "failed to parse message payload")
    )
    judged = parsed.withColumn("reason", reason)
    return Outcome(
        judged.where(F.col("reason").isNull()).select("messageId", "message.*"),
        judged.where(F.col("reason").isNotNull()).select("messageId", "eventSourceARN", "body", "reason"),
    )


def lineage_messages(messages: DataFrame) -> DataFrame:
    """Lineage messages with their caller as a map, whichever form it arrived in."""
    return messages.withColumn("callerId", caller_map("callerId"))


def with_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add the parsed ``ts`` for watermarks; the text stays the key."""
    return df.withColumn("ts", message_time(column))


# --- change feed ----------------------------------------------------------------------

ATTRIBUTE = "STRUCT<S: STRING, N: STRING, BOOL: BOOLEAN, NULL: BOOLEAN, M: STRING, L: STRING>"
CHANGE = f"""
  eventName STRING,
  dynamodb STRUCT<NewImage: MAP<STRING, {ATTRIBUTE}>, SequenceNumber: STRING>
"""


def read_changes(df: DataFrame, column: str = "value") -> Outcome:
    """Change records (JSON text): event name, sequence number and the new image.

    ``new_image`` maps attribute names to values as text. Nested attributes
    stay JSON text, with their types; ``attribute_map`` reads a nested map.
    Text that is no JSON, or has no event name, is refused.
    """
    record = df.withColumn("c", F.from_json(column, CHANGE)).withColumn("reason", F.when(
        F.try_parse_json(column).isNull(), "failed to parse change record").when(
        F.col("c.eventName").isNull(), "no event name in change record"))
    plain = F.transform_values("c.dynamodb.NewImage", lambda _, v: F.coalesce(
        v["S"], v["N"], v["BOOL"].cast("string"), v["M"], v["L"]
    ))
    return Outcome(
        record.where(F.col("reason").isNull()).select(
            F.col("c.eventName").alias("eventName"),
            F.col("c.dynamodb.SequenceNumber").alias("SequenceNumber"), plain.alias("new_image")),
        record.where(F.col("reason").isNotNull()).drop("c"),
    )


def attribute_map(nested: Column) -> Column:
    """A nested map attribute (JSON text of typed values) as plain MAP<name, text>."""
    typed = F.from_json(nested, f"MAP<STRING, {ATTRIBUTE}>")
    return F.transform_values(typed, lambda _, v: F.coalesce(
        v["S"], v["N"], v["BOOL"].cast("string"), v["M"], v["L"]
    ))


def filter_changes(changes: DataFrame, kinds: list[str]) -> DataFrame:
    """Changes of the given kinds that carry a new image."""
    return changes.where(F.col("eventName").isin(kinds) & F.col("new_image").isNotNull())


# --- OCR notices ------------------------------------------------------------------------

def parse_ocr_notices(df: DataFrame, column: str = "value") -> Outcome:
    """Completion notices with ``ok``, ``message`` for a failed job, and which outputs it has.

    Text that is no JSON, or names no job or no document, is refused: it says
    nothing about any job.
    """
    parsed = df.withColumn("n", F.from_json(column, S.OCR_NOTICE)).withColumn("reason", F.when(
        F.try_parse_json(column).isNull(), "failed to parse notice").when(
        ~(present("n.JobId") & present("n.JobTag")), "no job or document in notice"))
    n = parsed.where(F.col("reason").isNull()).select(
        F.col("n.JobTag").alias("documentId"), F.col("n.JobId").alias("jobId"),
        F.col("n.DocumentLocation.S3Bucket").alias("bucketName"),
        F.col("n.DocumentLocation.S3ObjectName").alias("objectName"),
        F.coalesce(F.col("n.Status") != "FAILED", F.lit(True)).alias("ok"),
        F.coalesce(F.col("n.API") == S.ANALYSIS_API, F.lit(False)).alias("forms"),
        F.coalesce(F.col("n.API") == S.ANALYSIS_API, F.lit(False)).alias("tables"),
    )
    note = F.format_string(S.FAILED_ANALYSIS, "documentId", "bucketName", "objectName")
    return Outcome(n.withColumn("message", F.when(~F.col("ok"), note)), parsed.where(F.col("reason").isNotNull()).drop("n"))

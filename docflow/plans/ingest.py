"""Queries over object events: ingest, registry, classification, routing, lineage."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from docflow import schemas as S
from docflow import streaming
from docflow.functions import names
from docflow.functions.text import sorted_map_json
from docflow.operators import annotate, keyed, lineage, registry, routing, tracking
from docflow.plans import fixtures as fx
from docflow.plans.registry import query
from docflow.session import scratch_dir
from docflow.sources import catalog as cat
from docflow.sources import events as ev

# One document, as its id would be read from the registry.
SAMPLE_ID = hashlib.md5(b"src0|en/140.jpeg|v2|2024-01-01T00:02:20.000Z").hexdigest()

# Object events, straight from the table: one row per record.
EVENTS = """
WITH raw AS (
  SELECT doc_id, lang, source AS bucket,
    lang || '/' || doc_id || ['.pdf', '.jpg', '.jpeg', '.png', '.PDF', '.txt'][doc_id % 6 + 1] AS key,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'v' || (doc_id % 3) END AS version,
    'user-' || lang AS principal,
    ['internal_research_report', 'external_public_report', 'classified_report', 'unlisted'][doc_id % 4 + 1] AS class
  FROM documents
), timed AS (
  SELECT *, 'ObjectCreated:Put' AS name, 1704067200 + doc_id AS t FROM raw
  UNION ALL SELECT *, 'ObjectRemoved:Delete', 1704067200 + doc_id - 1000000 FROM raw WHERE doc_id % 11 = 0
  UNION ALL SELECT *, 'ObjectCreated:Copy', 1704067200 + doc_id + 5000000 FROM raw WHERE doc_id % 7 = 0
  UNION ALL SELECT *, 'ObjectRemoved:Delete', 1704067200 + doc_id + 10000000 FROM raw WHERE doc_id % 10 = 0
  UNION ALL SELECT *, 'ObjectRestore:Post', 1704067200 + doc_id + 20000000 FROM raw WHERE doc_id % 50 = 0
), texts AS (
  SELECT *, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%S.000Z') AS event_time,
    strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') || ' +0000 UTC' AS ts
  FROM timed
), oe AS (
  SELECT *, md5(bucket || '|' || key || '|' || version || '|' || event_time) AS id,
    CASE WHEN version = '' THEN NULL ELSE version END AS version_or_null,
    'BUCKET:' || bucket || '@FILE:' || key
      || CASE WHEN version = '' THEN '' ELSE '@VERSION:' || version END AS signature,
    regexp_extract(key, '(\\.[^./]*)$', 1) AS ext
  FROM texts
), created AS (SELECT * FROM oe WHERE name LIKE 'ObjectCreated%'),
eligible AS (SELECT * FROM created WHERE class IN ('internal_research_report', 'external_public_report'))
"""

# Deletes with the first document of their signature before them.
RESOLVED = EVENTS + """
, resolved AS (
  SELECT d.*, (SELECT min_by(c.id, c.ts) FROM created c WHERE c.signature = d.signature AND c.t < d.t) AS found
  FROM oe d WHERE d.name = 'ObjectRemoved:Delete'
), stored AS (
  SELECT id AS doc, ts, signature, bucket, key, name, version_or_null, principal FROM created
  UNION ALL
  SELECT found, ts, signature, bucket, key, name, version_or_null, principal FROM resolved WHERE found IS NOT NULL
)
"""


def _messages(spark, d):
    reg = ev.to_messages(fx.registry_events(spark, d), S.REGISTRY)
    lin = ev.to_messages(fx.lineage_events(spark, d), S.LINEAGE)
    return reg.unionByName(lin)


def _all_messages(spark, d):
    """Messages of all three types, without their order."""
    return _messages(spark, d).drop("seq").unionByName(ev.to_messages(fx.status_events(spark, d), S.OPERATIONS).drop("seq"))


def _named(messages):
    names = [F.get_json_object("payload", f"$.{n}") for n in ("documentName", "targetFileName", "objectName")]
    return messages.select("metadataType", "documentId", "timestamp", F.coalesce(*names).alias("name"), F.coalesce(
        F.get_json_object("payload", "$.s3Event"), F.get_json_object("payload", "$.stage")).alias("what"))


# --- sources -----------------------------------------------------------------------

@query("read_object_events", EVENTS + """
SELECT name AS "eventName", event_time AS "eventTime", bucket, key, version AS "versionId", principal AS "principalId", NULL::VARCHAR AS reason FROM oe
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, CASE doc_id % 3 WHEN 0 THEN 'failed to parse notification' ELSE 'no records in notification' END FROM raw""")
def read_object_events(spark, d):
    path = scratch_dir(spark, "notifications")
    fx.notifications(spark, d).select(F.to_json(F.struct("Records")).alias("value")).unionByName(
        fx.broken_lines(spark, d)).write.text(path)
    out = ev.read_object_events(spark, path)
    return out.accepted.select(
        "eventName", "eventTime", "bucket", "key", "versionId", "principalId", F.lit(None).cast("string").alias("reason")
    ).unionByName(out.rejected.select("reason"), allowMissingColumns=True)


def _queue(spark, d):
    """Registry messages in envelopes; each source, key shape and fault depends on the key."""
    n = fx.doc_number("documentName")
    message = ev.to_messages(
        fx.registry_events(spark, d).withColumn("n", n), S.REGISTRY
    ).withColumn("n", F.get_json_object("payload", "$.n").cast("bigint"))
    body = (
        F.when(F.col("n") % 17 == 0, F.lit("{not json"))
        .when(F.col("n") % 19 == 0, F.lit('{"Other":1}'))
        .otherwise(F.to_json(F.struct(F.col("payload").alias("Message"))))
    )
    return message.select(
        F.col("documentId").alias("messageId"),
        F.when(F.col("n") % 23 == 0, "arn:other").otherwise(fx.QUEUE).alias("eventSourceARN"),
        body.alias("body"),
    )


@query("unwrap_envelope", EVENTS + """
SELECT id AS "messageId", id AS "documentId", class, version_or_null AS "documentVersion", NULL::VARCHAR AS reason
FROM created WHERE doc_id % 17 <> 0 AND doc_id % 19 <> 0 AND doc_id % 23 <> 0
UNION ALL
SELECT id, NULL, NULL, NULL, CASE WHEN doc_id % 23 = 0 THEN 'unexpected event source'
  WHEN doc_id % 17 = 0 THEN 'failed to parse message body' ELSE 'failed to parse message payload' END
FROM created WHERE doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0""")
def unwrap_envelope(spark, d):
    out = ev.unwrap_envelope(_queue(spark, d), S.REGISTRY_MESSAGE, fx.QUEUE)
    none = F.lit(None).cast("string")
    return out.accepted.select(
        "messageId", "documentId", F.col("documentMetadata")["class"].alias("class"), "documentVersion",
        none.alias("reason"),
    ).unionByName(out.rejected.select(
        "messageId", none.alias("documentId"), none.alias("class"), none.alias("documentVersion"), "reason"))


def change_records(spark, d):
    """Registry inserts as change records with typed attributes; re-uploads count as MODIFY."""
    def s(c):
        return F.struct(F.col(c).alias("S"))

    nested = F.to_json(F.struct(F.struct(F.col("documentMetadata")["class"].alias("S")).alias("class")))
    image = F.concat(
        F.lit('{"documentId":'), F.to_json(s("documentId")), F.lit(',"bucketName":'), F.to_json(s("bucketName")),
        F.lit(',"documentName":'), F.to_json(s("documentName")),
        F.lit(',"size":{"N":"'), fx.doc_number("documentName").cast("string"),
        F.lit('"},"pinned":{"BOOL":true},"documentMetadata":{"M":'), nested, F.lit("}}"),
    )
    name = (F.when(fx.doc_number("documentName") % 29 == 0, "REMOVE")
            .when(F.col("seq.n") > 0, "MODIFY").otherwise("INSERT"))
    return fx.registry_events(spark, d).select(F.concat(
        F.lit('{"eventName":"'), name, F.lit('","dynamodb":{"SequenceNumber":"'), F.col("seq.eventTime"), F.lit('"'),
        F.when(name != "REMOVE", F.concat(F.lit(',"NewImage":'), image)).otherwise(""), F.lit("}}"),
    ).alias("value"))


CHANGES = EVENTS + """
, changes AS (
  SELECT *, CASE WHEN doc_id % 29 = 0 THEN 'REMOVE'
    WHEN name = 'ObjectCreated:Copy' OR doc_id % 11 = 0 THEN 'MODIFY' ELSE 'INSERT' END AS kind FROM created
)"""


@query("read_changes", CHANGES + """
SELECT NULL::VARCHAR AS reason, kind AS "eventName", event_time AS "SequenceNumber",
  CASE WHEN kind <> 'REMOVE' THEN id END AS "documentId",
  CASE WHEN kind <> 'REMOVE' THEN doc_id::VARCHAR END AS size,
  CASE WHEN kind <> 'REMOVE' THEN 'true' END AS pinned,
  CASE WHEN kind <> 'REMOVE' THEN class END AS class FROM changes
UNION ALL SELECT CASE WHEN doc_id % 2 = 0 THEN 'failed to parse change record' ELSE 'no event name in change record' END, NULL, NULL, NULL, NULL, NULL, NULL FROM raw""")
def readchange_records(spark, d):
    broken = fx.table(spark, d, "documents").select(fx.pick(["{broken", '{"dynamodb":{}}'], F.col("doc_id")).alias("value"))
    out = ev.read_changes(change_records(spark, d).unionByName(broken))
    return out.accepted.select(
        F.lit(None).cast("string").alias("reason"), "eventName", "SequenceNumber", F.col("new_image")["documentId"].alias("documentId"),
        F.col("new_image")["size"].alias("size"), F.col("new_image")["pinned"].alias("pinned"),
        ev.attribute_map(F.col("new_image")["documentMetadata"])["class"].alias("class"),
    ).unionByName(out.rejected.select("reason"), allowMissingColumns=True)


@query("filter_changes", CHANGES + """
SELECT kind AS "eventName", id AS "documentId", kind = 'INSERT' AS routed FROM changes WHERE kind <> 'REMOVE'""")
def filterchange_records(spark, d):
    c = ev.read_changes(change_records(spark, d)).accepted
    classified = ev.filter_changes(c, ["INSERT", "MODIFY"])
    return classified.select(
        "eventName", F.col("new_image")["documentId"].alias("documentId"), (F.col("eventName") == "INSERT").alias("routed"))


MESSAGES = EVENTS + """
SELECT 'document-registry' AS "metadataType", id AS "documentId", ts AS "timestamp", key AS name, NULL::VARCHAR AS what FROM created
UNION ALL
SELECT 'document-lineage', CASE WHEN name LIKE 'ObjectCreated%' THEN id ELSE 'UNKNOWN_YET' END, ts, key, name
FROM oe WHERE name <> 'ObjectRestore:Post'
UNION ALL
SELECT 'pipeline-operations', CASE WHEN event_id % 97 = 0 THEN 'unknown-' || event_id ELSE 'doc-' || user_id END,
  strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') || ' +0000 UTC', 'u/' || user_id || '.pdf',
  CASE event_type WHEN 'signup' THEN 'DOCUMENT_CLASSIFIER' WHEN 'view' THEN 'DOCUMENT_PROCESSOR' WHEN 'click' THEN 'SYNC_PROCESS_TEXTRACT'
    WHEN 'error' THEN 'ASYNC_PROCESS_TEXTRACT' WHEN 'purchase' THEN 'SYNC_PROCESS_COMPREHEND' END
FROM events e"""


@query("write_metadata_events", MESSAGES)
def write_metadata_events(spark, d):
    path = scratch_dir(spark, "metadata")
    ev.write_metadata_events(_all_messages(spark, d), path)
    return _named(spark.read.parquet(path))


@query("fan_out_by_type", MESSAGES)
def fan_out_by_type(spark, d):
    path = scratch_dir(spark, "metadata")
    ev.write_metadata_events(_all_messages(spark, d), path)
    # what each of the three consumers gets
    first, second, third = (_named(df) for df in ev.fan_out_by_type(spark.read.parquet(path)).values())
    return first.unionByName(second).unionByName(third)


# --- projections ---------------------------------------------------------------------

@query("route_object_events", EVENTS + """
SELECT id AS "documentId", name AS "eventName", CASE WHEN name = 'ObjectRemoved:Delete' THEN 'delete'
  WHEN name LIKE 'ObjectCreated%' THEN 'create' ELSE 'ignore' END AS action FROM oe""")
def route_object_events(spark, d):
    return fx.ingested_events(spark, d).select("documentId", "eventName", "action")


@query("assign_document_id", EVENTS + """
SELECT bucket, key, event_time AS "eventTime", id AS "documentId" FROM oe""")
def assign_document_id(spark, d):
    return fx.ingested_events(spark, d).select("bucket", "key", "eventTime", "documentId")


@query("document_link", EVENTS + """
SELECT id AS "documentId", 's3://' || bucket || '/' || key AS link FROM oe""")
def document_link(spark, d):
    return fx.object_events(spark, d).select("documentId", names.document_link("bucket", "key").alias("link"))


@query("build_registry_events", EVENTS + """
SELECT id AS "documentId", bucket AS "bucketName", key AS "documentName", 's3://' || bucket || '/' || key AS "documentLink",
  principal, 'CustomerName' AS owner, 'external_public_report' AS class, version_or_null AS "documentVersion", ts AS "timestamp"
FROM created""")
def build_registry_events(spark, d):
    return ev.build_registry_events(fx.object_events(spark, d)).select(
        "documentId", "bucketName", "documentName", "documentLink",
        F.col("principalIAMWriter")["principalId"].alias("principal"),
        F.col("documentMetadata")["owner"].alias("owner"), F.col("documentMetadata")["class"].alias("class"),
        "documentVersion", "timestamp")


@query("build_lineage_events", EVENTS + """
SELECT CASE WHEN name LIKE 'ObjectCreated%' THEN id ELSE 'UNKNOWN_YET' END AS "documentId", principal,
  bucket AS "targetBucketName", key AS "targetFileName", name AS "s3Event", version_or_null AS "versionId", ts AS "timestamp"
FROM oe WHERE name <> 'ObjectRestore:Post'""")
def build_lineage_events(spark, d):
    return fx.lineage_events(spark, d).select(
        "documentId", F.col("callerId")["principalId"].alias("principal"), "targetBucketName", "targetFileName",
        "s3Event", "versionId", "timestamp")


@query("validate_payload", EVENTS + """
SELECT id AS "documentId", CASE WHEN doc_id % 9 = 0 OR doc_id % 8 = 0 THEN 'incorrect client payload structure' END AS reason
FROM created""")
def validate_payload(spark, d):
    n = fx.doc_number("documentName")
    # every 9th lacks its link, every 8th is not JSON, every 5th has a null writer (which is present)
    rows = fx.registry_events(spark, d)
    payload = F.to_json(F.struct("documentId", "bucketName", "documentName", "documentLink", F.when(
        n % 5 != 0, F.col("principalIAMWriter")).alias("principalIAMWriter")), {"ignoreNullFields": "false"})
    messages = rows.select(
        "documentId",
        F.when(n % 8 == 0, "{broken").when(n % 9 == 0, F.regexp_replace(payload, '"documentLink"', '"link"'))
        .otherwise(payload).alias("payload"))
    out = ev.validate_payload(messages, S.REGISTRY)
    return out.accepted.select("documentId", F.lit(None).cast("string").alias("reason")).unionByName(
        out.rejected.select("documentId", "reason"))


@query("stamp_payload", EVENTS + """
SELECT id AS "documentId", '{"class":"external_public_report","name":"' || key || '","owner":"CustomerName","timestamp":"' || ts || '"}' AS payload
FROM created""")
def stamp_payload(spark, d):
    rows = fx.registry_events(spark, d).select("documentId", "timestamp", F.create_map(
        F.lit("name"), F.col("documentName"), F.lit("owner"), F.lit("sender"), F.lit("timestamp"), F.lit("old")).alias("payload"))
    defaults = {k: F.lit(v) for k, v in S.DEFAULT_METADATA.items()}
    return ev.stamp_payload(rows, "payload", defaults, F.col("timestamp")).select(
        "documentId", sorted_map_json("payload").alias("payload"))


@query("record_lineage", EVENTS + """
SELECT id AS "documentId", CASE WHEN doc_id % 2 = 0 THEN 'ObjectCreated:Put' ELSE name END AS recorded,
  'ObjectCreated:Copy' AS copied FROM created""")
def record_lineage(spark, d):
    rows = fx.object_events(spark, d).where("action = 'create'").select(
        "documentId", F.when(fx.doc_number("key") % 2 == 1, F.col("eventName")).alias("s3Event"))
    both = lineage.record_lineage(rows).withColumnRenamed("s3Event", "recorded").withColumn(
        "s3Event", F.col("recorded"))
    return lineage.record_lineage_of_copy(both).withColumnRenamed("s3Event", "copied")


@query("document_signature", EVENTS + """
SELECT id AS "documentId", signature FROM oe""")
def document_signature(spark, d):
    return fx.object_events(spark, d).select(
        "documentId", names.document_signature("bucket", "key", "versionId").alias("signature"))


@query("split_name_ext", EVENTS + """
SELECT id AS "documentId", doc_id::VARCHAR AS "fileName", ext AS extension FROM oe""")
def split_name_ext(spark, d):
    return routing.split_name_ext(fx.object_events(spark, d)).select("documentId", "fileName", "extension")


@query("output_paths", EVENTS + """
SELECT id AS "documentId", p AS page, key || '/ocr-analysis/page-' || p || '/response.json' AS "responsePath",
  key || '/ocr-analysis/page-' || p || '/text.txt' AS "textPath", key || '/ocr-analysis/page-' || p || '/forms.csv' AS "formsPath",
  key || '/ocr-analysis/page-' || p || '/tables.csv' AS "tablesPath", key || '/ocr-analysis/fullresponse.json' AS "fullResponsePath"
FROM created, (VALUES (1), (2)) v(p)""")
def output_paths(spark, d):
    from docflow.sources.outputs import output_paths as paths

    rows = fx.registry_events(spark, d).select(
        "documentId", F.col("documentName").alias("objectName"), F.explode(F.array(F.lit(1), F.lit(2))).alias("page"))
    return paths(rows).drop("objectName")


def _results(spark, d):
    """Result objects of created documents: the full response, and page files that are not one."""
    base = F.concat("documentId", F.lit("/"), "documentName", F.lit("/ocr-analysis/"))
    return fx.registry_events(spark, d).select(
        F.lit("ocr-results").alias("bucket"), F.col("documentId").alias("owner"),
        F.explode(F.array(F.concat(base, F.lit("fullresponse.json")), F.concat(base, F.lit("page-1/response.json")))).alias("key"))


@query("filter_full_responses", EVENTS + """
SELECT id || '/' || key || '/ocr-analysis/fullresponse.json' AS key FROM created""")
def filter_full_responses(spark, d):
    return annotate.filter_full_responses(_results(spark, d)).select("key")


@query("dissect_object_name", EVENTS + """
SELECT id || '/' || key || '/ocr-analysis/' || f AS key, id AS "documentId", key AS "documentName"
FROM created, (VALUES ('fullresponse.json'), ('page-1/response.json')) v(f)""")
def dissect_object_name(spark, d):
    return annotate.dissect_object_name(_results(spark, d)).select("key", "documentId", "documentName")


@query("check_tag_matches_path", EVENTS + """
SELECT id AS "documentId", CASE WHEN doc_id % 6 = 1 OR doc_id % 14 = 0 THEN 'path does not match the documentId tag' END AS reason
FROM created""")
def check_tag_matches_path(spark, d):
    full = annotate.dissect_object_name(annotate.filter_full_responses(_results(spark, d)))
    n = fx.doc_number("key")
    # every sixth object has a foreign tag, every 14th none
    owner = F.when(n % 14 != 0, F.when(n % 6 == 1, "someone-else").otherwise(F.col("documentId")))
    out = annotate.check_tag_matches_path(full, cat.document_tags(full.withColumn("documentId", owner)))
    return out.accepted.select("documentId", F.lit(None).cast("string").alias("reason")).unionByName(
        out.rejected.select("documentId", "reason"))


@query("parse_ocr_notices", EVENTS + """
SELECT id AS "documentId", 'job-' || doc_id AS "jobId", doc_id % 6 <> 1 AS ok, doc_id % 2 = 0 AS forms, doc_id % 2 = 0 AS tables,
  CASE WHEN doc_id % 6 = 1 THEN 'Textract job for document ID ' || id || '; bucketName ' || bucket || ' fileName ' || key
    || '; failed during Textract analysis. Please double check the document quality' END AS message, NULL::VARCHAR AS reason
FROM created
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN doc_id % 2 = 0 THEN 'failed to parse notice' ELSE 'no job or document in notice' END
FROM created WHERE doc_id % 5 = 0""")
def parse_ocr_notices(spark, d):
    n = fx.doc_number("documentName")
    notice = F.to_json(F.struct(
        F.concat(F.lit("job-"), n.cast("string")).alias("JobId"), F.col("documentId").alias("JobTag"),
        F.when(n % 6 == 1, "FAILED").otherwise("SUCCEEDED").alias("Status"),
        F.when(n % 2 == 0, S.ANALYSIS_API).otherwise("StartDocumentTextDetection").alias("API"),
        F.struct(F.col("bucketName").alias("S3Bucket"), F.col("documentName").alias("S3ObjectName")).alias("DocumentLocation")))
    broken = F.when(n % 2 == 0, F.expr("substr(value, 1, 20)")).otherwise('{"Status":"SUCCEEDED"}')
    values = fx.registry_events(spark, d).select("documentName", notice.alias("value"))
    out = ev.parse_ocr_notices(values.unionByName(values.where(n % 5 == 0).withColumn("value", broken)))
    return out.accepted.select(
        "documentId", "jobId", "ok", "forms", "tables", "message", F.lit(None).cast("string").alias("reason")
    ).unionByName(out.rejected.select("reason"), allowMissingColumns=True)


# --- registry and classification ------------------------------------------------------

@query("register_documents", EVENTS + """
, sent AS (SELECT id, ts, CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS n, doc_id % 12 = 0 AS stored FROM created)
SELECT id AS "documentId", (CASE WHEN stored THEN 0 ELSE 1 END)::BIGINT AS accepted,
  (n - CASE WHEN stored THEN 0 ELSE 1 END)::BIGINT AS rejected FROM sent""")
def register_documents(spark, d):
    events = fx.registry_events(spark, d)
    n = fx.doc_number("documentName")
    # every 4th message is sent twice; every 12th document is already stored
    again = events.where(n % 4 == 0).withColumn("seq", F.col("seq").withField("micros", F.col("seq.micros") + 1))
    stored = registry.register_documents(None, events.where(n % 12 == 0)).accepted
    out = registry.register_documents(stored, events.unionByName(again))
    both = out.accepted.select("documentId", F.lit(1).alias("a")).unionByName(
        out.rejected.select("documentId", F.lit(0).alias("a")))
    return both.groupBy("documentId").agg(F.sum("a").alias("accepted"), F.sum(1 - F.col("a")).alias("rejected"))


def _registry(spark, d):
    return registry.register_documents(None, fx.registry_events(spark, d)).accepted


@query("classify_documents", EVENTS + """
SELECT id AS "documentId", class, class IN ('internal_research_report', 'external_public_report') AS eligible,
  class = 'unlisted' AS eligible_by_rules FROM created""")
def classify_documents(spark, d):
    rules = {"unlisted": True, "classified_report": False}
    by_list = registry.classify_documents(fx.registry_events(spark, d)).accepted
    return registry.classify_documents(by_list.drop("class").withColumnRenamed("eligible", "by_list"), rules).accepted.select(
        "documentId", "class", F.col("by_list").alias("eligible"), F.col("eligible").alias("eligible_by_rules"))


@query("start_analysis_events", EVENTS + """
SELECT id AS "documentId", bucket AS "bucketName", key AS "objectName", 'DOCUMENT_CLASSIFIER' AS stage, step, status, init AS "initDoc"
FROM eligible, (VALUES (0, 'IN_PROGRESS', 'True'), (1, 'SUCCEEDED', NULL)) v(step, status, init)""")
def start_analysis_events(spark, d):
    return registry.start_analysis_events(registry.classify_documents(fx.registry_events(spark, d)).accepted)


@query("refused_documents", EVENTS + """
SELECT id AS "documentId", bucket AS "bucketName", key AS "documentName", class
FROM created WHERE class IN ('classified_report', 'unlisted')""")
def refused_documents(spark, d):
    return registry.refused_documents(_registry(spark, d))


# --- routing ----------------------------------------------------------------------------

def _tracked(spark, d):
    """Documents whose analysis starts."""
    return registry.classify_documents(fx.registry_events(spark, d)).accepted.where("eligible").select(
        "documentId", "bucketName", F.col("documentName").alias("objectName"), "timestamp")


@query("route_by_extension", EVENTS + """
SELECT id AS "documentId", ext AS extension, CASE WHEN ext IN ('.jpg', '.jpeg', '.png') THEN 'sync' WHEN ext = '.pdf' THEN 'async' END AS route,
  CASE WHEN ext IN ('.PDF', '.txt') THEN 'incorrect file extension' END AS reason FROM eligible""")
def route_by_extension(spark, d):
    out = routing.route_by_extension(_tracked(spark, d))
    none = F.lit(None).cast("string")
    return out.accepted.select("documentId", "extension", "route", none.alias("reason")).unionByName(
        out.rejected.select("documentId", "extension", none.alias("route"), "reason"))


COPIES = EVENTS + """
, copies AS (
  SELECT *, CASE WHEN ext = '.pdf' THEN 'async-ocr' ELSE 'sync-ocr' END AS target, id || '/' || key AS target_key
  FROM eligible WHERE ext IN ('.jpg', '.jpeg', '.png', '.pdf')
)"""


def _copies(spark, d):
    return routing.plan_copies(_tracked(spark, d), "sync-ocr", "async-ocr").accepted


@query("plan_copies", COPIES + """
SELECT id AS "documentId", bucket AS "sourceBucketName", target AS "targetBucketName", key AS "sourceFileName", target_key AS "targetFileName",
  'arn:router' AS "callerId", 'ObjectCreated:Copy' AS "s3Event" FROM copies""")
def plan_copies(spark, d):
    return routing.copy_lineage(_copies(spark, d), "arn:router")


def _copied_objects(spark, d, route):
    copied = _copies(spark, d).where(F.col("route") == route)
    return copied.select(F.col("targetBucketName").alias("bucket"), F.col("targetFileName").alias("key"), "documentId")


def _copied_catalog(objects):
    """Tags of copied objects; every 5th object has lost its tags."""
    tagged = objects.withColumn("documentId", F.when(fx.doc_number("key") % 5 != 0, F.col("documentId")))
    return cat.object_catalog(cat.document_tags(tagged))


@query("plan_ocr_jobs", COPIES + """
SELECT id AS "documentId", target AS "bucketName", target_key AS "objectName", id AS "jobTag", 'ocr-results' AS "outputBucket",
  target_key || '/textract-output' AS "outputPrefix", 'TABLES,FORMS' AS features, NULL::VARCHAR AS reason
FROM copies WHERE ext = '.pdf' AND doc_id % 5 <> 0
UNION ALL SELECT NULL, target, target_key, NULL, NULL, NULL, NULL,
  'Not able to start document analysis for document Id ; bucket ' || target || ' with name ' || target_key
FROM copies, (VALUES (1), (2)) twice WHERE ext = '.pdf' AND doc_id % 5 = 0
UNION ALL SELECT id, target, target_key, NULL, NULL, NULL, NULL, 'document already has a job'
FROM copies WHERE ext = '.pdf' AND doc_id % 5 <> 0""")
def plan_ocr_jobs(spark, d):
    objects = _copied_objects(spark, d, "async")
    requests = objects.drop("documentId")
    out = routing.plan_ocr_jobs(requests.unionByName(requests), _copied_catalog(objects), "ocr-results")
    jobs = out.accepted.select("documentId", "bucketName", "objectName", "jobTag", "outputBucket", "outputPrefix",
                               F.array_join("featureTypes", ",").alias("features"), F.lit(None).cast("string").alias("reason"))
    return jobs.unionByName(out.rejected, allowMissingColumns=True)


@query("sync_requests", COPIES + """
SELECT CASE WHEN doc_id % 5 <> 0 THEN id END AS "documentId", target AS "bucketName", target_key AS "objectName",
  CASE WHEN doc_id % 5 = 0 THEN 'Missing documentId, bucketName or objectName.' END AS reason
FROM copies WHERE ext <> '.pdf'""")
def sync_requests(spark, d):
    objects = _copied_objects(spark, d, "sync")
    out = routing.sync_requests(objects.drop("documentId"), _copied_catalog(objects))
    return out.accepted.drop("featureTypes").withColumn("reason", F.lit(None).cast("string")).unionByName(out.rejected)


@query("stage_lineage", COPIES + """
SELECT id AS "documentId", 'arn:ocr' AS "callerId", target AS "sourceBucketName", 'ocr-results' AS "targetBucketName",
  target_key AS "sourceFileName", target_key AS "targetFileName",
  CASE WHEN ext = '.pdf' THEN 'ObjectCreated:Put' ELSE 'ObjectCreated:Copy' END AS "s3Event" FROM copies
UNION ALL
SELECT id, 'arn:notes', 'ocr-results', 'notes', target_key || '/ocr-analysis/fullresponse.json',
  target_key || '/comprehend-output.json', 'ObjectCreated:Put' FROM copies""")
def stage_lineage(spark, d):
    copies = _copies(spark, d).select("documentId", F.col("targetBucketName").alias("bucketName"),
                                      F.col("targetFileName").alias("objectName"), "route")
    sync = lineage.stage_lineage(copies.where("route = 'sync'"), "ocr-results", "arn:ocr", copy=True)
    job = lineage.stage_lineage(copies.where("route = 'async'"), "ocr-results", "arn:ocr")
    full = copies.select("documentId", F.lit("ocr-results").alias("bucketName"),
                         names.full_response_path("objectName").alias("objectName"),
                         names.path_document_name("objectName").alias("name"))
    notes = lineage.stage_lineage(full, "notes", "arn:notes", target_name=names.annotation_path("documentId", "name"))
    return sync.unionByName(job).unionByName(notes)


@query("status_events", EVENTS + """
SELECT id AS "documentId", kind, stage, status, init AS "initDoc", message FROM eligible, (VALUES
  ('init', 'DOCUMENT_CLASSIFIER', 'IN_PROGRESS', 'True', NULL), ('in_progress', 'DOCUMENT_PROCESSOR', 'IN_PROGRESS', NULL, NULL),
  ('succeeded', 'SYNC_PROCESS_TEXTRACT', 'SUCCEEDED', NULL, NULL), ('failed', 'ASYNC_START_TEXTRACT', 'FAILED', NULL, 'no job')
) v(kind, stage, status, init, message)""")
def status_events(spark, d):
    docs = _tracked(spark, d)
    made = [
        tracking.status_events(docs, stage, kind, message).withColumn("kind", F.lit(kind))
        for stage, kind, message in (
            (S.STAGE_CLASSIFIER, "init", None), (S.STAGE_PROCESSOR, "in_progress", ""),
            (S.STAGE_SYNC_OCR, "succeeded", None), (S.STAGE_ASYNC_START, "failed", "no job"))
    ]
    union = made[0]
    for more in made[1:]:
        union = union.unionByName(more)
    return union.select("documentId", "kind", "stage", "status", "initDoc", "message")


@query("stage_status", EVENTS + """
SELECT id AS "documentId", 'ASYNC_START_TEXTRACT' AS stage, step, CASE WHEN step = 0 THEN 'IN_PROGRESS' WHEN ext = '.pdf' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
  CASE WHEN step = 1 AND ext <> '.pdf' THEN 'Not able to start document analysis for document Id ' || id || '; bucket ' || bucket || ' with name ' || key END AS message
FROM eligible, (VALUES (0), (1)) v(step)""")
def stage_status(spark, d):
    docs = _tracked(spark, d)
    note = F.format_string(S.FAILED_START, "documentId", "bucketName", "objectName")
    return tracking.stage_status(docs, S.STAGE_ASYNC_START, names.extension("objectName") == ".pdf", note).select(
        "documentId", "stage", "step", "status", "message")


# --- catalog ------------------------------------------------------------------------------

@query("object_catalog", EVENTS + """
SELECT bucket, key, CASE WHEN doc_id % 13 = 0 THEN '{}' ELSE '{"documentId":"' || id || '"}' END AS tags
FROM created WHERE name = 'ObjectCreated:Put'""")
def object_catalog(spark, d):
    return cat.object_catalog(fx.catalog(spark, d)).select("bucket", "key", F.to_json("tags").alias("tags"))


@query("list_objects", EVENTS + """
SELECT bucket, key FROM created WHERE name = 'ObjectCreated:Put' AND bucket = 'src1' AND key LIKE 'en/%'""")
def list_objects(spark, d):
    return cat.list_objects(cat.object_catalog(fx.catalog(spark, d)), "src1", "en/").select("bucket", "key")


@query("ingested_tags", EVENTS + """
SELECT bucket, key, '{"documentId":"' || id || '"}' AS tags FROM created""")
def ingested_tags(spark, d):
    return cat.ingested_tags(fx.object_events(spark, d)).select("bucket", "key", F.to_json("tags").alias("tags"))


@query("put_tags", EVENTS + """
SELECT bucket, key, CASE WHEN doc_id % 7 = 0 THEN '{"documentId":"' || (SELECT id FROM created c2 WHERE c2.doc_id = created.doc_id AND c2.name = 'ObjectCreated:Copy') || '"}'
  WHEN doc_id % 13 = 0 THEN '{}' ELSE '{"documentId":"' || id || '"}' END AS tags
FROM created WHERE name = 'ObjectCreated:Put'""")
def put_tags(spark, d):
    # a re-upload replaces the tags; the first upload's tags are put again and must lose
    events = fx.object_events(spark, d).where("action = 'create'")
    again = events.where("eventName = 'ObjectCreated:Copy'").select("bucket", "key")
    tags = events.join(again, ["bucket", "key"], "left_semi").select(
        "bucket", "key", F.create_map(F.lit("documentId"), F.col("documentId")).alias("tags"), "seq")
    return cat.put_tags(cat.object_catalog(fx.catalog(spark, d)), tags).select("bucket", "key", F.to_json("tags").alias("tags"))


@query("get_tags", EVENTS + """
SELECT bucket, key, CASE WHEN doc_id % 13 = 0 THEN '{}' ELSE '{"documentId":"' || id || '"}' END AS tags
FROM created WHERE name = 'ObjectCreated:Put'
UNION ALL SELECT bucket, 'absent/' || key, NULL FROM created WHERE name = 'ObjectCreated:Copy'""")
def get_tags(spark, d):
    events = fx.object_events(spark, d).where("action = 'create'")
    keys = events.select("bucket", F.when(F.col("eventName") == "ObjectCreated:Copy", F.concat(F.lit("absent/"), "key"))
                         .otherwise(F.col("key")).alias("key"))
    return cat.get_tags(cat.object_catalog(fx.catalog(spark, d)), keys).select("bucket", "key", F.to_json("tags").alias("tags"))


# --- lineage -------------------------------------------------------------------------------

@query("resolve_deleted_ids", RESOLVED + """
SELECT signature, ts AS "timestamp", found AS "documentId", CASE WHEN found IS NULL THEN 'no earlier document with this signature' END AS reason FROM resolved""")
def resolve_deleted_ids(spark, d):
    out = lineage.resolve_deleted_ids(None, fx.lineage_events(spark, d))
    deleted = out.accepted.where(F.col("s3Event") == S.EVENT_DELETE)
    return deleted.withColumn("reason", F.lit(None).cast("string")).unionByName(out.rejected).select(
        F.col("documentSignature").alias("signature"), "timestamp", "documentId", "reason")


def _lineage(spark, d):
    resolved = lineage.resolve_deleted_ids(None, fx.lineage_events(spark, d)).accepted
    return lineage.append_lineage(None, resolved)


@query("append_lineage", RESOLVED + """
SELECT doc AS "documentId", ts AS "timestamp", signature, bucket AS "targetBucketName", key AS "targetFileName", name AS "s3Event",
  version_or_null AS "versionId", principal FROM stored""")
def append_lineage(spark, d):
    table = _lineage(spark, d)
    # putting the same messages again changes nothing
    return lineage.append_lineage(table, table).select(
        "documentId", "timestamp", F.col("documentSignature").alias("signature"), "targetBucketName", "targetFileName",
        "s3Event", "versionId", F.col("callerId")["principalId"].alias("principal"))


@query("lineage_of", RESOLVED + """
SELECT doc AS "documentId", ts AS "timestamp", name AS "s3Event", signature
FROM stored WHERE doc = md5('src0|en/140.jpeg|v2|2024-01-01T00:02:20.000Z')""")
def lineage_of(spark, d):
    return lineage.lineage_of(_lineage(spark, d), SAMPLE_ID).select(
        "documentId", "timestamp", "s3Event", F.col("documentSignature").alias("signature"))


@query("lineage_edges", COPIES + """
SELECT id AS "documentId", bucket AS "sourceBucketName", key AS "sourceFileName", target AS "targetBucketName", target_key AS "targetFileName" FROM copies""")
def lineage_edges(spark, d):
    copies = routing.copy_lineage(_copies(spark, d), "arn:router").withColumn(
        "versionId", F.lit(None).cast("string")).withColumn("timestamp", F.lit("2024-06-01 00:00:00 +0000 UTC")).withColumn(
        "seq", F.struct(F.col("targetFileName").alias("eventTime")))
    # events that are no copies lose their sources and so have no edge
    puts = copies.withColumn("s3Event", F.lit(S.EVENT_PUT)).withColumn("documentId", F.concat("documentId", F.lit("-put")))
    return lineage.lineage_edges(lineage.append_lineage(None, copies.unionByName(puts))).drop("timestamp")


# --- change feed and refused rows --------------------------------------------------------------

@query("change_feed", EVENTS + """
, snap AS (SELECT id, class, doc_id, doc_id % 3 <> 0 AS was, doc_id % 5 <> 0 AS is_now, doc_id % 4 = 0 AS altered FROM created)
SELECT id AS "documentId", CASE WHEN NOT was THEN 'INSERT' WHEN NOT is_now THEN 'REMOVE' ELSE 'MODIFY' END AS "eventName",
  CASE WHEN is_now THEN CASE WHEN altered THEN 'other' ELSE class END END AS class
FROM snap WHERE (was AND NOT is_now) OR (is_now AND NOT was) OR (was AND is_now AND altered)""")
def change_feed(spark, d):
    reg = fx.registry_events(spark, d).select(
        "documentId", F.col("documentMetadata")["class"].alias("class"), fx.doc_number("documentName").alias("n"))
    old = reg.where("n % 3 <> 0").drop("n")
    new = reg.where("n % 5 <> 0").withColumn("class", F.when(F.col("n") % 4 == 0, "other").otherwise(F.col("class"))).drop("n")
    return streaming.change_feed(old, new).select("documentId", "eventName", "new_image.class")


@query("replay_rejected", EVENTS + """
SELECT id AS "documentId" FROM created WHERE doc_id % 2 = 0""")
def replay_rejected(spark, d):
    # refused because already registered; accepted by an empty registry on replay
    events = fx.registry_events(spark, d)
    stored = registry.register_documents(None, events.where(fx.doc_number("documentName") % 2 == 0)).accepted
    refused = registry.register_documents(stored, events).rejected
    return registry.register_documents(None, streaming.replay_rejected(refused)).accepted.select("documentId")


# --- keyed items --------------------------------------------------------------------------------

@query("items_by_key", EVENTS + """
SELECT bucket AS "bucketName", id AS "documentId", ts AS "timestamp" FROM created WHERE bucket = 'src3'""")
def items_by_key(spark, d):
    return keyed.items_by_key(_registry(spark, d), "bucketName", "src3", ["documentId", "timestamp"])


@query("upsert_items", EVENTS + """
SELECT id AS "documentId", CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE class END AS class FROM created""")
def upsert_items(spark, d):
    items = fx.registry_events(spark, d).select(
        "documentId", F.col("documentMetadata")["class"].alias("class"), fx.doc_number("documentName").alias("n"))
    puts = items.where("n % 3 = 0")
    rows = puts.withColumn("class", F.lit("stale")).withColumn("at", F.lit(1)).unionByName(
        puts.withColumn("class", F.lit("new")).withColumn("at", F.lit(2)))
    return keyed.upsert_items(items.drop("n"), rows.drop("n"), ["documentId"], "at")


@query("delete_documents", EVENTS + """
SELECT id AS "documentId" FROM created WHERE doc_id % 3 <> 0""")
def delete_documents(spark, d):
    reg = _registry(spark, d)
    ids = fx.registry_events(spark, d).where(fx.doc_number("documentName") % 3 == 0).select("documentId")
    return keyed.delete_documents(reg, ids).select("documentId")


# --- from object events to document state -----------------------------------------------------------

@query("document_status", EVENTS + """
SELECT id AS "documentId", bucket AS "bucketName", key AS "objectName", 'DOCUMENT_PROCESSOR' AS "documentStage",
  CASE WHEN ext IN ('.pdf', '.jpg', '.jpeg', '.png') THEN 'SUCCEEDED' ELSE 'IN_PROGRESS' END AS "documentStatus",
  CASE WHEN ext IN ('.pdf', '.jpg', '.jpeg', '.png') THEN 4 ELSE 3 END::BIGINT AS entries FROM eligible""")
def document_status(spark, d):
    """Register, classify, start, route and copy every document, then fold its status events."""
    classified = registry.classify_documents(_registry(spark, d)).accepted
    started = registry.start_analysis_events(classified).withColumn("seq", F.col("step").cast("bigint"))
    documents = classified.where("eligible").select(
        "documentId", "bucketName", F.col("documentName").alias("objectName"))
    routed = routing.plan_copies(documents, "sync-ocr", "async-ocr")
    # an object without a route stays in progress
    copied = tracking.stage_status(routed.accepted, S.STAGE_PROCESSOR, F.lit(True))
    stuck = tracking.stage_status(routed.rejected, S.STAGE_PROCESSOR, F.lit(False)).where("step = 0")
    stages = copied.unionByName(stuck, allowMissingColumns=True).withColumn("seq", 2 + F.col("step").cast("bigint"))
    columns = ["documentId", "bucketName", "objectName", "status", "stage", "initDoc", "message", "versionId", "timestamp", "seq"]
    none = F.lit(None).cast("string")
    events = started.unionByName(stages, allowMissingColumns=True).select(
        *[F.col(c) if c not in ("versionId", "timestamp") else (none if c == "versionId" else F.col("seq").cast("string")).alias(c)
          for c in columns])
    out = tracking.fold_status_events(events)
    entries = out.timeline.groupBy("documentId").agg(F.count(F.lit(1)).alias("entries"))
    return out.operations.join(entries, "documentId").select(
        "documentId", "bucketName", "objectName", "documentStage", "documentStatus", "entries")

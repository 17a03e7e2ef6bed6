import json

from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.operators import Outcome
from docflow.sources import catalog as cat
from docflow.sources import events as ev


def notification(*records):
    return {"Records": [
        {"eventName": n, "eventSource": "aws:s3", "eventTime": t, "userIdentity": {"principalId": "p"},
         "s3": {"bucket": {"name": "b"}, "object": {"key": k, "versionId": v}}} for n, t, k, v in records]}


def test_ingest_from_files(spark, tmp_path):
    (tmp_path / "n.json").write_text("\n".join(json.dumps(n) for n in [
        notification(("ObjectCreated:Put", "2024-01-01T00:00:00.000Z", "a.pdf", ""),
                     ("ObjectRemoved:Delete", "2024-01-02T00:00:00.000Z", "a.pdf", "v2")),
        notification(("ObjectRemoved:DeleteMarkerCreated", "2024-01-03T00:00:00.000Z", "a%20b.pdf", "")),
    ]))
    events = ev.assign_document_id(ev.route_object_events(ev.read_object_events(spark, str(tmp_path)).accepted))
    assert [r.action for r in events.orderBy("eventTime").collect()] == ["create", "delete", "ignore"]
    reg = ev.build_registry_events(events).collect()
    assert len(reg) == 1 and reg[0].documentVersion is None and reg[0].documentLink == "s3://b/a.pdf"
    assert reg[0].documentMetadata == S.DEFAULT_METADATA and reg[0].timestamp == "2024-01-01 00:00:00 +0000 UTC"
    lin = ev.build_lineage_events(events).orderBy("timestamp").collect()
    assert [r.documentId for r in lin] == [reg[0].documentId, "UNKNOWN_YET"] and lin[1].versionId == "v2"


def test_decode_keys_is_optional(spark):
    df = spark.createDataFrame([(json.dumps(notification(("ObjectCreated:Put", "2024-01-01T00:00:00Z", "a%20b", ""))),)], "v STRING")
    parsed = df.select(F.from_json("v", S.NOTIFICATION).alias("n")).select("n.*")
    assert ev.flatten_notifications(parsed).first().key == "a%20b"
    assert ev.flatten_notifications(parsed, decode_keys=True).first().key == "a b"


def test_envelope_faults(spark):
    good = json.dumps({"Message": json.dumps({"documentId": "d", "status": "FAILED"})})
    rows = [("1", "q", good), ("2", "other", good), ("3", "q", "{"), ("4", "q", "{}"), ("5", "q", '{"Message":"{"}'), ("6", "q", None)]
    out = ev.unwrap_envelope(spark.createDataFrame(rows, S.QUEUE_MESSAGE), S.STATUS_MESSAGE, "q")
    assert [(r.messageId, r.documentId, r.status) for r in out.accepted.collect()] == [("1", "d", "FAILED")]
    assert {r.messageId: r.reason for r in out.rejected.collect()} == {
        "2": "unexpected event source", "3": "failed to parse message body", "4": "failed to parse message payload",
        "5": "failed to parse message payload", "6": "failed to parse message body"}


def test_required_keys_may_be_null_but_not_absent(spark):
    keys = {k: None for k in S.REQUIRED_KEYS[S.OPERATIONS]}
    lacking = {k: 1 for k in S.REQUIRED_KEYS[S.OPERATIONS][1:]}
    rows = [("null", json.dumps(keys)), ("lacking", json.dumps(lacking)), ("broken", "{"), ("none", None)]
    out: Outcome = ev.validate_payload(spark.createDataFrame(rows, "id STRING, payload STRING"), S.OPERATIONS)
    assert [r.id for r in out.accepted.collect()] == ["null"]
    assert out.rejected.count() == 3


def test_stamp_replaces_sender_values(spark):
    df = spark.createDataFrame([({"owner": "me", "timestamp": "old", "x": "1"},)], "payload MAP<STRING,STRING>")
    got = ev.stamp_payload(df, "payload", {"owner": F.lit("them")}, F.lit("now")).first().payload
    assert got == {"owner": "them", "timestamp": "now", "x": "1"}


def test_changes(spark):
    record = {"eventName": "INSERT", "dynamodb": {"SequenceNumber": "7", "NewImage": {
        "documentId": {"S": "d"}, "n": {"N": "3"}, "flag": {"BOOL": False}, "meta": {"M": {"class": {"S": "c"}}}}}}
    bare = {"eventName": "MODIFY", "dynamodb": {"SequenceNumber": "8"}}
    df = spark.createDataFrame([(json.dumps(r),) for r in (record, bare)], "value STRING")
    out = ev.read_changes(df.union(spark.createDataFrame([('{',), ('{}',), (None,)], "value STRING")))
    assert out.rejected.count() == 3
    changes = out.accepted
    row = ev.filter_changes(changes, ["INSERT", "MODIFY"]).collect()
    assert len(row) == 1 and row[0].new_image["documentId"] == "d" and row[0].new_image["flag"] == "false"
    meta = changes.where("eventName = 'INSERT'").select(ev.attribute_map(F.col("new_image")["meta"]).alias("m")).first().m
    assert meta == {"class": "c"}


def test_notices(spark):
    def notice(status, api):
        return (json.dumps({"JobId": "j", "JobTag": "d", "Status": status, "API": api,
                            "DocumentLocation": {"S3Bucket": "b", "S3ObjectName": "o"}}),)

    df = spark.createDataFrame([notice("FAILED", S.ANALYSIS_API), notice("SUCCEEDED", "Other")], "value STRING")
    bad = spark.createDataFrame([("{broken",), ("{}",), (None,), ('{"JobId":"j","Status":"SUCCEEDED"}',)], "value STRING")
    out = ev.parse_ocr_notices(df.union(bad))
    assert out.rejected.count() == 4
    failed, fine = out.accepted.orderBy("ok").collect()
    assert not failed.ok and failed.message.startswith("Textract job for document ID d; bucketName b fileName o;")
    assert fine.ok and not fine.forms and fine.message is None


def test_metadata_log_is_partitioned_by_type(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(S.REGISTRY, "d1", "t", "{}"), (S.LINEAGE, "d1", "t", "{}")]
    messages = spark.createDataFrame(rows, "metadataType STRING, documentId STRING, timestamp STRING, payload STRING")
    ev.write_metadata_events(messages, path)
    ev.write_metadata_events(messages, path)
    lineage = ev.fan_out_by_type(spark.read.parquet(path))[S.LINEAGE]
    assert lineage.count() == 2
    assert "PartitionFilters: [isnotnull(metadataType" in lineage._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_catalog(spark):
    catalog = cat.object_catalog(spark.createDataFrame(
        [("b", "x/2", None), ("b", "x/1", {"a": "1"}), ("c", "x/1", None)], "bucket STRING, key STRING, tags MAP<STRING,STRING>"))
    assert [r.key for r in cat.list_objects(catalog, "b", "x/").collect()] == ["x/1", "x/2"]
    puts = spark.createDataFrame([("b", "x/1", {"b": "2"}, 2), ("b", "x/1", {"b": "1"}, 1)],
                                 "bucket STRING, key STRING, tags MAP<STRING,STRING>, seq INT")
    tagged = cat.put_tags(catalog, puts)
    asked = spark.createDataFrame([("b", "x/1"), ("b", "gone")], "bucket STRING, key STRING")
    assert {r.key: r.tags for r in cat.get_tags(tagged, asked).collect()} == {"x/1": {"b": "2"}, "gone": None}

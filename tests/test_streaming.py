import random

from pyspark.sql import functions as F

from docflow import streaming
from docflow.operators import lineage, registry, tracking
from test_state import LINEAGE, STATUS, lineage_row, status


def files(spark, rows, schema, folder, cuts):
    """Append the rows as one file per cut."""
    for n, part in enumerate(cuts):
        spark.createDataFrame(rows[part], schema).coalesce(1).write.mode("append").parquet(folder)


def run(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()


def source(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_tracking_over_files_and_restarts_equals_the_batch_fold(spark, tmp_path):
    rng = random.Random(2)
    rows = [status(f"d{rng.randrange(8)}", i, rng.choice(["FAILED", "SUCCEEDED"]), "True" if rng.random() < 0.3 else None)
            for i in range(90)]
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    for start in (0, 30, 60):
        files(spark, rows, STATUS, folder, [slice(start, start + 15), slice(start + 15, start + 30)])
        run(streaming.stream_tracking(source(spark, STATUS, folder), table, check))
    want = tracking.fold_status_events(spark.createDataFrame(rows, STATUS)).operations
    got = streaming.tracked_operations(spark, table)
    assert sorted(got.collect()) == sorted(want.collect())


def test_registry_and_lineage_equal_the_batch_result(spark, tmp_path):
    rows = [lineage_row("a", 1, time="t0005"), lineage_row("UNKNOWN_YET", 2, "ObjectRemoved:Delete"),
            lineage_row("b", 3, time="t0001"), lineage_row("UNKNOWN_YET", 4, "ObjectRemoved:Delete"),
            lineage_row("UNKNOWN_YET", 5, "ObjectRemoved:Delete", name="unseen"), lineage_row("c", 6, name="unseen")]
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    files(spark, rows, LINEAGE, folder, [slice(0, 2), slice(2, 3), slice(3, 6)])
    run(streaming.stream_lineage(source(spark, LINEAGE, folder), table, check))
    events = spark.createDataFrame(rows, LINEAGE)
    want = lineage.append_lineage(None, lineage.resolve_deleted_ids(None, events).accepted)
    got = streaming.stored_lineage(spark, table).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    check, table = str(tmp_path / "c2"), str(tmp_path / "t2")
    creates = events.where("documentId <> 'UNKNOWN_YET'")
    again = creates.withColumn("seq", F.col("seq") + 100).withColumn("callerId", F.lit("later"))
    folder = str(tmp_path / "in2")
    creates.coalesce(1).write.parquet(folder)
    again.coalesce(1).write.mode("append").parquet(folder)
    run(streaming.stream_registry(source(spark, LINEAGE, folder), table, check))
    stored = streaming.registered_documents(spark, table)
    assert sorted(stored.collect()) == sorted(registry.register_documents(None, creates).accepted.collect())
    compacted = str(tmp_path / "compacted")
    streaming.compact(stored, f"{compacted}/documents")
    assert streaming.registered_documents(spark, compacted).count() == 3


def test_dedupe_counts_the_timestamp_as_content(spark):
    rows = [("d", "t1"), ("d", "t1"), ("d", "t2")]
    df = spark.createDataFrame(rows, "documentId STRING, timestamp STRING").withColumn("ts", F.current_timestamp())
    assert streaming.dedupe_messages(df, ["documentId", "timestamp"], "1 hour").count() == 2


def test_change_feed(spark):
    schema = "documentId STRING, v INT, m MAP<STRING,STRING>"
    old = spark.createDataFrame([("a", 1, {"x": "1"}), ("b", None, None), ("c", 3, None)], schema)
    new = spark.createDataFrame([("a", 1, {"x": "2"}), ("b", None, None), ("d", 4, None)], schema)
    got = {r.documentId: (r.eventName, r.new_image.v if r.new_image else None) for r in streaming.change_feed(old, new).collect()}
    assert got == {"a": ("MODIFY", 1), "c": ("REMOVE", None), "d": ("INSERT", 4)}
    assert streaming.read_batches(spark, "/nonexistent/folder") is None

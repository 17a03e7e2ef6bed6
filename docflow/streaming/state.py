"""Tracking with keyed state: items, finished documents and a summary kept by changes.

The state of a document is one narrow row: its first init and its last update.
A batch gives the documents it changed as they are now, together with the stage and
status they had before, so that a count per stage and status can be kept by
taking the old one away and adding the new one. With ``keep`` a document that
finished leaves the state that long after its last message. What a document
gave before that is stored, and readers merge by the order of messages, so a late
message changes the item as it would have without the drop.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from docflow import schemas as S
from docflow.operators import tracking
from docflow.streaming.batches import finish_batch, read_batches, write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INIT = ["seq", "bucketName", "objectName", "status", "stage", "timestamp", "versionId"]
LAST = ["seq", "status", "stage", "timestamp"]
STATE = [f"init_{c}" for c in INIT] + [f"last_{c}" for c in LAST]
KINDS = ", ".join(f"{c} {'BIGINT' if c.endswith('seq') else 'STRING'}" for c in STATE)
GIVEN = f"documentId STRING, {KINDS}, oldStage STRING, oldStatus STRING, newStage STRING, newStatus STRING"


GIVEN_ROW = Row(*[c.split()[0] for c in GIVEN.split(", ")])
FINISHED = (S.STAGE_ANNOTATE, S.SUCCEEDED)


def _current(state: list) -> tuple:
    """Stage and status from a state; none before the first init."""
    n = len(INIT)
    if state[0] is None:
        return None, None
    if state[n] is not None and state[n] > state[0]:
        return state[n + LAST.index("stage")], state[n + LAST.index("status")]
    return state[INIT.index("stage")], state[INIT.index("status")]


class KeepState(StatefulProcessor):
    """First init and last update of each document; messages may come in any order and in many pieces."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", KINDS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # every call of the state or of a timer goes to the JVM and back, so none is made that changes nothing
        old, n = self.state.get(), len(INIT)
        state = [None] * len(STATE) if old is None else list(old)
        before = _current(state)
        first = last = None  # of rows with the same seq the one that came first
        for row in rows:
            seq = row.seq
            if seq is None:
                continue
            if row.initDoc == "True":
                if (state[0] if first is None else first.seq) is None or seq < (state[0] if first is None else first.seq):
                    first = row
            elif (state[n] if last is None else last.seq) is None or seq > (state[n] if last is None else last.seq):
                last = row
        if first is not None:
            state[:n] = [first[c] for c in INIT]
        if last is not None:
            state[n:] = [last[c] for c in LAST]
        if old is None or first is not None or last is not None:
            self.state.update(tuple(state))
        after = _current(state)
        if self.keep_ms is not None:
            if before == FINISHED:  # only then a timer runs
                for due in list(self.handle.listTimers()):
                    self.handle.deleteTimer(due)
            if after == FINISHED:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        yield GIVEN_ROW(key[0], *state, *before, *after)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def states(events: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """Per batch the documents it changed: their state, and stage and status before and after."""
    # the state store that holds more than memory does; a stream keeps the one it began with
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if keep_ms is not None:
        # timers go off in the next batch of messages: without this a stream that runs until its
        # input is used up would go on with empty batches for ever, waiting for timers
        events.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    columns = list(dict.fromkeys(["documentId", "initDoc", *INIT, *LAST]))
    return events.select(*columns).groupBy("documentId").transformWithState(
        KeepState(keep_ms), outputStructType=GIVEN, outputMode="Update",
        timeMode="None" if keep_ms is None else "ProcessingTime")


def changed_counts(given: DataFrame) -> DataFrame:
    """``(documentStage, documentStatus, documents)``: by how many documents each count changes."""
    def side(prefix, by):
        return F.struct(F.col(f"{prefix}Stage").alias("documentStage"), F.col(f"{prefix}Status").alias("documentStatus"), F.lit(by).alias("by"))

    moves = F.filter(F.array(side("old", -1), side("new", 1)), lambda m: m["documentStatus"].isNotNull())
    # null stages count as a group of their own, as they do in the summary
    return given.select(F.inline(moves)).groupBy("documentStage", "documentStatus").agg(
        F.sum("by").cast("bigint").alias("documents")).where("documents <> 0")


def stream_states(events: DataFrame, path: str, checkpoint: str, keep_ms: int | None = None) -> DataStreamWriter:
    """Store per batch the states it changed, the documents that finished, and how the summary changes.

    With ``keep_ms`` the state forgets finished documents and cannot tell what a
    late message changes, so no summary is stored.
    """
    def put(df: DataFrame, n: int) -> None:
        given = df.persist()
        write_batch(given.drop("oldStage", "oldStatus", "newStage", "newStatus"), f"{path}/states", n)
        done = (F.col("newStage") == S.STAGE_ANNOTATE) & (F.col("newStatus") == S.SUCCEEDED)
        was = F.coalesce((F.col("oldStage") == S.STAGE_ANNOTATE) & (F.col("oldStatus") == S.SUCCEEDED), F.lit(False))
        write_batch(given.where(done & ~was).select("documentId", F.coalesce("last_timestamp", "init_timestamp").alias("timestamp")), f"{path}/finished", n)
        if keep_ms is None:
            write_batch(changed_counts(given), f"{path}/summary", n)
        finish_batch(df.sparkSession, path, n)
        given.unpersist()

    return states(events, keep_ms).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)


def state_operations(spark: SparkSession, path: str) -> DataFrame:
    """Operations items as of the last finished batch."""
    stored = read_batches(spark, path, "states")
    init = F.struct(*[F.col(f"init_{c}").alias(c) for c in INIT])
    last = F.struct(*[F.col(f"last_{c}").alias(c) for c in LAST])
    return tracking.state_items(stored.groupBy("documentId").agg(
        F.min_by(init, "init_seq").alias("init"), F.max_by(last, "last_seq").alias("last")))


def kept_summary(spark: SparkSession, path: str) -> DataFrame:
    """Documents by stage and status as of the last finished batch: a sum of few rows for each batch."""
    changes = read_batches(spark, path, "summary")
    return changes.groupBy("documentStage", "documentStatus").agg(F.sum("documents").alias("documents")).where("documents <> 0")


def finished_stream(spark: SparkSession, path: str) -> DataFrame:
    """``(documentId, timestamp, batch)`` for each time a document finished."""
    return read_batches(spark, path, "finished")

"""Pipeline state and timeline of each document.

The state is one narrow row per document, folded by aggregates that combine
before the shuffle. The timeline stays a table of rows, so a document with very
many events is never gathered into one row; ``operations_items`` adds the
timeline as one list, or as lists of a length that the caller chooses.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.operators import Outcome
from docflow.operators.ordered import collect_in_order, earliest_by_key, ordinal

TIMELINE = ["documentId", "seq", "timestamp", "stage", "status", "message"]
OPERATIONS = [
    "documentId", "bucketName", "objectName", "documentStatus", "documentStage",
    "lastUpdate", "documentVersion",
]


class Tracked(NamedTuple):
    """Pipeline operations, their timeline rows, and refused events."""

    operations: DataFrame
    timeline: DataFrame
    rejected: DataFrame


def is_init() -> Column:
    return F.coalesce(F.col("initDoc") == "True", F.lit(False))


def status_events(df: DataFrame, stage: str, kind: str, message: Column | str | None = None) -> DataFrame:
    """Status event of one kind: ``init``, ``in_progress``, ``succeeded`` or ``failed``."""
    status = {"init": S.IN_PROGRESS, "in_progress": S.IN_PROGRESS,
              "succeeded": S.SUCCEEDED, "failed": S.FAILED}[kind]
    note = F.lit(None) if message is None else message
    note = F.lit(note) if isinstance(note, str) else note
    return (
        df.withColumn("stage", F.lit(stage))
        .withColumn("status", F.lit(status))
        .withColumn("initDoc", F.lit("True" if kind == "init" else None).cast("string"))
        .withColumn("message", F.nullif(note.cast("string"), F.lit("")))
    )


def stage_status(df: DataFrame, stage: str, ok: Column | str = "ok", message: Column | None = None) -> DataFrame:
    """Two events per row: the stage starts, then it succeeds or fails with a message."""
    done = F.col(ok) if isinstance(ok, str) else ok
    none = F.lit(None).cast("string")
    note = none if message is None else F.nullif(message, F.lit(""))
    start = F.struct(F.lit(0).alias("step"), F.lit(S.IN_PROGRESS).alias("status"), none.alias("message"))
    end = F.struct(
        F.lit(1).alias("step"),
        F.when(done, S.SUCCEEDED).otherwise(S.FAILED).alias("status"),
        F.when(~done, note).alias("message"),
    )
    return df.select("*", F.lit(stage).alias("stage"), F.inline(F.array(start, end)))


def _first_inits(events: DataFrame) -> DataFrame:
    return earliest_by_key(events.where(is_init()), ["documentId"], "seq")


def _new_item() -> list[Column]:
    return [
        F.col("documentId"), F.col("bucketName"), F.col("objectName"),
        F.col("status").alias("documentStatus"), F.col("stage").alias("documentStage"),
        F.lit(None).cast("string").alias("lastUpdate"), F.col("versionId").alias("documentVersion"),
    ]


def start_tracking(ops: DataFrame | None, events: DataFrame) -> Outcome:
    """Init events of untracked documents become items; repeated inits are refused."""
    first = _first_inits(events)
    if ops is not None:
        first = first.join(ops.select("documentId"), "documentId", "left_anti")
    rejected = (
        events.where(is_init())
        .join(first.select("documentId", "seq"), ["documentId", "seq"], "left_anti")
        .withColumn("reason", F.lit("document is already tracked"))
    )
    return Outcome(first.select(*_new_item()), rejected)


def update_tracking(ops: DataFrame, events: DataFrame) -> Tracked:
    """Apply the later status events to tracked documents; unknown documents are refused."""
    updates = events.where(~is_init())
    latest = updates.groupBy("documentId").agg(
        F.max_by(F.struct("status", "stage", "timestamp"), F.col("seq")).alias("_u")
    )
    changed = F.col("_u").isNotNull()
    operations = ops.join(latest, "documentId", "left").select(
        "documentId", "bucketName", "objectName",
        F.when(changed, F.col("_u.status")).otherwise(F.col("documentStatus")).alias("documentStatus"),
        F.when(changed, F.col("_u.stage")).otherwise(F.col("documentStage")).alias("documentStage"),
        F.when(changed, F.col("_u.timestamp")).otherwise(F.col("lastUpdate")).alias("lastUpdate"),
        "documentVersion",
    )
    known = ops.select("documentId")
    return Tracked(
        operations,
        updates.join(known, "documentId", "left_semi").select(*TIMELINE),
        updates.join(known, "documentId", "left_anti").withColumn(
            "reason", F.lit("document is not tracked")
        ),
    )


def fold_state(events: DataFrame) -> DataFrame:
    """State of every tracked document from the whole log, in one aggregation.

    Both parts are min/max aggregates, so the same fold runs as a streaming
    aggregation and does not depend on how the log is cut into batches. An
    update before the first init never counts: if the last update came after
    the init it is the state, otherwise the init is.
    """
    folded = events.groupBy("documentId").agg(
        F.min_by(
            F.struct("seq", "bucketName", "objectName", "status", "stage", "timestamp", "versionId"),
            F.when(is_init(), F.col("seq")),
        ).alias("init"),
        F.max_by(
            F.struct("seq", "status", "stage", "timestamp"),
            F.when(~is_init(), F.col("seq")),
        ).alias("last"),
    )
    return folded


def state_items(folded: DataFrame) -> DataFrame:
    """Operations items from ``fold_state``."""
    updated = F.coalesce(F.col("last.seq") > F.col("init.seq"), F.lit(False))
    return folded.where(F.col("init").isNotNull()).select(
        "documentId", "init.bucketName", "init.objectName",
        F.when(updated, F.col("last.status")).otherwise(F.col("init.status")).alias("documentStatus"),
        F.when(updated, F.col("last.stage")).otherwise(F.col("init.stage")).alias("documentStage"),
        F.when(updated, F.col("last.timestamp")).alias("lastUpdate"),
        F.col("init.versionId").alias("documentVersion"),
    )


def judge_events(events: DataFrame) -> DataFrame:
    """Add ``reason``: null for an accepted event, else why it is refused."""
    starts = events.where(is_init()).groupBy("documentId").agg(F.min("seq").alias("_start"))
    judged = events.join(starts, "documentId", "left")
    reason = (
        F.when(is_init() & (F.col("seq") > F.col("_start")), "document is already tracked")
        .when(F.col("_start").isNull() | (F.col("seq") < F.col("_start")), "document is not tracked")
    )
    return judged.withColumn("reason", reason).drop("_start")


def fold_status_events(events: DataFrame) -> Tracked:
    """Fold a whole log in arrival order: last arrival wins, no state machine."""
    judged = judge_events(events)
    # the init's own entry carries no message
    note = F.when(~is_init(), F.col("message")).alias("message")
    timeline = judged.where(F.col("reason").isNull()).select(*TIMELINE[:-1], note)
    return Tracked(
        state_items(fold_state(events)), timeline, judged.where(F.col("reason").isNotNull())
    )


def mark_complete(
    ops: DataFrame, ids: DataFrame, stage: str, timestamp: Column, timeline: DataFrame | None = None,
    seq: Column | int = 0,
) -> Tracked:
    """Set documents to succeeded, with an empty message in the timeline entry.

    The entry comes last: its ``seq`` is one above the document's greatest in
    ``timeline``, and at least ``seq``. Give one of them where the document has
    entries already.
    """
    rows = ids.select("documentId").distinct()
    least = F.lit(seq) if isinstance(seq, int) else seq
    number = least.cast("bigint")
    if timeline is not None:
        last = timeline.groupBy("documentId").agg((F.max("seq") + 1).alias("_next"))
        rows, number = rows.join(last, "documentId", "left"), F.greatest(number, F.col("_next"))
    events = rows.select(
        "documentId", F.lit(S.SUCCEEDED).alias("status"), F.lit(stage).alias("stage"),
        timestamp.alias("timestamp"), F.lit("").alias("message"),
        F.lit(None).cast("string").alias("initDoc"), number.alias("seq"),
    )
    return update_tracking(ops, events)


def operations_items(ops: DataFrame, timeline: DataFrame, part_rows: int | None = None, **kw) -> DataFrame:
    """Items with their ``timeline`` array, the whole history of a document in one list.

    A document whose list would not fit a row is the reason to choose
    ``part_rows``: its timeline then continues after so many entries in further
    rows, numbered by ``part``. The rows of the timeline themselves have no limit.
    """
    entry = collect_in_order("seq", "timestamp", "stage", "status", "message").alias("timeline")
    if part_rows is None:
        lists = timeline.groupBy("documentId").agg(entry)
        return ops.join(lists, "documentId", "left").select(*ops.columns, "timeline")
    parts = (
        ordinal(timeline, ["documentId"], ["seq"], **kw)
        .withColumn("part", F.floor(F.col("ord") / part_rows))
        .groupBy("documentId", "part")
        .agg(entry)
    )
    # inner, so that the many parts of one document can be split over tasks
    told = parts.join(ops, "documentId")
    silent = ops.join(timeline.select("documentId").distinct(), "documentId", "left_anti").withColumn(
        "part", F.lit(0).cast("bigint")
    )
    return told.unionByName(silent, allowMissingColumns=True).select(*ops.columns, "part", "timeline")


def timeline_of(timeline: DataFrame, document_id: str) -> DataFrame:
    """History of one document, oldest first."""
    return timeline.where(F.col("documentId") == document_id).orderBy("seq")


def list_documents(ops: DataFrame, token: str | None = None, limit: int = S.LIST_PAGE) -> DataFrame:
    """One page of items by id, with the ``nextToken`` of the following page.

    The token is null on the last page.
    """
    after = ops if token is None else ops.where(F.col("documentId") > token)
    page = after.orderBy("documentId").limit(limit + 1)
    whole = Window.partitionBy(F.lit(0))  # at most limit + 1 rows
    numbered = page.withColumn("_n", F.row_number().over(whole.orderBy("documentId")))
    token_col = F.max(F.when(F.col("_n") == limit, F.col("documentId"))).over(whole)
    more = F.count(F.lit(1)).over(whole) > limit
    return (
        numbered.withColumn("nextToken", F.when(more, token_col))
        .where(F.col("_n") <= limit)
        .drop("_n")
    )


def pipeline_summary(ops: DataFrame) -> DataFrame:
    """Documents by stage and status."""
    return ops.groupBy("documentStage", "documentStatus").agg(F.count(F.lit(1)).alias("documents"))


def finished_documents(ops: DataFrame) -> DataFrame:
    return ops.where(
        (F.col("documentStage") == S.STAGE_ANNOTATE) & (F.col("documentStatus") == S.SUCCEEDED)
    )

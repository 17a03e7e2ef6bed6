"""Document registry, classification and refusals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.functions.names import present
from docflow.operators import Outcome
from docflow.operators.ordered import earliest_by_key


def register_documents(registry: DataFrame | None, events: DataFrame) -> Outcome:
    """Insert a document if its id is absent; the first event of an id wins.

    ``events`` needs ``seq``, the arrival order. Of events that share the first
    ``seq`` of a document the least by content is registered and the others are
    refused, equal ones as often as they came.
    """
    content = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    place = F.struct("seq", content.alias("content"))
    rows = events.withColumn("_place", place)
    first = rows.groupBy("documentId").agg(F.min("_place").alias("_first"))
    if registry is not None:
        stored = registry.select("documentId").distinct().withColumn("_stored", F.lit(True))
        first = first.join(stored, "documentId", "left").withColumn(
            "_first", F.when(F.col("_stored").isNull(), F.col("_first"))).drop("_stored")
    judged = rows.join(first, "documentId").withColumn("_wins", F.col("_place").eqNullSafe(F.col("_first")))
    accepted = earliest_by_key(judged.where("_wins").drop("_place", "_first", "_wins"), ["documentId"], "seq")
    twins = judged.where("_wins").groupBy(*["documentId", "_place"]).agg(
        F.first(F.struct(*events.columns)).alias("_row"), (F.count(F.lit(1)) - 1).cast("int").alias("_n")).where("_n > 0")
    again = twins.select(F.explode(F.array_repeat("_row", F.col("_n"))).alias("_row")).select("_row.*")
    rejected = judged.where("not _wins").select(*events.columns).unionByName(again).withColumn(
        "reason", F.lit("document is already registered"))
    return Outcome(accepted, rejected)


def classify_documents(registry: DataFrame, rules: dict[str, bool] | None = None) -> Outcome:
    """Add ``class`` and ``eligible``; rows without the needed fields are refused.

    ``rules`` (class to eligible) replaces the fixed list of classes; a class
    it does not name is not eligible. The rules become part of the expression,
    so no class, however common, is shuffled to one task.
    """
    complete = (
        F.col("documentMetadata").isNotNull()
        & present("documentId") & present("bucketName") & present("documentName")
    )
    rejected = registry.where(~complete).withColumn("reason", F.lit("invalid document item"))
    allowed = S.ANALYSED_CLASSES if rules is None else [c for c, ok in rules.items() if ok]
    valid = registry.where(complete).withColumn(
        "class", F.try_element_at("documentMetadata", F.lit("class"))
    )
    eligible = F.coalesce(F.col("class").isin(allowed), F.lit(False))
    return Outcome(valid.withColumn("eligible", eligible), rejected)


def start_analysis_events(classified: DataFrame) -> DataFrame:
    """For each eligible document the init event and then the stage's success."""
    def event(step, status, init):
        return F.struct(F.lit(step).alias("step"), F.lit(status).alias("status"), init.alias("initDoc"))

    return (
        classified.where("eligible")
        .select(
            "documentId", "bucketName", F.col("documentName").alias("objectName"),
            F.lit(S.STAGE_CLASSIFIER).alias("stage"),
            F.inline(F.array(
                event(0, S.IN_PROGRESS, F.lit("True")),
                event(1, S.SUCCEEDED, F.lit(None).cast("string")),
            )),
        )
    )


def refused_documents(registry: DataFrame, rules: dict[str, bool] | None = None) -> DataFrame:
    """Registered documents that are not allowed on, with their class."""
    return classify_documents(registry, rules).accepted.where(~F.col("eligible")).select(
        "documentId", "bucketName", "documentName", "class"
    )

"""Routes by file extension, copy plans and OCR requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.functions.names import base_name, extension, present
from docflow.operators import Outcome
from docflow.operators.lineage import record_lineage_of_copy
from docflow.operators.ordered import earliest_by_key


def route_by_extension(documents: DataFrame, key: str = "objectName") -> Outcome:
    """Add ``extension`` and ``route``; the match is case sensitive, others are refused."""
    routed = documents.withColumn("extension", extension(key)).withColumn(
        "route",
        F.when(F.col("extension").isin(S.SYNC_EXTENSIONS), "sync")
        .when(F.col("extension").isin(S.ASYNC_EXTENSIONS), "async"),
    )
    return Outcome(
        routed.where(F.col("route").isNotNull()),
        routed.where(F.col("route").isNull()).drop("route").withColumn(
            "reason", F.lit("incorrect file extension")
        ),
    )


def split_name_ext(objects: DataFrame, key: str = "key") -> DataFrame:
    return objects.withColumn("fileName", base_name(key)).withColumn("extension", extension(key))


def plan_copies(documents: DataFrame, sync_bucket: str, async_bucket: str) -> Outcome:
    """Copy manifest: target bucket by route, target key ``documentId/objectName``."""
    complete = (
        F.col("documentId").isNotNull() & F.col("bucketName").isNotNull() & F.col("objectName").isNotNull()
    )
    incomplete = documents.where(~complete).withColumn(
        "reason", F.lit("missing document id, bucket name or object name")
    )
    routed = route_by_extension(documents.where(complete))
    manifest = routed.accepted.withColumn(
        "targetBucketName", F.when(F.col("route") == "sync", sync_bucket).otherwise(async_bucket)
    ).withColumn("targetFileName", F.concat_ws("/", "documentId", "objectName"))
    return Outcome(manifest, routed.rejected.drop("extension").unionByName(incomplete))


def copy_lineage(manifest: DataFrame, caller: str) -> DataFrame:
    """Lineage events of the planned copies."""
    return record_lineage_of_copy(manifest.select(
        "documentId", F.lit(caller).alias("callerId"),
        F.col("bucketName").alias("sourceBucketName"), "targetBucketName",
        F.col("objectName").alias("sourceFileName"), "targetFileName",
    ).withColumn("s3Event", F.lit(None).cast("string")))


def tagged_objects(objects: DataFrame, catalog: DataFrame) -> DataFrame:
    """Objects (``bucket``, ``key``) with the document id from their tags."""
    tags = catalog.select("bucket", "key", F.try_element_at("tags", F.lit("documentId")).alias("documentId"))
    return objects.join(tags, ["bucket", "key"], "left").select(
        "documentId", F.col("bucket").alias("bucketName"), F.col("key").alias("objectName")
    )


def _features() -> Column:
    return F.array(*[F.lit(f) for f in S.OCR_FEATURES])


def plan_ocr_jobs(objects: DataFrame, catalog: DataFrame, output_bucket: str) -> Outcome:
    """One OCR job per document of the async path; an object without an id is refused.

    The document id is the request token, so requests with the same id are the
    same job: the first object by bucket and name gets it, every other request
    of the document is refused as a repeat.
    """
    tagged = tagged_objects(objects, catalog)
    known = tagged.where(present("documentId"))
    jobs = earliest_by_key(known, ["documentId"], ["bucketName", "objectName"])
    note = F.format_string(
        S.FAILED_START, F.coalesce("documentId", F.lit("")), "bucketName", "objectName",
    )
    # equal requests of one object are counted, so that the job is one of them
    counted = known.groupBy("documentId", "bucketName", "objectName").agg(F.count(F.lit(1)).alias("_n"))
    first = jobs.select("documentId", F.struct("bucketName", "objectName").alias("_job"))
    again = counted.join(first, "documentId").withColumn(
        "_n", F.col("_n") - (F.struct("bucketName", "objectName") == F.col("_job")).cast("bigint"))
    repeats = again.where("_n > 0").select(
        "documentId", "bucketName", "objectName", F.explode(F.array_repeat(F.lit("document already has a job"), F.col("_n").cast("int"))).alias("reason"))
    return Outcome(
        jobs.select(
            "*", F.col("documentId").alias("clientRequestToken"), F.col("documentId").alias("jobTag"),
            _features().alias("featureTypes"), F.lit(output_bucket).alias("outputBucket"),
            F.concat("objectName", F.lit(S.JOB_FOLDER)).alias("outputPrefix"),
        ),
        tagged.where(~present("documentId")).withColumn("reason", note).unionByName(repeats),
    )


def sync_requests(objects: DataFrame, catalog: DataFrame) -> Outcome:
    """OCR requests of the sync path; an empty id, bucket or name is refused."""
    tagged = tagged_objects(objects, catalog)
    complete = present("documentId") & present("bucketName") & present("objectName")
    return Outcome(
        tagged.where(complete).withColumn("featureTypes", _features()),
        tagged.where(~complete).withColumn(
            "reason", F.lit(S.INCOMPLETE_OBJECT)
        ),
    )

"""Inputs that Spark derives from the given tables (rules in FIXTURES.md).

Every rule is a projection of one table, row by row: no shuffle, no limit.
Object events and OCR blocks are written to the shared folder on first use, as
they would be stored in practice; later steps read them as columnar tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.session import COMPRESSION, scratch_dir, write_table
from docflow.sources import catalog as cat
from docflow.sources import events as ev

EXTENSIONS = [".pdf", ".jpg", ".jpeg", ".png", ".PDF", ".txt"]
CLASSES = ["internal_research_report", "external_public_report", "classified_report", "unlisted"]
EPOCH = 1704067200
QUEUE = "arn:docflow:queue"
LINES_PER_PAGE = 20


SPREAD_ROWS = 10_000
ROUND_CHARS = 32 << 20  # of documents whose OCR files lie there at one time


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False, part: Column | None = None) -> DataFrame:
    """A given table, or a ``part`` of it; ``spread`` deals its rows to all cores, where each makes many rows, ``SPREAD_ROWS`` to a task at most."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df if part is None else df.where(part)
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-df.count() // SPREAD_ROWS))) if spread else df


def pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


_STORED: dict[tuple, str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The derived table ``name``, written once per session to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _STORED:
        try:
            return spark.read.parquet(_STORED[key])
        except AnalysisException:
            pass  # the folder was cleared: write it again
    _STORED[key] = scratch_dir(spark, name)
    write_table(build(spark, sf_dir), _STORED[key])
    return spark.read.parquet(_STORED[key])


# --- object events from documents ---------------------------------------------------

def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notification per document, with one to five records."""
    doc = F.col("doc_id")

    def record(name: str, offset: int) -> Column:
        time = F.date_format(F.timestamp_seconds(F.lit(EPOCH + offset) + doc), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        return F.struct(
            F.lit(name).alias("eventName"), F.lit("aws:s3").alias("eventSource"), time.alias("eventTime"),
            F.struct(F.concat(F.lit("user-"), "lang").alias("principalId")).alias("userIdentity"),
            F.struct(
                F.struct(F.col("source").alias("name")).alias("bucket"),
                F.struct(
                    F.concat("lang", F.lit("/"), doc.cast("string"), pick(EXTENSIONS, doc)).alias("key"),
                    F.when(doc % 3 == 0, "").otherwise(F.concat(F.lit("v"), (doc % 3).cast("string"))).alias("versionId"),
                ).alias("object"),
            ).alias("s3"),
        )

    records = F.array_compact(F.array(
        F.when(doc % 11 == 0, record("ObjectRemoved:Delete", -1_000_000)),
        record("ObjectCreated:Put", 0),
        F.when(doc % 7 == 0, record("ObjectCreated:Copy", 5_000_000)),
        F.when(doc % 10 == 0, record("ObjectRemoved:Delete", 10_000_000)),
        F.when(doc % 50 == 0, record("ObjectRestore:Post", 20_000_000)),
    ))
    return table(spark, sf_dir, "documents").select(records.alias("Records"))


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no notifications, one per document: cut off, without records, with none."""
    doc = F.col("doc_id")
    text = pick(['{"Records":[{"eventName":"Obj', '{"Event":"s3:TestEvent"}', '{"Records":[]}'], doc)
    return table(spark, sf_dir, "documents").select(text.alias("value"))


def ingested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed object events with document ids, from the notifications."""
    flat = ev.flatten_notifications(notifications(spark, sf_dir))
    return ev.assign_document_id(ev.route_object_events(flat))


def object_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, as later steps read them."""
    return stored(spark, sf_dir, "object_events", ingested_events)


def doc_number(key: str) -> Column:
    """The ``doc_id`` inside an object key of the fixture."""
    return F.regexp_extract(key, r"/([0-9]+)\.", 1).cast("bigint")


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry messages whose class follows the document number."""
    metadata = F.create_map(
        F.lit("owner"), F.lit("CustomerName"), F.lit("class"), pick(CLASSES, doc_number("key"))
    )
    return ev.build_registry_events(object_events(spark, sf_dir), metadata)


def lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.build_lineage_events(object_events(spark, sf_dir))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The created objects, tagged with the id of their first upload; every 13th has no tags."""
    events = object_events(spark, sf_dir).where(F.col("eventName") == "ObjectCreated:Put")
    kept = F.when(doc_number("key") % 13 != 0, F.col("tags"))
    return cat.ingested_tags(events).select("bucket", "key", kept.alias("tags"))


# --- status events from events ------------------------------------------------------

STAGES = {
    "signup": S.STAGE_CLASSIFIER, "view": S.STAGE_PROCESSOR, "click": S.STAGE_SYNC_OCR,
    "error": S.STAGE_ASYNC_OCR, "purchase": S.STAGE_ANNOTATE,
}


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_events_of(table(spark, sf_dir, "events"))


def status_events_of(events: DataFrame) -> DataFrame:
    """Status events; a signup starts a document, every 97th event has an unknown one."""
    kind = F.col("event_type")
    stage = F.coalesce(*[F.when(kind == k, v) for k, v in STAGES.items()])
    none = F.lit(None).cast("string")
    user = F.col("user_id").cast("string")
    return events.select(
        F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("unknown-"), F.col("event_id").cast("string")))
        .otherwise(F.concat(F.lit("doc-"), user)).alias("documentId"),
        F.concat(F.lit("bucket-"), (F.col("user_id") % 7).cast("string")).alias("bucketName"),
        F.concat(F.lit("u/"), user, F.lit(".pdf")).alias("objectName"),
        F.when(kind == "error", S.FAILED).when(kind == "purchase", S.SUCCEEDED)
        .otherwise(S.IN_PROGRESS).alias("status"),
        stage.alias("stage"),
        F.when((kind == "signup") & (F.col("event_id") % 97 != 0), "True").alias("initDoc"),
        F.when(kind == "error", F.col("props")).otherwise(none).alias("message"),
        F.when(F.col("user_id") % 2 == 1, F.lit("v1")).alias("versionId"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" +0000 UTC")).alias("timestamp"),
        F.unix_micros(F.to_timestamp("ts")).alias("seq"),
    )


# --- OCR blocks -----------------------------------------------------------------------

def block(kind: str, id_: Column, text=None, children=None, values=None, entity=None, status=None,
          row=None, column=None, top=None) -> Column:
    """One OCR block. ``children``/``values`` are arrays of ids; None leaves the list out."""
    def typed(name, value, kind):
        return (F.lit(None).cast(kind) if value is None else value).alias(name)

    relations = [
        F.struct(F.lit(name).alias("Type"), ids.alias("Ids"))
        for name, ids in (("VALUE", values), ("CHILD", children)) if ids is not None
    ]
    top = F.lit(0.25) if top is None else top
    box = F.struct(*[F.lit(v).alias(n) for v, n in ((0.5, "Width"), (0.125, "Height"), (0.25, "Left"))], top.alias("Top"))
    corners = F.array(*[F.struct(F.lit(x).alias("X"), top.alias("Y")) for x in (0.25, 0.75)])

    def number(name, value):
        return typed(name, None if value is None else F.lit(value).cast("bigint"), "bigint")

    return F.struct(
        F.lit(kind).alias("BlockType"), id_.alias("Id"), typed("Text", text, "string"),
        F.lit(99.5).alias("Confidence"), F.struct(box.alias("BoundingBox"), corners.alias("Polygon")).alias("Geometry"),
        typed("Relationships", F.array(*relations) if relations else None, S.RELATIONSHIPS),
        typed("EntityTypes", F.array(F.lit(entity)) if entity else None, "array<string>"),
        typed("SelectionStatus", status, "string"),
        number("RowIndex", row), number("ColumnIndex", column),
        number("RowSpan", None if row is None else 1), number("ColumnSpan", None if column is None else 1),
    )


def _ids(*ids: str) -> Column:
    return F.array(*[F.lit(i) for i in ids])


def _word_ids(prefix: Column, text: Column) -> Column:
    return F.transform(F.split(text, " "), lambda _, j: F.concat(prefix, j.cast("string")))


def _words(prefix: Column, text: Column) -> Column:
    return F.transform(
        F.split(text, " "), lambda w, j: block("WORD", F.concat(prefix, j.cast("string")), w)
    )


def text_rounds(spark: SparkSession, sf_dir: str) -> list[tuple[str, Column | None]]:
    """The documents as ``(folder, part)`` of about ``ROUND_CHARS`` of text, together all of them; rows of one ``doc_id`` are in one."""
    docs = table(spark, sf_dir, "documents")
    rounds = -(-(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // ROUND_CHARS)
    if rounds <= 1:
        return [(sf_dir, None)]
    folder = scratch_dir(spark, "rounds")
    dealt = docs.withColumn("_round", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)).cast("int")).repartition(rounds, "_round")
    dealt.write.option("compression", COMPRESSION).partitionBy("_round").parquet(f"{folder}/documents.parquet")
    found = table(spark, folder, "documents").select("_round").distinct().orderBy("_round").collect()  # a number for each round
    return [(folder, F.col("_round") == r._round) for r in found]


def text_responses(spark: SparkSession, sf_dir: str, part: Column | None = None) -> DataFrame:
    """One response per document: a page per 20 lines, a LINE per line, a WORD per word.

    Every 5th document lacks its first PAGE block; every 4th starts with an
    outdated block with the id of a later word; every line lists an id that
    does not exist.
    """
    doc = F.col("doc_id")

    def line(text: Column, i: Column) -> Column:
        n = i.cast("string")
        words = F.concat(F.lit("w"), n, F.lit("-"))
        opens = F.when(
            (i % LINES_PER_PAGE == 0) & ((i > 0) | (doc % 5 != 0)), F.array(block("PAGE", F.concat(F.lit("p"), n)))
        ).otherwise(F.array().cast(f"array<{S.BLOCK}>"))
        listed = F.concat(_word_ids(words, text), F.array(F.concat(F.lit("missing-"), n)))
        own = block("LINE", F.concat(F.lit("l"), n), text, children=listed, top=(i % 4) * 0.25)
        return F.concat(opens, F.array(own), _words(words, text))

    outdated = F.when(doc % 4 == 0, F.array(block("WORD", F.lit("w0-0"), F.lit("outdated")))).otherwise(
        F.array().cast(f"array<{S.BLOCK}>")
    )
    blocks = F.concat(outdated, F.flatten(F.transform(F.split("text", "\n"), line)))
    return table(spark, sf_dir, "documents", spread=True, part=part).select(
        F.concat(F.lit("doc-"), doc.cast("string")).alias("documentId"), blocks.alias("Blocks")
    )


def form_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One form per customer."""
    def field(n: int, key: str, value: Column | None, status: Column | None = None) -> Column:
        k, v = F.lit(f"k{n}-"), F.lit(f"v{n}-")
        has_value = value is not None or status is not None
        blocks = [F.array(block(
            "KEY_VALUE_SET", F.lit(f"key{n}"), children=_word_ids(k, F.lit(key)),
            values=_ids(f"value{n}") if has_value else None, entity="KEY"))]
        blocks.append(_words(k, F.lit(key)))
        if status is not None:
            blocks.append(F.array(
                block("KEY_VALUE_SET", F.lit(f"value{n}"), children=_ids(f"s{n}"), entity="VALUE"),
                block("SELECTION_ELEMENT", F.lit(f"s{n}"), status=status)))
        elif value is not None:
            blocks.append(F.array(
                block("KEY_VALUE_SET", F.lit(f"value{n}"), children=_word_ids(v, value), entity="VALUE")))
            blocks.append(_words(v, value))
        return F.concat(*blocks)

    nation = F.col("c_nationkey").cast("string")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    blocks = F.concat(
        F.array(block("PAGE", F.lit("page1"))),
        field(1, "Customer Name", F.col("c_name")),
        field(2, "Market Segment", F.concat("c_mktsegment", F.lit(", "), "c_mktsegment")),
        field(3, "Balance", cents.cast("string")),
        field(4, "In Credit", None, F.when(cents >= 0, "SELECTED").otherwise("NOT_SELECTED")),
        field(5, "Nation", None),
        F.array(block("KEY_VALUE_SET", F.lit("bare"), entity="KEY")),
        field(6, "Nation", F.concat(F.lit("N"), nation)),
    )
    return table(spark, sf_dir, "customer", spread=True).select(
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("documentId"), blocks.alias("Blocks")
    )


def table_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables per order: even orders have a header, odd ones start at row 2."""
    def cell(n: str, row: int, column: int, text: Column | None, status: Column | None = None) -> Column:
        if status is not None:
            return F.array(
                block("CELL", F.lit(n), children=_ids(f"{n}-s"), row=row, column=column),
                block("SELECTION_ELEMENT", F.lit(f"{n}-s"), status=status))
        w = F.lit(f"{n}-w")
        return F.concat(
            F.array(block("CELL", F.lit(n), children=_word_ids(w, text), row=row, column=column)), _words(w, text))

    order = F.col("o_orderkey")
    header = ["c11", "c12"]
    body = ["c21", "c22", "c31", "c32", "nowhere", "c41", "c42", "c13"]
    listed = F.when(order % 2 == 0, _ids(*header, *body)).otherwise(_ids(*body))
    no_blocks = F.array().cast(f"array<{S.BLOCK}>")
    blocks = F.concat(
        F.array(block("PAGE", F.lit("page1")), block("TABLE", F.lit("t1"), children=listed)),
        cell("c11", 1, 1, F.lit("field")), cell("c12", 1, 2, F.lit("value")),
        cell("c21", 2, 1, F.lit("status")), cell("c22", 2, 2, F.col("o_orderstatus")),
        cell("c31", 3, 1, F.lit("priority")), cell("c32", 3, 2, F.col("o_orderpriority")),
        cell("c41", 5, 1, F.lit("open")),
        cell("c42", 5, 2, None, F.when(F.col("o_orderstatus") == "O", "SELECTED").otherwise("NOT_SELECTED")),
        cell("c13", 1, 3, F.lit("note")),
        F.when(order % 3 == 0, F.array(block("TABLE", F.lit("t2"), children=_ids("nowhere")))).otherwise(no_blocks),
        F.when(order % 5 == 0, F.array(block("TABLE", F.lit("t3")))).otherwise(no_blocks),
    )
    return table(spark, sf_dir, "orders", spread=True).select(
        F.concat(F.lit("ord-"), order.cast("string")).alias("documentId"), blocks.alias("Blocks")
    )


def mixed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response of three pages per supplier; each has a line, a field and a table, in another order."""
    name, nation = F.col("s_name"), F.col("s_nationkey").cast("string")

    def page(p: int) -> list[Column]:
        line = F.array(block("LINE", F.lit(f"l{p}"), F.concat(name, F.lit(f" page {p}"))))
        key, value, cell = F.lit(f"kw{p}-"), F.lit(f"vw{p}-"), F.lit(f"cw{p}-")
        text = F.concat(F.lit("page "), F.lit(str(p)), F.lit(" "), name)
        field = F.concat(
            F.array(block("KEY_VALUE_SET", F.lit(f"k{p}"), children=_word_ids(key, F.lit("Supplier")), values=_ids(f"v{p}"), entity="KEY")),
            _words(key, F.lit("Supplier")),
            F.array(block("KEY_VALUE_SET", F.lit(f"v{p}"), children=_word_ids(value, text), entity="VALUE")), _words(value, text))
        table_ = F.concat(
            F.array(block("TABLE", F.lit(f"t{p}"), children=_ids(f"c{p}")),
                    block("CELL", F.lit(f"c{p}"), children=_word_ids(cell, nation), row=1, column=1)), _words(cell, nation))
        parts = {1: (line, field, table_), 2: (table_, line, field), 3: (field, table_, line)}[p]
        return [F.array(block("PAGE", F.lit(f"p{p}"))), *parts]

    blocks = F.concat(*[x for p in (1, 2, 3) for x in page(p)])
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("sup-"), F.col("s_suppkey").cast("string")).alias("documentId"), blocks.alias("Blocks"))


def _blocks(responses):
    """Blocks of derived responses.

    No response is empty, and the outer form does not build it a second time to
    test for that.
    """
    def build(spark, sf_dir):
        return responses(spark, sf_dir).select(
            "documentId", F.posexplode_outer("Blocks").alias("pos", "b")
        ).select("documentId", F.col("pos").cast("bigint").alias("pos"), "b.*")

    return build


def text_blocks(spark, sf_dir):
    return stored(spark, sf_dir, "text_blocks", _blocks(text_responses))


def form_blocks(spark, sf_dir):
    return stored(spark, sf_dir, "form_blocks", _blocks(form_responses))


def table_blocks(spark, sf_dir):
    return stored(spark, sf_dir, "table_blocks", _blocks(table_responses))


def mixed_blocks(spark, sf_dir):
    return stored(spark, sf_dir, "mixed_blocks", _blocks(mixed_responses))


def all_blocks(spark, sf_dir):
    return (
        text_blocks(spark, sf_dir)
        .unionByName(form_blocks(spark, sf_dir))
        .unionByName(table_blocks(spark, sf_dir))
    )


def objects_of(responses: DataFrame) -> DataFrame:
    """The object each response belongs to."""
    return responses.select(
        "documentId", F.concat("documentId", F.lit("/scan/"), "documentId", F.lit(".pdf")).alias("objectName"),
        F.lit("ocr-results").alias("bucketName"),
    )

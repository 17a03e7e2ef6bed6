"""Queries over page text: chunks, annotations, search records, search."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.functions.text import ENTITY_PATTERNS, STOP_WORDS, sorted_map_json
from docflow.operators import annotate, registry, routing, search, tracking
from docflow.operators.keyed import may_be_among
from docflow.operators.ordered import collect_in_order
from docflow.plans import fixtures as fx
from docflow.plans import ingest
from docflow.plans import ocr as ocr_queries
from docflow.plans.registry import query
from docflow.session import scratch_dir, written
from docflow.sources import outputs

# Cutting by bytes: the same rule over two hexadecimal digits per byte (20 is the space).
_SKIP = "(?:..){1000}" * 4 + "(?:..){96}"
_CUT = f"{_SKIP}(?:[^2].|2[^0])*|(?:..)+"


def chunks_sql(source: str, keys: str) -> str:
    return f"""pieces AS (
  SELECT {keys}, regexp_extract_all(hex(encode(text)), '{_CUT}') AS pieces FROM {source}
), chunks AS (
  SELECT {keys}, unnest(range(len(pieces))) AS ord, decode(from_hex(unnest(pieces))) AS chunk FROM pieces
)"""


def notes_sql(source: str, column: str, keys: str) -> str:
    """Key phrases by lists instead of patterns; the last entity of each type."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    found = ", ".join(
        f"regexp_extract_all({column}, '{p}')[-1] AS {kind}" for kind, p in sorted(ENTITY_PATTERNS.items())
    )
    return f"""marked AS (
  SELECT {keys}, {found}, string_split(regexp_replace({column}, '[,.;:!?()|"\\t\\r\\n]+', ' | ', 'g'), ' ') AS words FROM {source}
), noted AS (
  SELECT {keys}, {", ".join(sorted(ENTITY_PATTERNS))}, list_filter(list_transform(
    string_split(array_to_string(list_transform(list_filter(words, lambda w: w <> ''),
      lambda w: CASE WHEN lower(w) IN ({stops}) THEN '|' ELSE w END), ' '), '|'), lambda p: trim(p)), lambda p: p <> '') AS phrases
  FROM marked
)"""


def entities_json(kinds=tuple(sorted(ENTITY_PATTERNS))) -> str:
    """Entities as JSON text with keys in order, without the missing ones."""
    pairs = ", ".join(f"""'"{k}":' || to_json({k})::VARCHAR""" for k in kinds)
    return f"'{{' || array_to_string(list_filter([{pairs}], lambda x: x IS NOT NULL), ',') || '}}'"


TEXTS = "WITH texts AS (SELECT 'doc-' || doc_id AS doc, text FROM documents), "
CHUNKS = TEXTS + chunks_sql("texts", "doc")
NOTED = CHUNKS + ", " + notes_sql("chunks", "chunk", "doc, ord")


def _texts(spark, d):
    return fx.table(spark, d, "documents", spread=True).select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("documentId"), "text")


@query("chunk_text", CHUNKS + """
SELECT doc AS "documentId", ord::INTEGER AS "chunkOrd", chunk FROM chunks""")
def chunk_text(spark, d):
    return annotate.chunk_text(_texts(spark, d))


@query("annotate_text", NOTED + f"""
SELECT doc AS "documentId", ord::INTEGER AS "chunkOrd", array_to_string(phrases, '|') AS phrases, {entities_json()} AS entities FROM noted""")
def annotate_text(spark, d):
    notes = annotate.annotate_text(annotate.chunk_text(_texts(spark, d)))
    return notes.select("documentId", "chunkOrd", F.array_join("KeyPhrases", "|").alias("phrases"),
                        sorted_map_json("Entities").alias("entities"))


def mail_annotator(texts: pd.Series):
    """An example of a user's annotator: first words as phrases, mail addresses as entities."""
    mail = re.compile(ENTITY_PATTERNS["EMAIL"])
    for text in texts:
        if text.startswith("Is "):
            raise ValueError("unreadable")
        hits = mail.findall(text)
        yield text.split(" ")[:2], ({"EMAIL": hits[-1]} if hits else {})


@query("annotate_text_custom", CHUNKS + f"""
SELECT doc AS "documentId", ord::INTEGER AS "chunkOrd",
  CASE WHEN starts_with(chunk, 'Is ') THEN '' ELSE array_to_string(string_split(chunk, ' ')[1:2], '|') END AS phrases,
  CASE WHEN NOT starts_with(chunk, 'Is ') THEN regexp_extract_all(chunk, '{ENTITY_PATTERNS["EMAIL"]}')[-1] END AS mail,
  CASE WHEN starts_with(chunk, 'Is ') THEN 'unreadable' END AS error FROM chunks""")
def annotate_text_custom(spark, d):
    notes = annotate.annotate_text(annotate.chunk_text(_texts(spark, d)), mail_annotator)
    return notes.select("documentId", "chunkOrd", F.array_join("KeyPhrases", "|").alias("phrases"),
                        F.col("Entities")["EMAIL"].alias("mail"), "error")


MERGED = ", merged AS (SELECT {keys}, array_to_string(flatten(list(phrases ORDER BY ord)), '|') AS phrases, " + ", ".join(
    f"max_by({k}, ord) FILTER ({k} IS NOT NULL) AS {k}" for k in sorted(ENTITY_PATTERNS)) + " FROM noted GROUP BY {keys})"


@query("merge_annotations", NOTED + MERGED.format(keys="doc") + f"""
SELECT doc AS "documentId", phrases, {entities_json()} AS entities FROM merged""")
def merge_annotations(spark, d):
    notes = annotate.annotate_text(annotate.chunk_text(_texts(spark, d)))
    return annotate.merge_annotations(notes, ["documentId"]).select(
        "documentId", F.array_join("KeyPhrases", "|").alias("phrases"), sorted_map_json("Entities").alias("entities"))


# Every page of every document, form and table: its text, annotations, table and form rows.
RECORDS = ocr_queries.PAGE_CONTENT.rstrip() + """
, page_texts AS (
  SELECT doc, page, string_agg(text || chr(10), '' ORDER BY i) AS text, NULL AS "table", NULL AS forms FROM lines GROUP BY doc, page
  UNION ALL SELECT doc, 1, '', NULL, NULL FROM split WHERE doc_id % 4 = 0 AND doc_id % 5 <> 0
  UNION ALL SELECT doc, 1, '', NULL, string_agg(key || '=' || coalesce(value, ''), '/' ORDER BY n) FROM fields GROUP BY doc
  UNION ALL SELECT doc, 1, '', string_agg(array_to_string(texts, '|'), '/' ORDER BY t, row), NULL FROM csv GROUP BY doc
), """ + chunks_sql("page_texts", "doc, page") + ", " + notes_sql("chunks", "chunk", "doc, page, ord") + MERGED.format(
    keys="doc, page") + f"""
, records AS (
  SELECT p.doc, p.page, p.text, p."table", p.forms, coalesce(m.phrases, '') AS phrases,
    CASE WHEN m.doc IS NULL THEN '{{}}' ELSE {entities_json()} END AS entities
  FROM page_texts p LEFT JOIN merged m USING (doc, page)
)"""


def _records(spark, d):
    return annotate.page_search_record(fx.all_blocks(spark, d))


def _flat(records):
    def rows(c, sep):
        return F.array_join(F.transform(c, lambda r: F.array_join(r, sep)), "/")

    return records.select(
        "documentId", "page", "text", F.array_join("KeyPhrases", "|").alias("phrases"),
        sorted_map_json("Entities").alias("entities"), rows("table", "|").alias("table"), rows("forms", "=").alias("forms"))


FLAT = """doc AS "documentId", page, text, phrases, entities, coalesce("table", '') AS "table", coalesce(forms, '') AS forms"""


@query("page_search_record", RECORDS + f"SELECT {FLAT} FROM records")
def page_search_record(spark, d):
    return _flat(_records(spark, d))


@query("write_annotations", RECORDS + """
SELECT doc AS "documentId", doc || '/scan/' || doc || '.pdf/comprehend-output.json' AS path, count(*) AS pages,
  sum(strlen(text))::BIGINT AS bytes, md5(string_agg(page || '|' || text || '|' || phrases || '|' || entities || '|' || coalesce("table", '') || '|' ||
    coalesce(forms, ''), chr(10) ORDER BY page)) AS content FROM records GROUP BY doc""")
def write_annotations(spark, d):
    records = _records(spark, d)
    # every document with a first block has a first page
    named = fx.all_blocks(spark, d).where("pos = 0").select("documentId").distinct().select(
        "documentId", F.concat(F.lit("scan/"), "documentId", F.lit(".pdf")).alias("documentName"))
    path = scratch_dir(spark, "annotations")
    outputs.write_annotations(records, named, path)
    lines = spark.read.parquet(path).where("line <> ']'")
    schema = "documentId STRING, page INT, text STRING, KeyPhrases ARRAY<STRING>, Entities MAP<STRING, STRING>, table ARRAY<ARRAY<STRING>>, forms ARRAY<ARRAY<STRING>>"
    read = lines.select("path", F.from_json(F.substr("line", F.lit(2)), schema).alias("r")).select("path", "r.*")
    whole = F.concat_ws("|", F.col("page").cast("string"), "text", "phrases", "entities", "table", "forms")
    # a digest of all fields of a document's records, in order
    content = F.md5(F.array_join(collect_in_order("page", "_whole"), "\n"))
    flat = _flat(read.withColumn("documentId", F.struct("documentId", "path"))).withColumn("_whole", whole)
    return flat.groupBy("documentId.documentId", "documentId.path").agg(
        F.count("page").alias("pages"), F.sum(F.octet_length("text")).cast("bigint").alias("bytes"), content.alias("content"))


def _pages_index(spark, d):
    """Documents and conversations as one-page records of a search index."""
    talk = fx.table(spark, d, "conversations").select(
        F.concat(F.lit("talk-"), F.col("conv_id").cast("string")).alias("documentId"),
        (F.col("turn") + 1).cast("int").alias("page"), "text")
    docs = _texts(spark, d).select("documentId", F.lit(1).alias("page"), "text")
    return docs.unionByName(talk).select(
        "documentId", "page", F.array().cast("array<string>").alias("KeyPhrases"),
        F.create_map().cast("map<string,string>").alias("Entities"), "text")


INDEX = """WITH entries AS (
  SELECT 'doc-' || doc_id AS doc, 1 AS page, text FROM documents
  UNION ALL SELECT 'talk-' || conv_id, (turn + 1)::INTEGER, text FROM conversations
)"""


@query("upsert_search_index", INDEX + """
SELECT doc AS "documentId", page, CASE WHEN page = 2 THEN 'revised' ELSE md5(text) END AS text,
  page = max(page) OVER (PARTITION BY doc) AS last FROM entries""")
def upsert_search_index(spark, d):
    index = search.upsert_search_index(None, _pages_index(spark, d))
    revised = index.where("page = 2").withColumn("text", F.lit("revised"))
    pages = search.upsert_search_index(index, revised)
    last = search.upsert_search_index(None, pages, key="document").select("documentId", "page", F.lit(True).alias("last"))
    return pages.join(last, ["documentId", "page"], "left").select(
        "documentId", "page", F.when(F.col("text") == "revised", F.col("text")).otherwise(F.md5("text")).alias("text"),
        F.coalesce("last", F.lit(False)).alias("last"))


SEARCH = INDEX + r"""
, tokens AS (SELECT doc, page, list_distinct(regexp_split_to_array(lower(text), '[ \t\r\n!-/:-@\[-`{-~]+')) AS t FROM entries),
hits AS (SELECT doc, page, len(list_filter(t, lambda x: x IN ('the', 'that', 'inth'))) AS matched FROM tokens)
SELECT doc AS "documentId", page, matched::INTEGER AS matched, matched = 3 AS "all" FROM hits WHERE matched >= 1"""


@query("search_index", SEARCH)
def search_index(spark, d):
    hits = search.search_index(_pages_index(spark, d), ["THE", "that", "inth"], mode="any")
    return hits.select("documentId", "page", "matched", (F.col("matched") == 3).alias("all"))


@query("search_index_all", INDEX + r"""
, tokens AS (SELECT doc, page, regexp_split_to_array(lower(text), '[ \t\r\n!-/:-@\[-`{-~]+') AS t FROM entries)
SELECT doc AS "documentId", page FROM tokens WHERE list_contains(t, 'the') AND list_contains(t, 'and') AND starts_with(doc, 'talk-')""")
def search_index_all(spark, d):
    talks = F.col("documentId").startswith("talk-")
    return search.search_index(_pages_index(spark, d), ["the", "and"], metadata=talks).select("documentId", "page")


@query("search_tokens", SEARCH)
def search_tokens(spark, d):
    path = scratch_dir(spark, "tokens")
    search.write_token_table(_pages_index(spark, d), path)
    hits = search.search_tokens(spark.read.parquet(path), ["THE", "that", "inth"], mode="any")
    return hits.select("documentId", "page", "matched", (F.col("matched") == 3).alias("all"))


# --- the whole chain: from object events to finished, searchable documents ---------------------

CHAIN = ingest.EVENTS.rstrip() + ", " + ocr_queries.LINES.strip()[5:] + """
, routed AS (SELECT *, CASE WHEN ext = '.pdf' THEN 'async' WHEN ext IN ('.jpg', '.jpeg', '.png') THEN 'sync' END AS route, doc_id % 9 = 0 AS bad FROM eligible),
paged AS (
  SELECT doc_id, count(DISTINCT page) + CASE WHEN doc_id % 4 = 0 AND doc_id % 5 <> 0 THEN 1 ELSE 0 END AS pages FROM lines GROUP BY doc_id)
SELECT id AS "documentId", CASE WHEN route IS NULL THEN 'DOCUMENT_PROCESSOR' WHEN bad AND route = 'sync' THEN 'SYNC_PROCESS_TEXTRACT'
    WHEN bad THEN 'ASYNC_PROCESS_TEXTRACT' ELSE 'SYNC_PROCESS_COMPREHEND' END AS "documentStage",
  CASE WHEN route IS NULL THEN 'IN_PROGRESS' WHEN bad THEN 'FAILED' ELSE 'SUCCEEDED' END AS "documentStatus",
  (3 + CASE WHEN route IS NULL THEN 0 ELSE 1 + CASE route WHEN 'sync' THEN 2 ELSE 4 END + CASE WHEN bad THEN 0 ELSE 2 END END)::BIGINT AS entries,
  route IS NOT NULL AND NOT bad AS finished, CASE WHEN route IS NOT NULL AND NOT bad THEN pages END AS pages
FROM routed LEFT JOIN paged USING (doc_id)"""


@query("document_chain", CHAIN)
def document_chain(spark, d):
    """Register, classify, route, read the OCR results, annotate, index, and fold all status events."""
    registered = registry.register_documents(None, fx.registry_events(spark, d)).accepted
    classified = registry.classify_documents(registered).accepted
    documents = classified.where("eligible").select("documentId", "bucketName", F.col("documentName").alias("objectName"))
    routed = routing.plan_copies(documents, "sync-ocr", "async-ocr")
    copies = routed.accepted.withColumn("n", fx.doc_number("objectName")).withColumn("ok", F.col("n") % 9 != 0)
    # every 9th result cannot be read; the others are the responses of the documents' texts
    note = F.format_string(S.FAILED_RESULTS, "documentId", F.lit("results"), "objectName", "documentId")
    sync, job = (copies.where(F.col("route") == r) for r in ("sync", "async"))
    read = written(copies.where("ok").select(
        F.concat(F.lit("doc-"), F.col("n").cast("string")).alias("source"), F.col("documentId").alias("owner")), "read")
    # records are made under the name of the response, of which only what is read; blocks need not move to get the document's id
    blocks = may_be_among(fx.text_blocks(spark, d), read.select(F.col("source").alias("documentId")), "documentId")
    records = written(annotate.page_search_record(blocks).withColumnRenamed("documentId", "source").join(read, "source").withColumnRenamed(
        "owner", "documentId").drop("source"), "records")
    index = search.upsert_search_index(None, records)
    steps = [
        registry.start_analysis_events(classified),
        tracking.stage_status(routed.rejected, S.STAGE_PROCESSOR, F.lit(False)).where("step = 0"),
        tracking.stage_status(copies, S.STAGE_PROCESSOR, F.lit(True)),
        tracking.stage_status(sync, S.STAGE_SYNC_OCR, "ok", note),
        tracking.stage_status(job, S.STAGE_ASYNC_START, F.lit(True)),
        tracking.stage_status(job, S.STAGE_ASYNC_OCR, "ok", note),
        tracking.stage_status(
            annotate.annotation_status(records).withColumnRenamed("message", "note"), S.STAGE_ANNOTATE, "ok", F.col("note")),
    ]
    order = [0, 1, 1, 3, 2, 3, 4]  # places of the stages in time
    texts = ["documentId", "bucketName", "objectName", "status", "stage", "initDoc", "message", "versionId"]
    events = None
    for place, step in zip(order, steps, strict=True):
        columns = [F.col(c) if c in step.columns else F.lit(None).cast("string").alias(c) for c in texts]
        rows = step.select(*columns, (place * 2 + F.col("step")).cast("bigint").alias("seq"))
        events = rows if events is None else events.unionByName(rows)
    out = tracking.fold_status_events(events.withColumn("timestamp", F.col("seq").cast("string")))
    entries = out.timeline.groupBy("documentId").agg(F.count(F.lit(1)).alias("entries"))
    pages = index.groupBy("documentId").agg(F.count(F.lit(1)).alias("pages"))
    done = tracking.finished_documents(out.operations).select("documentId", F.lit(True).alias("finished"))
    return out.operations.join(entries, "documentId").join(done, "documentId", "left").join(pages, "documentId", "left").select(
        "documentId", "documentStage", "documentStatus", "entries", F.coalesce("finished", F.lit(False)).alias("finished"), "pages")

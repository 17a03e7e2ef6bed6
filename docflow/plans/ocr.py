"""Queries over OCR responses: pages, lines, forms, tables and their outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.functions import names
from docflow.functions.text import csv_text
from docflow.operators import ocr
from docflow.plans import fixtures as fx
from docflow.plans.registry import query
from docflow.session import scratch_dir, written
from docflow.sources import catalog as cat
from docflow.sources import exact_files, ocr_files, outputs

# Lines of every document, straight from its text. Documents that start with an
# outdated block have one more page in front, unless their first PAGE is missing.
LINES = """
WITH split AS (
  SELECT doc_id, 'doc-' || doc_id AS doc, string_split(text, chr(10)) AS parts FROM documents
), numbered AS (
  SELECT doc_id, doc, parts, unnest(range(len(parts))) AS i FROM split
), lines AS (
  SELECT doc_id, doc, i, parts[i + 1] AS text,
    (i // 20 + 1 + CASE WHEN doc_id % 4 = 0 AND doc_id % 5 <> 0 THEN 1 ELSE 0 END)::INTEGER AS page
  FROM numbered
), words AS (
  SELECT doc_id, doc, i, unnest(range(len(string_split(text, ' ')))) AS j, unnest(string_split(text, ' ')) AS word FROM lines
)
"""
# Form fields straight from the customer columns.
FIELDS = """
WITH source AS (
  SELECT 'cust-' || c_custkey AS doc, c_name, c_mktsegment || ', ' || c_mktsegment AS segment, c_nationkey,
    round(c_acctbal * 100)::BIGINT AS cents FROM customer
), fields AS (
  SELECT doc, 1 AS n, 'Customer Name' AS key, c_name AS value FROM source
  UNION ALL SELECT doc, 2, 'Market Segment', segment FROM source
  UNION ALL SELECT doc, 3, 'Balance', cents::VARCHAR FROM source
  UNION ALL SELECT doc, 4, 'In Credit', CASE WHEN cents >= 0 THEN 'SELECTED' ELSE 'NOT_SELECTED' END FROM source
  UNION ALL SELECT doc, 5, 'Nation', NULL FROM source
  UNION ALL SELECT doc, 6, 'Nation', 'N' || c_nationkey FROM source
)
"""
# Table cells straight from the order columns; row and place as the tables have them.
CELLS = """
WITH source AS (
  SELECT 'ord-' || o_orderkey AS doc, o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority,
    CASE WHEN o_orderstatus = 'O' THEN 'SELECTED, ' ELSE 'NOT_SELECTED, ' END AS mark FROM orders
), cells AS (
  SELECT doc, k, 'c11' AS id, 1 AS r, 1 AS c, 1 AS row, 1 AS place, 'field ' AS text FROM source
  UNION ALL SELECT doc, k, 'c12', 1, 2, 1, 2, 'value ' FROM source
  UNION ALL SELECT doc, k, 'c21', 2, 1, 2, 1, 'status ' FROM source
  UNION ALL SELECT doc, k, 'c22', 2, 2, 2, 2, status || ' ' FROM source
  UNION ALL SELECT doc, k, 'c31', 3, 1, 3, 1, 'priority ' FROM source
  UNION ALL SELECT doc, k, 'c32', 3, 2, 3, 2, priority || ' ' FROM source
  UNION ALL SELECT doc, k, 'c41', 5, 1, 4, 1, 'open ' FROM source
  UNION ALL SELECT doc, k, 'c42', 5, 2, 4, 2, mark FROM source
  UNION ALL SELECT doc, k, 'c13', 1, 3, 4, 3, 'note ' FROM source
), listed AS (SELECT * FROM cells WHERE k % 2 = 0 OR id NOT IN ('c11', 'c12')),
rows AS (
  SELECT doc, k, 1 AS t, row, list(text ORDER BY place) AS texts FROM listed GROUP BY doc, k, row
  UNION ALL SELECT doc, k, 1, 1, []::VARCHAR[] FROM source WHERE k % 2 = 1
  UNION ALL SELECT doc, k, 2, 1, []::VARCHAR[] FROM source WHERE k % 3 = 0
), titles AS (
  SELECT doc, k, 1 AS t FROM source UNION ALL SELECT doc, k, 2 FROM source WHERE k % 3 = 0
  UNION ALL SELECT doc, k, 3 FROM source WHERE k % 5 = 0
), csv AS (
  SELECT doc, t, 0 AS row, ['Table'] AS texts FROM titles
  UNION ALL SELECT doc, t, row, texts FROM rows
  UNION ALL SELECT doc, t, 1000, []::VARCHAR[] FROM titles
  UNION ALL SELECT doc, t, 1001, []::VARCHAR[] FROM titles
)
"""


# --- blocks ------------------------------------------------------------------------------

# Every block of every text response, in order.
BLOCKS = LINES.rstrip() + """
, every AS (
  SELECT doc, doc_id, -1 AS i, 0 AS kind, 0 AS j, 'WORD' AS type, 'w0-0' AS id, 'outdated' AS text, NULL AS children, 0.25 AS top
  FROM split WHERE doc_id % 4 = 0
  UNION ALL SELECT doc, doc_id, i, 0, 0, 'PAGE', 'p' || i, NULL, NULL, 0.25 FROM lines WHERE i % 20 = 0 AND (i > 0 OR doc_id % 5 <> 0)
  UNION ALL SELECT doc, doc_id, i, 1, 0, 'LINE', 'l' || i, text,
    array_to_string(list_transform(range(len(string_split(text, ' '))), lambda j: 'w' || i || '-' || j), ',') || ',missing-' || i, (i % 4) * 0.25 FROM lines
  UNION ALL SELECT doc, doc_id, i, 2, j, 'WORD', 'w' || i || '-' || j, word, NULL, 0.25 FROM words)
"""


@query("explode_blocks", BLOCKS + """
SELECT doc AS "documentId", row_number() OVER (PARTITION BY doc ORDER BY i, kind, j) - 1 AS pos, type AS "BlockType", id AS "Id", text AS "Text",
  99.5::DOUBLE AS "Confidence", children, top::DOUBLE AS top, NULL::VARCHAR AS rest FROM every""")
def explode_blocks(spark, d):
    blocks = ocr.explode_blocks(fx.stored(spark, d, "text_responses", fx.text_responses))
    rest = ["EntityTypes", "SelectionStatus", "RowIndex", "ColumnIndex", "RowSpan", "ColumnSpan"]
    return blocks.select(
        "documentId", "pos", "BlockType", "Id", "Text", "Confidence", F.array_join(F.col("Relationships")[0]["Ids"], ",").alias("children"),
        F.col("Geometry.BoundingBox.Top").alias("top"), F.nullif(F.to_json(F.struct(*rest)), F.lit("{}")).alias("rest"))


@query("read_ocr_responses", LINES + """
SELECT doc AS "documentId", i AS line, text, NULL::VARCHAR AS reason FROM lines
UNION ALL SELECT doc, NULL, NULL, 'failed to parse OCR response' FROM split""")
def read_ocr_responses(spark, d):
    return _in_rounds(spark, d, "responses", _read_ocr_responses)


def _in_rounds(spark, d, name, work):
    """``work(spark, folder, part, path)`` for all documents, a part after the other; the files of a part, below ``path``, go when they are read."""
    done = []
    for folder, part in fx.text_rounds(spark, d):
        path = scratch_dir(spark, name)
        done.append(written(work(spark, folder, part, path), f"{name}-read"))
        exact_files.remove(path)
    return reduce(DataFrame.unionByName, done)


def _read_ocr_responses(spark, d, part, path):
    responses = written(fx.text_responses(spark, d, part), "text-responses")
    made = outputs.page_outputs(ocr.explode_blocks(responses), fx.objects_of(responses)).accepted
    whole = made.where(names.is_full_response("path"))
    # next to each response its first half, under another name of the same document
    half = whole.where(F.col("ord.a") < 3).withColumn("path", F.concat("documentId", F.lit("/cut/ocr-analysis/fullresponse.json")))
    both = whole.unionByName(half.where("line <> ']}'"))
    outputs.write_lines(both.withColumn("path", F.concat("path", F.lit(".zst"))), path, per_file=True)
    out = ocr_files.read_response_blocks(spark, path)
    return out.accepted.where(F.col("BlockType") == "LINE").select(
        "documentId", F.expr("substr(Id, 2)").cast("bigint").alias("line"), F.col("Text").alias("text"),
        F.lit(None).cast("string").alias("reason")).unionByName(out.rejected.select("documentId", "reason"), allowMissingColumns=True)


@query("read_ocr_parts", LINES + """
SELECT doc AS "documentId", i AS line, page, text, NULL::VARCHAR AS message FROM lines WHERE doc_id % 9 <> 0
UNION ALL SELECT doc, NULL, NULL, NULL, 'unreadable' FROM split WHERE doc_id % 9 = 0""")
def read_ocr_parts(spark, d):
    return _in_rounds(spark, d, "parts", _read_ocr_parts)


def _read_ocr_parts(spark, d, part, path):
    responses = fx.text_responses(spark, d, part)
    # responses cut into parts of 50 blocks, one compressed file each, next to the access check file; every 9th has a broken part
    number = F.regexp_extract("documentId", "([0-9]+)$", 1).cast("bigint")
    job = F.concat("documentId", F.lit("/textract-output/job-"), "documentId")
    parts = responses.select("documentId", job.alias("job"), "Blocks", F.explode(F.sequence(
        F.lit(0), F.floor((F.size("Blocks") - 1) / 50) + F.when(number % 9 == 0, 1).otherwise(0))).alias("n")).select(
        F.concat("job", F.lit("/"), (F.col("n") + 1).cast("string"), F.lit(".zst")).alias("path"),
        F.when(F.size("Blocks") > F.col("n") * 50, F.to_json(F.struct(
            F.slice("Blocks", (F.col("n") * 50 + 1).cast("int"), F.lit(50)).alias("Blocks")))).otherwise('{"Blocks":[{').alias("line"))
    check = responses.select(F.concat(job, F.lit("/.s3_access_check")).alias("path"), F.lit("{}").alias("line"))
    exact_files.write_files(parts.unionByName(check).withColumn("ord", F.lit(0)), path)
    found = ocr_files.read_part_blocks(spark, path)
    notices = responses.select(
        F.concat(F.lit("job-"), "documentId").alias("jobId"), "documentId", F.col("documentId").alias("objectName"), F.lit(True).alias("ok"))
    blocks = ocr_files.blocks_of_jobs(found.accepted, notices)
    numbered = ocr.segment_pages(blocks.where(
        F.col("BlockType").isin("PAGE", "LINE") | (F.col("pos") == 0)).select("documentId", "pos", "BlockType", "Id", "Text"))
    lost = ocr_files.jobs_without_results(notices, found, "results")
    return numbered.where("BlockType = 'LINE'").select(
        "documentId", F.expr("substr(Id, 2)").cast("bigint").alias("line"), "page", F.col("Text").alias("text"),
        F.lit(None).cast("string").alias("message")).unionByName(
        lost.select("documentId", F.lit("unreadable").alias("message")), allowMissingColumns=True)


@query("geometry_columns", BLOCKS + """
SELECT doc AS "documentId", type AS "BlockType", id, 0.5::DOUBLE AS width, 0.125::DOUBLE AS height, 0.25::DOUBLE AS left, top::DOUBLE AS top,
  2 AS points, 0.25::DOUBLE AS x1, 0.75::DOUBLE AS x2, top::DOUBLE AS y2 FROM every""")
def geometry_columns(spark, d):
    point = F.col("polygon")
    return ocr.geometry_columns(fx.text_blocks(spark, d)).select(
        "documentId", "BlockType", F.col("Id").alias("id"), "width", "height", "left", "top",
        F.size("polygon").alias("points"), point[0]["X"].alias("x1"), point[1]["X"].alias("x2"), point[1]["Y"].alias("y2"))


@query("extract_words", LINES + """
SELECT doc AS "documentId", 'w' || i || '-' || j AS id, word, 99.5::DOUBLE AS confidence FROM words
UNION ALL SELECT doc, 'w0-0', 'outdated', 99.5 FROM split WHERE doc_id % 4 = 0""")
def extract_words(spark, d):
    return ocr.extract_words(fx.text_blocks(spark, d)).select(
        "documentId", F.col("Id").alias("id"), F.col("Text").alias("word"), F.col("Confidence").alias("confidence"))


@query("extract_selections", FIELDS + """
SELECT doc AS "documentId", 's4' AS id, value AS status FROM fields WHERE n = 4""")
def extract_selections(spark, d):
    return ocr.extract_selections(fx.form_blocks(spark, d)).select(
        "documentId", F.col("Id").alias("id"), F.col("SelectionStatus").alias("status"))


@query("block_children", LINES + """
SELECT doc AS "documentId", 'l' || i AS parent, j AS ord, 'w' || i || '-' || j AS child, word FROM words""")
def block_children(spark, d):
    return ocr.block_children(fx.text_blocks(spark, d), "CHILD").select(
        "documentId", F.concat(F.lit("l"), F.regexp_extract("childId", "w([0-9]+)-", 1)).alias("parent"),
        F.col("ord").cast("bigint").alias("ord"), F.col("childId").alias("child"), F.col("childText").alias("word"))


# --- pages --------------------------------------------------------------------------------

@query("segment_pages", LINES + """
SELECT doc AS "documentId", 'l' || i AS id, page FROM lines
UNION ALL SELECT doc, 'p' || i, page FROM lines WHERE i % 20 = 0 AND (i > 0 OR doc_id % 5 <> 0)
UNION ALL SELECT doc, 'w0-0', 1 FROM split WHERE doc_id % 4 = 0
UNION ALL SELECT w.doc, 'w' || w.i || '-' || j, page FROM words w JOIN lines USING (doc, i)""")
def segment_pages(spark, d):
    blocks = fx.text_blocks(spark, d).select("documentId", "pos", "BlockType", "Id")
    # slices of 1000 blocks, so that the carried totals take part
    return ocr.segment_pages(blocks, slice_rows=1000).select("documentId", F.col("Id").alias("id"), "page")


@query("extract_lines", LINES + """
SELECT doc AS "documentId", 'l' || i AS id, text, text AS words, len(string_split(text, ' '))::INTEGER AS n FROM lines""")
def extract_lines(spark, d):
    return ocr.extract_lines(fx.text_blocks(spark, d)).select(
        "documentId", F.col("Id").alias("id"), F.col("Text").alias("text"),
        F.array_join(F.transform("words", lambda w: w["Text"]), " ").alias("words"), F.size("words").alias("n"))


@query("page_text", LINES + """
SELECT doc AS "documentId", page, string_agg(text || chr(10), '' ORDER BY i) AS text FROM lines GROUP BY doc, page""")
def page_text(spark, d):
    return ocr.page_text(ocr.page_lines(fx.text_blocks(spark, d)))


# --- forms ----------------------------------------------------------------------------------

@query("field_key_text", FIELDS + """
SELECT doc AS "documentId", 'key' || n AS id, key FROM fields""")
def field_key_text(spark, d):
    return ocr.field_key_text(fx.form_blocks(spark, d)).select("documentId", F.col("Id").alias("id"), "key")


@query("key_value_pairs", FIELDS + """
SELECT doc AS "documentId", 'value' || n AS "valueId", len(string_split(value, ' '))::INTEGER AS items FROM fields WHERE value IS NOT NULL""")
def key_value_pairs(spark, d):
    return ocr.key_value_pairs(fx.form_blocks(spark, d)).select("documentId", "valueId", F.size("valueIds").alias("items"))


@query("field_value_text", FIELDS + """
SELECT doc AS "documentId", 'value' || n AS "valueId", value FROM fields WHERE value IS NOT NULL""")
def field_value_text(spark, d):
    return ocr.field_value_text(fx.form_blocks(spark, d)).select("documentId", "valueId", "value")


@query("extract_form_fields", FIELDS + """
SELECT doc AS "documentId", 1 AS page, n, key, value FROM fields""")
def extract_form_fields(spark, d):
    fields = ocr.extract_form_fields(fx.form_blocks(spark, d))
    # the place of a field among the fields of its document
    from docflow.operators.ordered import ordinal

    return ordinal(fields, ["documentId"], ["pos"], name="n").select(
        "documentId", "page", (F.col("n") + 1).cast("int").alias("n"), "key", "value")


@query("form_map", FIELDS + """
SELECT doc AS "documentId", 1 AS page, key, max_by(coalesce(value, '-'), n) AS value FROM fields GROUP BY doc, key""")
def form_map(spark, d):
    return ocr.form_map(ocr.extract_form_fields(fx.form_blocks(spark, d))).select(
        "documentId", "page", "key", F.coalesce("value", F.lit("-")).alias("value"))


@query("get_field", FIELDS + """
SELECT doc AS "documentId", 1 AS page, value FROM fields WHERE n = 6""")
def get_field(spark, d):
    return ocr.get_field(ocr.extract_form_fields(fx.form_blocks(spark, d)), "Nation").select("documentId", "page", "value")


@query("search_fields", FIELDS + """
SELECT doc AS "documentId", key, value FROM fields WHERE contains(lower(key), 'na')""")
def search_fields(spark, d):
    return ocr.search_fields(ocr.extract_form_fields(fx.form_blocks(spark, d)), "NA").select("documentId", "key", "value")


@query("forms_rows", FIELDS + """
SELECT doc AS "documentId", 1 AS page, n::INTEGER - 1 AS place, key, coalesce(value, '') AS value FROM fields""")
def forms_rows(spark, d):
    rows = ocr.forms_rows(ocr.extract_form_fields(fx.form_blocks(spark, d)))
    return rows.select("documentId", "page", F.posexplode("forms").alias("place", "f")).select(
        "documentId", "page", "place", F.col("f")[0].alias("key"), F.col("f")[1].alias("value"))


# --- tables -----------------------------------------------------------------------------------

@query("cell_text", CELLS + """
SELECT doc AS "documentId", id, text FROM cells""")
def cell_text(spark, d):
    blocks = fx.table_blocks(spark, d)
    return ocr.cell_text(blocks).join(blocks.select("documentId", "pos", "Id"), ["documentId", "pos"]).select(
        "documentId", F.col("Id").alias("id"), "text")


@query("extract_cells", CELLS + """
SELECT doc AS "documentId", id, r::BIGINT AS "RowIndex", c::BIGINT AS "ColumnIndex", 1::BIGINT AS "RowSpan", 1::BIGINT AS "ColumnSpan",
  99.5::DOUBLE AS confidence FROM cells""")
def extract_cells(spark, d):
    return ocr.extract_cells(fx.table_blocks(spark, d)).select(
        "documentId", F.col("Id").alias("id"), "RowIndex", "ColumnIndex", "RowSpan", "ColumnSpan", F.col("Confidence").alias("confidence"))


@query("segment_table_rows", CELLS + """
SELECT doc AS "documentId", row AS "rowOrd", place - 1 AS place, text FROM listed""")
def segment_table_rows(spark, d):
    cells = ocr.segment_table_rows(ocr.table_cells(fx.table_blocks(spark, d)))
    rows = cells.groupBy("documentId", "tablePos", "rowOrd").agg(
        F.sort_array(F.collect_list(F.struct("cellOrd", "text"))).alias("c"))
    return rows.select("documentId", "rowOrd", F.posexplode("c").alias("place", "x")).select(
        "documentId", "rowOrd", "place", "x.text")


@query("extract_tables", CELLS + """
SELECT doc AS "documentId", row - 1 AS place, array_to_string(texts, '|') AS texts, len(texts)::INTEGER AS cells FROM rows""")
def extract_tables(spark, d):
    return ocr.extract_tables(fx.table_blocks(spark, d)).select(
        "documentId", F.posexplode("rows").alias("place", "r")).select(
        "documentId", "place", F.array_join("r", "|").alias("texts"), F.size("r").alias("cells"))


@query("tables_rows", CELLS + """
SELECT doc AS "documentId", 1 AS page, (row_number() OVER (PARTITION BY doc ORDER BY t, row) - 1)::INTEGER AS place,
  array_to_string(texts, '|') AS texts, len(texts)::INTEGER AS cells FROM csv""")
def tables_rows(spark, d):
    rows = ocr.tables_rows(ocr.extract_tables(fx.table_blocks(spark, d)))
    return rows.select("documentId", "page", F.posexplode("table").alias("place", "r")).select(
        "documentId", "page", "place", F.array_join("r", "|").alias("texts"), F.size("r").alias("cells"))


@query("csv_text", FIELDS + """
SELECT doc AS "documentId", 'Key,Value' || chr(10) || string_agg(key || ',' || CASE WHEN contains(value, ',') THEN '"' || value || '"'
  ELSE coalesce(value, '') END || chr(10), '' ORDER BY n) AS csv FROM fields GROUP BY doc""")
def csv_text_(spark, d):
    rows = ocr.forms_rows(ocr.extract_form_fields(fx.form_blocks(spark, d)))
    return rows.select("documentId", csv_text("forms", ["Key", "Value"]).alias("csv"))


# --- mixed content and outputs -----------------------------------------------------------------

PAGE_CONTENT = (
    LINES.rstrip() + ", " + FIELDS.strip()[5:].replace("source", "csource")
    + ", " + CELLS.strip()[5:].replace("source", "osource")
)


@query("page_content", PAGE_CONTENT + """
SELECT doc AS "documentId", page, 'line' AS kind, text, 0 AS n FROM lines
UNION ALL SELECT doc, 1, 'field', key || '=' || coalesce(value, ''), 1 FROM fields
UNION ALL SELECT doc, 1, 'table', string_agg(array_to_string(texts, '|'), '/' ORDER BY row), count(*)::INTEGER FROM csv GROUP BY doc, t""")
def page_content(spark, d):
    rows = ocr.page_content(fx.all_blocks(spark, d))
    joined = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/")
    return rows.select(
        "documentId", "page", "kind",
        F.when(F.col("kind") == "line", F.col("text"))
        .when(F.col("kind") == "field", F.array_join(F.col("rows")[0], "=")).otherwise(joined).alias("text"),
        F.coalesce(F.size("rows"), F.lit(0)).alias("n"))


OUTPUT_LINES = PAGE_CONTENT + """
, texts AS (
  SELECT doc || '/scan/' || doc || '.pdf/ocr-analysis/page-' || page || '/text.txt' AS path, i AS place, text AS line FROM lines
), pages AS (
  SELECT doc, page FROM lines GROUP BY doc, page
  UNION ALL SELECT doc, 1 FROM split WHERE doc_id % 4 = 0 AND doc_id % 5 <> 0
  UNION ALL SELECT doc, 1 FROM csource UNION ALL SELECT doc, 1 FROM osource
), forms AS (
  SELECT doc || '/scan/' || doc || '.pdf/ocr-analysis/page-' || page || '/forms.csv' AS path, 0 AS place, 'Key,Value' AS line FROM pages
  UNION ALL SELECT doc || '/scan/' || doc || '.pdf/ocr-analysis/page-1/forms.csv', n,
    key || ',' || CASE WHEN contains(value, ',') THEN '"' || value || '"' ELSE coalesce(value, '') END FROM fields
), tables AS (
  SELECT doc || '/scan/' || doc || '.pdf/ocr-analysis/page-1/tables.csv' AS path, t * 10000 + row AS place, array_to_string(texts, ',') AS line
  FROM (SELECT doc, t, row, list_transform(texts, lambda x: CASE WHEN contains(x, ',') THEN '"' || x || '"' ELSE x END) AS texts FROM csv)
), marks AS (
  SELECT doc || '/scan/' || doc || '.pdf/ocr-analysis/page-' || page || '/text.txt' AS path, -1 AS place, NULL AS line FROM pages
), every AS (SELECT * FROM texts UNION ALL SELECT * FROM marks UNION ALL SELECT * FROM forms UNION ALL SELECT * FROM tables)
"""


@query("write_page_outputs", OUTPUT_LINES + """
SELECT path, (row_number() OVER (PARTITION BY path ORDER BY place) - 1)::BIGINT AS place, line FROM every""")
def write_page_outputs(spark, d):
    from docflow.operators.ordered import ordinal

    blocks = fx.all_blocks(spark, d)
    objects = fx.objects_of(fx.text_responses(spark, d)).unionByName(
        fx.objects_of(fx.form_responses(spark, d))).unionByName(fx.objects_of(fx.table_responses(spark, d)))
    path = scratch_dir(spark, "outputs")
    outputs.write_page_outputs(blocks, objects, path, forms=True, tables=True)
    lines = spark.read.parquet(path).where(~F.col("path").endswith(".json"))
    return ordinal(lines, ["path"], ["ord"], name="place", slice_on=F.col("ord.a")).select("path", "place", "line")


@query("write_output_files", OUTPUT_LINES + """
SELECT path, coalesce(sum(strlen(line) + 1), 0)::BIGINT AS bytes, md5(coalesce(string_agg(line || chr(10), '' ORDER BY place), '')) AS content
FROM every GROUP BY path""")
def write_output_files(spark, d):
    blocks = fx.all_blocks(spark, d)
    objects = fx.objects_of(fx.text_responses(spark, d)).unionByName(
        fx.objects_of(fx.form_responses(spark, d))).unionByName(fx.objects_of(fx.table_responses(spark, d)))
    path = scratch_dir(spark, "files")
    listed = exact_files.write_files(outputs.page_outputs(blocks, objects, forms=True, tables=True).accepted, path)
    # every file as it lies there, at its own path; Spark passes over empty ones
    key = F.split_part(F.col("path"), F.lit(path + "/"), F.lit(-1))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        key.alias("path"), F.md5("content").alias("content"))
    return listed.where(~F.col("path").endswith(".json")).join(files, "path", "left").select(
        "path", "bytes", F.when(F.col("bytes") == 0, F.md5(F.lit(""))).otherwise(F.col("content")).alias("content"))


@query("write_page_json", LINES + """
, counts AS (SELECT doc_id, doc, i, count(*) AS n, any_value(word) AS w FROM words GROUP BY ALL),
per AS (
  SELECT l.doc_id, l.doc, l.page, l.i, l.text,
    1 + (SELECT count(*) FROM words w WHERE w.doc = l.doc AND w.i = l.i) + CASE WHEN l.i % 20 = 0 AND (l.i > 0 OR l.doc_id % 5 <> 0) THEN 1 ELSE 0 END
      + CASE WHEN l.i = 0 AND l.doc_id % 20 = 0 THEN 1 ELSE 0 END AS blocks FROM lines l
), files AS (
  SELECT doc, 'page-' || page || '/response.json' AS file, sum(blocks)::BIGINT AS blocks, md5(string_agg(text, chr(10) ORDER BY i)) AS texts FROM per GROUP BY doc, page
  UNION ALL SELECT doc, 'page-1/response.json', 1, md5('') FROM split WHERE doc_id % 4 = 0 AND doc_id % 5 <> 0
  UNION ALL SELECT doc, 'fullresponse.json', (sum(blocks) + CASE WHEN any_value(doc_id) % 4 = 0 AND any_value(doc_id) % 5 <> 0 THEN 1 ELSE 0 END)::BIGINT,
    md5(string_agg(text, chr(10) ORDER BY i)) FROM per GROUP BY doc
)
SELECT doc || '/scan/' || doc || '.pdf/ocr-analysis/' || file AS path, blocks, texts FROM files""")
def write_page_json(spark, d):
    path = scratch_dir(spark, "outputs")
    responses = fx.text_responses(spark, d)
    blocks = fx.text_blocks(spark, d)
    out = outputs.page_outputs(blocks, fx.objects_of(responses)).accepted
    outputs.write_lines(out.where(F.col("path").endswith(".json")), path, per_file=True)
    key = F.split_part(F.col("_metadata.file_path"), F.lit(path + "/"), F.lit(-1))
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(key.alias("path"), "value")
    # a page's file is a list of blocks, the whole response an object that holds one
    whole = F.when(F.col("path").endswith("fullresponse.json"), F.col("value")).otherwise(
        F.concat(F.lit('{"Blocks":'), "value", F.lit("}")))
    read = files.select("path", F.from_json(whole, S.OCR_RESPONSE)["Blocks"].alias("b"))
    texts = F.transform(F.filter("b", lambda x: x["BlockType"] == "LINE"), lambda x: x["Text"])
    return read.select("path", F.size("b").cast("bigint").alias("blocks"), F.md5(F.array_join(texts, "\n")).alias("texts"))


# Suppliers: three pages with a line, a field and a table, each page in its own order.
MIXED = """
WITH pages AS (
  SELECT 'sup-' || s_suppkey AS doc, p AS page, s_name AS name, s_nationkey::VARCHAR AS nation,
    'page ' || p || ' ' || s_name AS value FROM supplier, (VALUES (1), (2), (3)) v(p)
), parts AS (
  SELECT doc, page, CASE page WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS n, 'line' AS kind, name || ' page ' || page AS text FROM pages
  UNION ALL SELECT doc, page, CASE page WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END, 'field', 'Supplier=' || value FROM pages
  UNION ALL SELECT doc, page, CASE page WHEN 1 THEN 2 WHEN 2 THEN 0 ELSE 1 END, 'table', 'Table/' || nation || ' //' FROM pages
)
"""


@query("mixed_page_content", MIXED + """
SELECT doc AS "documentId", page, n::BIGINT AS place, kind, text FROM parts""")
def mixed_page_content(spark, d):
    from docflow.operators.ordered import ordinal

    rows = ordinal(ocr.page_content(fx.mixed_blocks(spark, d)), ["documentId", "page"], ["pos"], name="place")
    joined = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/")
    return rows.select("documentId", "page", "place", "kind", F.when(F.col("kind") == "line", F.col("text")).when(
        F.col("kind") == "field", F.array_join(F.col("rows")[0], "=")).otherwise(joined).alias("text"))


@query("mixed_pages", MIXED + """
SELECT doc AS "documentId", page, name || ' page ' || page || chr(10) AS text, 'Table/' || nation || ' //' AS "table",
  'Supplier=' || value AS forms, 'Supplier=' || value AS fields, 'Table/' || nation || ' //' AS tables FROM pages""")
def mixed_pages(spark, d):
    blocks = fx.mixed_blocks(spark, d)

    def rows(c, sep):
        return F.array_join(F.transform(c, lambda r: F.array_join(r, sep)), "/")

    forms = ocr.forms_rows(ocr.extract_form_fields(blocks)).select("documentId", "page", rows("forms", "=").alias("fields"))
    tables = ocr.tables_rows(ocr.extract_tables(blocks)).select("documentId", "page", rows("table", "|").alias("tables"))
    whole = ocr.pages(blocks).select("documentId", "page", "text", rows("table", "|").alias("table"), rows("forms", "=").alias("forms"))
    return whole.join(forms, ["documentId", "page"]).join(tables, ["documentId", "page"])


@query("output_tags", MIXED + """
SELECT 'results' AS bucket, doc || '/scan/' || doc || '.pdf/ocr-analysis/' || f AS key, '{"documentId":"' || doc || '"}' AS tags FROM (
  SELECT doc, 'page-' || page || '/' || f AS f FROM pages, (VALUES ('response.json'), ('text.txt'), ('forms.csv'), ('tables.csv')) v(f)
  UNION ALL SELECT DISTINCT doc, 'fullresponse.json' FROM pages)""")
def output_tags(spark, d):
    blocks = fx.mixed_blocks(spark, d)
    lines = outputs.page_outputs(blocks, fx.objects_of(blocks.select("documentId").distinct()), forms=True, tables=True).accepted
    return cat.output_tags(lines, "results").select("bucket", "key", F.to_json("tags").alias("tags"))

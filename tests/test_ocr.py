import json

import pytest
from plans import nodes
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow.operators import annotate, ocr, search
from docflow.sources import ocr_files, outputs


def b(kind, id_, **fields):
    rel = fields.pop("rel", None)
    row = {f: None for f in S.BLOCK_FIELDS} | {"BlockType": kind, "Id": id_} | fields
    if rel is not None:
        row["Relationships"] = [{"Type": t, "Ids": ids} for t, ids in rel]
    return row


def word(id_, text):
    return b("WORD", id_, Text=text)


def blocks_of(spark, **documents):
    rows = [(doc, blocks) for doc, blocks in documents.items()]
    return ocr.explode_blocks(spark.createDataFrame(rows, f"documentId STRING, {S.OCR_RESPONSE}"))


def test_pages(spark):
    blocks = blocks_of(
        spark,
        lead=[b("LINE", "a", Text="x"), b("PAGE", "p1"), b("PAGE", "p2"), b("LINE", "c", Text="y"), b("LINE", "d", Text="z")],
        plain=[b("PAGE", "p1"), b("LINE", "a", Text="t")],
    )
    for slice_rows in (1, 2, 100):
        got = {(r.documentId, r.Id): r.page for r in ocr.segment_pages(blocks, slice_rows=slice_rows).collect()}
        assert got == {("lead", "a"): 1, ("lead", "p1"): 2, ("lead", "p2"): 3, ("lead", "c"): 3, ("lead", "d"): 3,
                       ("plain", "p1"): 1, ("plain", "a"): 1}
    texts = {(r.documentId, r.page): r.text for r in ocr.page_text(ocr.page_lines(blocks)).collect()}
    assert texts == {("lead", 1): "x\n", ("lead", 3): "y\nz\n", ("plain", 1): "t\n"}
    whole = {(r.documentId, r.page): r.text for r in ocr.pages(blocks).collect()}
    assert whole == texts | {("lead", 2): ""}


def test_page_of_many_slices_is_one_row(spark):
    """Short slices, some without a page opening, give the same pages as one slice."""
    def lines(n):
        return [b("LINE", f"l{i}", Text=str(i)) for i in range(n)]

    blocks = blocks_of(spark, d=[b("PAGE", "p")] + lines(7), e=lines(9) + [b("PAGE", "p")] + lines(2))
    rows = blocks.where("BlockType = 'LINE'").select("documentId", "pos", "Text")
    for slice_rows in (1, 2, 3, 100):
        got = {(r.documentId, r.page): r.text for r in ocr.page_text(ocr.paged(rows, blocks, slice_rows=slice_rows)).collect()}
        assert got == {("d", 1): "".join(f"{i}\n" for i in range(7)), ("e", 1): "".join(f"{i}\n" for i in range(9)), ("e", 2): "0\n1\n"}


def test_lines_skip_unknown_ids_and_take_the_last_of_a_repeated_id(spark):
    blocks = blocks_of(spark, d=[
        word("w2", "old"), b("LINE", "l", Text="a b", rel=[("CHILD", ["w2", "gone", "w1"]), ("OTHER", ["w3"]), ("CHILD", ["w3", "l"])]),
        word("w1", "a"), word("w2", "b"), word("w3", "c"), b("LINE", "m", Text="none")])
    got = {r.Id: [w.Text for w in r.words] for r in ocr.extract_lines(blocks).collect()}
    assert got == {"l": ["b", "a", "c"], "m": []}
    # a later block of another type takes the id away from the word
    hidden = blocks_of(spark, d=[word("w", "x"), b("LINE", "l", rel=[("CHILD", ["w"])]), b("LINE", "w", Text="t")])
    assert [r.words for r in ocr.extract_lines(hidden).where("Id = 'l'").collect()] == [[]]


def kv(id_, kind, rel=None):
    return b("KEY_VALUE_SET", id_, EntityTypes=[kind], **({"rel": rel} if rel is not None else {}))


def form(spark):
    return blocks_of(spark, d=[
        b("PAGE", "p"),
        kv("no-child", "KEY", [("VALUE", ["v1"])]),
        kv("empty", "KEY", [("CHILD", [])]),
        kv("k1", "KEY", [("CHILD", ["old"]), ("VALUE", ["v1", "v2", "v3", "gone"]), ("CHILD", ["n", "s", "m"])]),
        kv("k2", "KEY", [("CHILD", ["n", "m"]), ("VALUE", ["v4"])]),
        kv("k3", "KEY", [("CHILD", ["n"]), ("VALUE", ["v5", "k1"])]),
        kv("v1", "VALUE", [("CHILD", ["x"])]), kv("v2", "VALUE", [("CHILD", ["x"]), ("CHILD", ["y", "s"])]),
        kv("v3", "VALUE"), kv("v4", "VALUE"), kv("v5", "VALUE", [("CHILD", [])]),
        word("old", "Old"), word("n", "Full"), word("m", "Name"), word("x", "X"), word("y", "Y"),
        b("SELECTION_ELEMENT", "s", SelectionStatus="SELECTED"),
    ])


def test_form_fields(spark):
    blocks = form(spark)
    fields = ocr.extract_form_fields(blocks).orderBy("pos").collect()
    assert [(r.key, r.value) for r in fields] == [
        ("", None), ("Full Name", "Y SELECTED"), ("Full Name", None), ("Full", "")]
    assert [(r.Id, r.key) for r in ocr.field_key_text(blocks).orderBy("pos").collect()] == [
        ("empty", ""), ("k1", "Full Name"), ("k2", "Full Name"), ("k3", "Full")]
    assert {r.valueId: r.value for r in ocr.field_value_text(blocks).collect()} == {"v2": "Y SELECTED", "v5": ""}
    df = ocr.extract_form_fields(blocks)
    assert [r.value for r in ocr.get_field(df, "Full Name").collect()] == [None]
    assert ocr.get_field(df, "nope").count() == 0
    assert ocr.search_fields(df, "NAME").count() == 2
    assert ocr.forms_rows(df).first().forms == [["", ""], ["Full Name", "Y SELECTED"], ["Full Name", ""], ["Full", ""]]


def cell(id_, row, column=1, children=(), **kw):
    return b("CELL", id_, RowIndex=row, ColumnIndex=column, rel=[("CHILD", list(children))], **kw)


def test_table_rows(spark):
    sel = b("SELECTION_ELEMENT", "s", SelectionStatus="NOT_SELECTED")
    blocks = blocks_of(
        spark,
        gap=[b("TABLE", "t", rel=[("CHILD", ["c2", "c4", "c1", "c9", "none"])]),
             cell("c2", 2, children=["w"]), cell("c4", 4, children=["w", "s", "gone"]), cell("c1", 1),
             b("CELL", "c9", rel=[("CHILD", ["w"])]), word("w", "x"), sel],
        empty=[b("TABLE", "t1", rel=[("CHILD", ["gone"])]), b("TABLE", "t2"), b("TABLE", "t3", rel=[("CHILD", [])])],
        two=[b("TABLE", "t", rel=[("CHILD", ["a"]), ("CHILD", ["b"])]), cell("a", 1, children=["w"]), cell("b", 2), word("w", "x")],
    )
    rows = {}
    for r in ocr.extract_tables(blocks).orderBy("tablePos").collect():
        rows.setdefault(r.documentId, []).append(r.rows)
    assert rows == {"gap": [[[], ["x "], ["x NOT_SELECTED, ", "", "x "]]], "empty": [[[]], [], [[]]], "two": [[["x "], [""]]]}
    csv = {r.documentId: r.table for r in ocr.tables_rows(ocr.extract_tables(blocks)).collect()}
    assert csv["two"] == [["Table"], ["x "], [""], [], []]
    assert csv["empty"] == [["Table"], [], [], [], ["Table"], [], [], ["Table"], [], [], []]


def document(spark):
    return blocks_of(spark, d=[
        b("PAGE", "p1"), b("LINE", "l1", Text="Mail a@b.org, now"), kv("k", "KEY", [("CHILD", ["w"]), ("VALUE", ["v"])]),
        kv("v", "VALUE", [("CHILD", ["w"])]), word("w", "Wo,rd"),
        b("PAGE", "p2"), b("TABLE", "t", rel=[("CHILD", ["c"])]), cell("c", 1, children=["w"]),
        b("LINE", "l2", Text="")], none=[])


def test_outputs_round_trip(spark, tmp_path):
    blocks = document(spark)
    objects = spark.createDataFrame([("d", "d/in/x.pdf"), ("none", "none/y.pdf")], "documentId STRING, objectName STRING")
    out = outputs.page_outputs(blocks, objects, forms=True, tables=True)
    assert [(r.documentId, r.reason) for r in out.rejected.collect()] == [("none", "no pages found in document")]
    path = str(tmp_path / "table")
    outputs.write_lines(out.accepted, path)
    files = {}
    for r in spark.read.parquet(path).orderBy("path", "ord").collect():
        files.setdefault(r.path.removeprefix("d/in/x.pdf/ocr-analysis/"), []).append(r.line)
    assert files["page-1/text.txt"] == [None, "Mail a@b.org, now"] and files["page-2/text.txt"] == [None, ""]
    assert files["page-1/forms.csv"] == ["Key,Value", '"Wo,rd","Wo,rd"'] and files["page-2/forms.csv"] == ["Key,Value"]
    assert files["page-2/tables.csv"] == ["Table", '"Wo,rd "', "", ""] and "page-1/tables.csv" not in files
    assert [x["Id"] for x in json.loads("".join(files["page-1/response.json"]))] == ["p1", "l1", "k", "v", "w"]
    assert [x["Id"] for x in json.loads("".join(files["page-2/response.json"]))] == ["p2", "t", "c", "l2"]
    assert len(json.loads("".join(files["fullresponse.json"]))["Blocks"]) == 9

    bare = outputs.page_outputs(blocks_of(spark, e=[b("PAGE", "p")]), spark.createDataFrame([("e", "e/z.pdf")], objects.schema))
    outputs.write_lines(bare.accepted, str(tmp_path / "bare"), per_file=True)
    sizes = {str(f.relative_to(tmp_path / "bare")): f.stat().st_size for f in (tmp_path / "bare").rglob("*") if f.is_file()}
    assert sizes["e/z.pdf/ocr-analysis/page-1/text.txt"] == 0 and sizes["e/z.pdf/ocr-analysis/page-1/response.json"] > 2
    folder = str(tmp_path / "files")
    outputs.write_lines(out.accepted.where(F.col("path").endswith("fullresponse.json")), folder, per_file=True)
    again = ocr.explode_blocks(ocr_files.read_ocr_responses(spark, folder).accepted)
    assert again.count() == 9
    order = ["documentId", "pos"]
    assert again.select(*blocks.columns).orderBy(order).collect() == blocks.orderBy(order).collect()


def test_search_records(spark, tmp_path):
    records = annotate.page_search_record(document(spark))
    first, second = records.orderBy("page").collect()
    assert first.text == "Mail a@b.org, now\n" and first.Entities == {"EMAIL": "a@b.org"} and first.forms == [["Wo,rd", "Wo,rd"]]
    assert first.KeyPhrases == ["Mail a@b", "org", "now"] and first.table == []
    assert second.text == "\n" and second.KeyPhrases == [] and second.table == [["Table"], ["Wo,rd "], [], []]
    names = spark.createDataFrame([("d", "in/x.pdf")], "documentId STRING, documentName STRING")
    path = str(tmp_path / "notes")
    outputs.write_annotations(records, names, path)
    lines = spark.read.parquet(path).orderBy("ord").collect()
    assert {r.path for r in lines} == {"d/in/x.pdf/comprehend-output.json"}
    assert [p["page"] for p in json.loads("".join(r.line for r in lines))] == [1, 2]
    hits = search.search_index(records, ["ORG", "now"])
    assert [r.page for r in hits.collect()] == [1]
    assert search.search_index(records, ["org", "absent"]).count() == 0
    index = search.upsert_search_index(None, records, key="document")
    assert [r.page for r in index.collect()] == [2]
    revised = records.where("page = 2").withColumn("text", F.lit("new"))
    assert {r.page: r.text for r in search.upsert_search_index(records, revised).collect()} == {1: "Mail a@b.org, now\n", 2: "new"}


def test_search_records_are_made_once(spark):
    """Pages are not built again for their annotations, nor records for the end of their file; a page without chunks stays."""
    blocks = blocks_of(spark, d=[b("PAGE", "p1"), b("LINE", "l1", Text="Mail a@b.org"), b("PAGE", "p2")], e=[b("WORD", "w")])
    records = annotate.page_search_record(blocks)
    documents = spark.createDataFrame([("d", "in/x.pdf"), ("e", "in/y.pdf")], "documentId STRING, documentName STRING")
    lines = outputs.annotation_lines(records, documents)
    windows = len(nodes(ocr.pages(blocks), "Window"))
    assert windows > 0 and len(nodes(records, "Window")) == len(nodes(lines, "Window")) == windows
    assert {(r.documentId, r.page): (r.text, r.KeyPhrases, r.Entities) for r in records.collect()} == {
        ("d", 1): ("Mail a@b.org\n", ["Mail a@b", "org"], {"EMAIL": "a@b.org"}), ("d", 2): ("", [], {}), ("e", 1): ("", [], {})}
    texts = {}
    for r in lines.orderBy("path", "ord").collect():
        texts[r.documentId] = texts.get(r.documentId, "") + r.line
    assert {d: [p["page"] for p in json.loads(t)] for d, t in texts.items()} == {"d": [1, 2], "e": [1]}


def test_annotator_failure_marks_only_its_text(spark):
    def shout(texts):
        for t in texts:
            if "bad" in t:
                raise ValueError("no")
            yield [t.upper()], {"KIND": t}

    pages = spark.createDataFrame([("d", 1, "one"), ("d", 2, "bad"), ("e", 1, "two")],
                                  "documentId STRING, page INT, text STRING").coalesce(1)
    notes = annotate.annotate_text(annotate.chunk_text(pages), shout)
    merged = {(r.documentId, r.page): (r.KeyPhrases, r.Entities, r.error) for r in annotate.merge_annotations(notes).collect()}
    assert merged == {("d", 1): (["ONE"], {"KIND": "one"}, None), ("d", 2): ([], {}, "no"), ("e", 1): (["TWO"], {"KIND": "two"}, None)}
    failed = annotate.annotation_status(annotate.merge_annotations(notes)).where("not ok").collect()
    assert [(r.documentId, r.message) for r in failed] == [("d", "Could not send text to Comprehend.")]


def test_merge_keeps_duplicates_and_the_last_entity(spark):
    notes = spark.createDataFrame([
        ("d", 1, ["b", "a"], {"X": "2", "Y": "y"}, None), ("d", 0, ["a"], {"X": "1", "Z": "z"}, None), ("d", 2, [], {}, None)],
        "documentId STRING, chunkOrd INT, KeyPhrases ARRAY<STRING>, Entities MAP<STRING,STRING>, error STRING")
    row = annotate.merge_annotations(notes, ["documentId"]).first()
    assert row.KeyPhrases == ["a", "b", "a"] and row.Entities == {"X": "2", "Y": "y", "Z": "z"}


def test_parts_are_joined_in_order(spark, tmp_path):
    job = tmp_path / "o.pdf" / "textract-output" / "job-1"
    job.mkdir(parents=True)
    (job / "-access-check").write_text("{}")
    for n in range(1, 13):
        # every page goes on in the next part
        page = [{"BlockType": "PAGE", "Id": f"p{n}"}] if n % 2 == 0 else []
        body = [] if n == 1 else page + [{"BlockType": "LINE", "Id": f"l{n}", "Text": str(n)}]
        (job / str(n)).write_text(json.dumps({"Blocks": body}))
    bad = tmp_path / "q.pdf" / "textract-output" / "job-4"
    bad.mkdir(parents=True)
    for n, text in ((1, '{"Blocks":[{"BlockType":"PAGE","Id":"p"}]}'), (2, '{"Blocks":[{'), (3, '{"Blocks":[]}')):
        (bad / str(n)).write_text(text)
    out = ocr_files.read_ocr_parts(spark, str(tmp_path), "*")
    assert [(r.part, r.reason) for r in out.rejected.collect()] == [(2, "failed to parse OCR response")]
    parts = out.accepted
    notices = spark.createDataFrame([("job-1", "doc", True)], "jobId STRING, documentId STRING, ok BOOLEAN")
    blocks = ocr_files.blocks_of_jobs(ocr_files.concat_parts(parts), notices)
    assert blocks.agg(F.min("pos")).first()[0] == 0
    noted = spark.createDataFrame([("job-1", "doc", "b", "o", True), ("job-2", "e", "b", "o", True), ("job-3", "f", "b", "o", False), ("job-4", "g", "b", "o", True)],
                                  "jobId STRING, documentId STRING, bucketName STRING, objectName STRING, ok BOOLEAN")
    lost = ocr_files.jobs_without_results(noted, parts, "results").collect()
    assert sorted((r.jobId, r.ok) for r in lost) == [("job-2", False), ("job-4", False)]
    assert all(r.message.endswith(f"under job Name {r.jobId}") for r in lost)
    twice = notices.unionByName(spark.createDataFrame([("job-0", "doc", True)], notices.schema))
    assert ocr_files.blocks_of_jobs(ocr_files.concat_parts(parts), twice).count() == blocks.count()
    texts = ocr.page_text(ocr.page_lines(blocks)).orderBy("page").collect()
    assert [(r.page, r.text) for r in texts] == [
        (i, f"{2 * i}\n{2 * i + 1}\n" if i < 6 else "12\n") for i in range(1, 7)]


def test_geometry(spark):
    point = {"X": 0.5, "Y": 0.25}
    box = {"Width": 1.0, "Height": 2.0, "Left": 3.0, "Top": 4.0}
    blocks = blocks_of(spark, d=[b("WORD", "w", Geometry={"BoundingBox": box, "Polygon": [point]}), b("WORD", "v")])
    one, two = ocr.geometry_columns(blocks).orderBy("pos").collect()
    assert (one.width, one.height, one.left, one.top, one.polygon[0].X) == (1.0, 2.0, 3.0, 4.0, 0.5)
    assert two.width is None and two.polygon == []


@pytest.mark.parametrize("kind,count", [("CHILD", 2), ("VALUE", 1)])
def test_children_by_relationship(spark, kind, count):
    blocks = blocks_of(spark, d=[b("KEY_VALUE_SET", "k", rel=[("CHILD", ["w", "x"]), ("VALUE", ["w"])]), word("w", "1"), word("x", "2")])
    assert ocr.block_children(blocks, kind).count() == count


def test_whole_responses_are_read_one_by_one(spark, tmp_path):
    rows = [(f"d{i}", [b("WORD", f"w{j}", Text="x") for j in range(50)]) for i in range(20)]
    spark.createDataFrame(rows, f"documentId STRING, Blocks ARRAY<{S.BLOCK}>").write.parquet(str(tmp_path / "r"))
    blocks = ocr.explode_blocks(spark.read.parquet(str(tmp_path / "r")))
    assert "Batched: false" in nodes(blocks, "Scan parquet")[0] and blocks.count() == 1000


def mixed_document(n):
    return [
        b("PAGE", "p"), b("LINE", "l", Text="a b", rel=[("CHILD", ["w1", "gone", "w2"])]), word("w1", "old"), word("w1", f"a{n}"), word("w2", "b"),
        b("KEY_VALUE_SET", "k", EntityTypes=["KEY"], rel=[("CHILD", ["w1"]), ("VALUE", ["v"])]),
        b("KEY_VALUE_SET", "v", EntityTypes=["VALUE"], rel=[("CHILD", ["w2", "w1"])]), b("KEY_VALUE_SET", "k2", EntityTypes=["KEY"], rel=[("CHILD", ["w2"])]),
        b("TABLE", "t", rel=[("CHILD", ["c1", "gone", "c2"])]), b("CELL", "c1", RowIndex=1, rel=[("CHILD", ["w2"])]),
        b("CELL", "c2", RowIndex=2), b("TABLE", "t2", rel=[("CHILD", [])]), b("TABLE", "t3")]


OPERATORS = {
    "lines": (ocr.extract_lines, 3), "children": (lambda x: ocr.block_children(x, "CHILD"), 2), "cells": (ocr.cell_text, 2),
    "table cells": (ocr.table_cells, 3), "keys": (ocr.field_key_text, 3), "pairs": (ocr.key_value_pairs, 2),
    "values": (ocr.field_value_text, 5), "structures": (ocr._structures, 3)}


@pytest.mark.parametrize("name", OPERATORS)
def test_blocks_move_once_to_their_document(spark, monkeypatch, name):
    """Blocks and what lists them are placed by document and not moved again; hot documents give the same rows."""
    operator, most = OPERATORS[name]
    blocks = blocks_of(spark, a=mixed_document(1), b=mixed_document(2), c=[b("LINE", "l", Text="x")])
    near = operator(blocks)
    assert len(nodes(near, "Exchange")) <= most and all("documentId" in x for x in nodes(near, "Exchange"))
    monkeypatch.setattr(ocr, "HOT_BLOCKS", 5)
    hot = operator(blocks)
    assert len(nodes(hot, "Exchange")) > most
    assert near.count() > 1 and sorted(map(str, hot.collect())) == sorted(map(str, near.collect()))


def test_documents_without_keys_and_tables_are_passed_over(spark):
    blocks = blocks_of(spark, a=mixed_document(1), b=mixed_document(2), c=[b("LINE", "l", Text="x")])
    got = ocr.page_content(blocks)
    assert any("_part" in x for x in nodes(got, "BroadcastHashJoin"))
    assert {(r.documentId, r.kind) for r in got.collect()} == {("c", "line")} | {(d, k) for d in "ab" for k in ("line", "field", "table")}

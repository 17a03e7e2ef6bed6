"""What queries and operators move."""

from plans import nodes
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow import session
from docflow.operators import ocr
from docflow.plans import notes
from docflow.sources import outputs


def test_document_chain_moves_no_blocks_for_their_document(spark, tmp_path):
    rows = [(i, "one two\nthree", "en", "web") for i in range(60)]
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING").write.parquet(str(tmp_path / "documents.parquet"))
    out = notes.document_chain(spark, str(tmp_path))
    assert not any("Text#" in x for x in nodes(out, "Exchange"))
    got = out.collect()
    done = [r for r in got if r.finished]
    assert 0 < len(done) < len(got) == len({r.documentId for r in got})
    # a response that begins with an outdated block has one more page
    assert {r.pages for r in done} == {1, 2} and all(r.pages is None for r in got if not r.finished)


def test_nodes_move_as_plain_columns(spark):
    given = [("d", [("LINE", "l", "a b", ["w1", "w2", "gone"]), ("WORD", "w1", "old", None), ("WORD", "w1", "a", None), ("WORD", "w2", "b", None)])]
    rows = [(d, n, kind, id_, text, None if ids is None else [("CHILD", ids)], 1.5) for d, blocks in given for n, (kind, id_, text, ids) in enumerate(blocks)]
    blocks = spark.createDataFrame(rows, f"documentId STRING, pos BIGINT, BlockType STRING, Id STRING, Text STRING, Relationships {S.RELATIONSHIPS}, Confidence DOUBLE").withColumns(
        {c: F.lit(None).cast("string") for c in ("SelectionStatus", "Geometry")})
    children, lines = ocr.block_children(blocks, "CHILD"), ocr.extract_lines(blocks)
    for df in (children, lines):
        assert nodes(df, "Exchange") and not any("_child#" in x for x in nodes(df, "Exchange"))
    assert [(r.ord, r.childId, r.childPos, r.childType, r.childText) for r in children.orderBy("ord").collect()] == [
        (0, "w1", 2, "WORD", "a"), (1, "w2", 3, "WORD", "b")]
    assert [tuple(w) for w in lines.first().words] == [("w1", "a", 1.5), ("w2", "b", 1.5)]


def test_lines_are_made_once_to_be_written(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    lines = spark.range(500).selectExpr("concat('f', id % 7) as path", "named_struct('a', id, 'b', 0L) as ord", "cast(id as string) as line")
    outputs.write_lines(lines.mapInArrow(count, lines.schema), str(tmp_path / "out"))
    assert made.value == 500 and spark.read.parquet(str(tmp_path / "out")).count() == 500


def test_only_what_a_write_shuffled_is_deleted(spark, tmp_path):
    """The rows of a query may be fetched one by one; a written table leaves no shuffle files."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    groups = spark.range(5000).repartition(8, "id").groupBy((F.col("id") % 50).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before = spark.conf.get(key, "false")
    assert session.written(groups, "groups").count() == 50 and spark.conf.get(key, "false") == before == "false"
    assert sorted((r.k, r.n) for r in groups.toLocalIterator()) == [(k, 100) for k in range(50)]

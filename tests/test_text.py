from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docflow.functions import names
from docflow.functions.text import csv_line, csv_text, entities, key_phrases, text_chunks


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return df.select(column.alias("x")).first().x


def cut(data: bytes, limit: int) -> list[bytes]:
    """The cutting rule, restated: the first space at or after the limit ends a chunk."""
    out = []
    while len(data) > limit:
        at = data.find(b" ", limit)
        if at < 0:
            break
        out.append(data[:at])
        data = data[at:]
    return out + [data] if data else out


def test_chunk_edges(spark):
    def chunks(text):
        return one(spark, text_chunks("t"), t=text)

    assert chunks("") == []
    assert chunks("a" * 4096) == ["a" * 4096]
    assert chunks("a" * 4097) == ["a" * 4097]
    assert chunks("a" * 4096 + " b") == ["a" * 4096, " b"]
    assert chunks("é" * 2100 + " b c") == ["é" * 2100, " b c"]
    assert chunks("x" + "é" * 2048 + " tail") == ["x" + "é" * 2048, " tail"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab é\n€", max_size=40), max_size=6))
def test_chunks_equal_the_rule_and_concatenate(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    for r in df.select("t", text_chunks("t", 7).alias("c")).collect():
        assert [c.encode() for c in r.c] == cut(r.t.encode(), 7)
        assert "".join(r.c) == r.t


def test_csv_quoting(spark):
    row = F.array(*[F.lit(v) for v in ("plain", "a,b", 'say "x"', "two\nlines", " lead", "trail ", "", "\\.")])
    assert one(spark, csv_line(row)) == 'plain,"a,b","say ""x""","two\nlines"," lead",trail ,,"\\."'
    ragged = F.array(F.array(F.lit("Table")), F.array(F.lit("a"), F.lit("b")), F.array().cast("array<string>"))
    assert one(spark, csv_text(ragged)) == "Table\na,b\n\n"
    assert one(spark, csv_text(F.array(F.array(F.lit("k"), F.lit("v"))), ["Key", "Value"])) == "Key,Value\nk,v\n"


def test_names(spark):
    def ext(key):
        return one(spark, names.extension("k"), k=key), one(spark, names.base_name("k"), k=key)

    assert ext("a/b.c/d") == ("", "d")
    assert ext(".pdf") == (".pdf", "")
    assert ext("a.") == (".", "a")
    assert ext("x.PDF") == (".PDF", "x")
    assert ext("dir/x.tar.gz") == (".gz", "x.tar")
    path = "id-1/in/a.pdf/ocr-analysis/page-1/text.txt"
    assert one(spark, names.path_document_id("k"), k=path) == "id-1"
    assert one(spark, names.path_document_name("k"), k=path) == "in/a.pdf"
    assert one(spark, names.is_full_response("k"), k="x/fullresponse.json")
    assert not one(spark, names.is_full_response("k"), k="x/myfullresponse.json")


def test_message_time_cuts_nanoseconds_only_in_the_parsed_column(spark):
    t = one(spark, names.message_time("t").cast("string"), t="2024-03-01 10:00:00.123456789 +0000 UTC")
    assert t == "2024-03-01 10:00:00.123456"
    assert one(spark, names.message_time("t").cast("string"), t="2024-03-01 10:00:00 +0000 UTC") == "2024-03-01 10:00:00"


def test_caller_takes_both_forms(spark):
    assert one(spark, names.caller_map("c"), c='{"principalId":"p"}') == {"principalId": "p"}
    assert one(spark, names.caller_map("c"), c="arn:x") == {"arn": "arn:x"}


def test_built_in_annotator(spark):
    text = "The quick brown fox, and the dog. Mail a.b@c.org or d@e.com on 2024-01-02!"
    assert one(spark, key_phrases("t"), t=text) == [
        "quick brown fox", "dog", "Mail", "b@c", "org", "d@e", "com", "2024-01-02"]
    assert one(spark, entities("t"), t=text) == {"DATE": "2024-01-02", "EMAIL": "d@e.com", "QUANTITY": "02"}
    assert one(spark, entities("t"), t="nothing") == {}

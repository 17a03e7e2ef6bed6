"""Secret scans over a ledger of content-addressed blobs.

Every version of every path is a blob, named by the digest of its bytes. A blob
is scanned once per rule version; the findings are joined back to all paths.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored, text_bytes
from docflow.session import scratch_dir

RULE_VERSION = "1"
# kinds in the order in which spans with one start are listed; the first three are the base
KINDS = ("assign", "access", "hex", "private_key", "web_token")
BROADCAST_SPANS = 500_000  # of 20 bytes each; above that findings are joined by a shuffle
SPANS = "array<struct<start:bigint,end:bigint,kind:int>>"

# Matched on the text with A-Z in lower case. The classes hold no letter whose case matters.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ASSIGN_WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_HEX_ONLY = bytes(49 if c in b"0123456789abcdef" else 32 for c in range(256))
# Each is searched once along the text: marks are paired afterwards, and a run of letters is entered at its start only.
_KEY_MARK = re.compile(rb"(?=-----(BEGIN|END) [A-Z ]{0,30}PRIVATE KEY-----)")
_WEB_TOKEN = re.compile(
    rb"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?(?=eyJ))(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)")


def _private_keys(text: bytes) -> list[tuple[int, int]]:
    """From each BEGIN line to the first END line after it; a BEGIN without END is none."""
    found, start, after = [], None, 0
    for m in _KEY_MARK.finditer(text):
        at, end = m.start(), text.index(b"KEY-----", m.start()) + 8
        if m[1] == b"BEGIN" and start is None and at >= after:
            start, after = at, end
        elif m[1] == b"END" and start is not None and at >= after:
            found.append((start, end))
            start, after = None, end
    return found


def scan(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` in code points by start, then kind. Cheap searches skip clean texts."""
    found, lower = [], text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(lower) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"1" * 32 in text.translate(_HEX_ONLY):
        found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text) if m.end() - m.start() >= 32]
    if b"PRIVATE KEY-----" in text:
        found += [(a, b, 3) for a, b in _private_keys(text)]
    if b"eyJ" in text:
        found += [(*m.span(1), 4) for m in _WEB_TOKEN.finditer(text)]
    if not found:
        return []
    ends = sorted({p for s, e, _ in found for p in (s, e)})
    points, at, before = {}, 0, 0
    for p in ends:
        before += len(text[at:p].decode("utf-8", "surrogatepass"))
        points[p], at = before, p
    return sorted((points[s], points[e], k) for s, e, k in found)


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """``(blob, spans)`` from ``(blob, text)``."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(("start", "end", "kind"), x, strict=True)) for x in scan(t)] for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["blob", "spans"])

    return blobs.mapInArrow(run, f"blob binary, spans {SPANS}")


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def update_ledger(docs: DataFrame, ledger: str | None = None, text_col: str = "text") -> DataFrame:
    """Scan the blobs of ``docs`` that the ledger lacks for this rule version, append them, return the ledger.

    ``ledger`` is a folder that all executors share; without it an empty one is
    started. Copies of a blob are combined before they are shuffled and scanned once.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_dir(spark, "llm-secret-ledger")
    blobs = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        blob_of(F.col("text")).alias("blob"), "text")
    known = stored(spark, ledger)
    if known is not None:
        blobs = blobs.join(known.where(F.col("rule_version") == RULE_VERSION).select("blob"), "blob", "left_anti")
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    scan_blobs(unseen).withColumn("rule_version", F.lit(RULE_VERSION)).write.mode("append").parquet(ledger)
    return spark.read.parquet(ledger).where(F.col("rule_version") == RULE_VERSION).groupBy("blob").agg(
        F.first("spans").alias("spans"))


def find_secrets(docs: DataFrame, ledger: str | None = None, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """All rows and columns of ``docs`` with ``spans_col``: the findings of the row's text.

    Only blobs with findings are joined back, so texts move where those are too many to broadcast, and not else.

    Positions are code points, ends exclusive; ``kind`` is an index into
    ``KINDS``. Null and empty texts have no spans. Repeated rows are kept, each
    with its findings; a column of ``docs`` named ``spans_col`` is replaced. An
    empty table gives an empty result.
    """
    found = update_ledger(docs, ledger, text_col).where(F.size("spans") > 0).select(
        F.col("blob").alias("_blob"), F.col("spans").alias("_found"))
    if (found.agg(F.sum(F.size("_found") + 2)).first()[0] or 0) <= BROADCAST_SPANS:
        found = F.broadcast(found)
    keyed = docs.drop(spans_col).withColumn("_blob", blob_of(F.coalesce(F.col(text_col), F.lit(""))))
    return keyed.join(found, "_blob", "left").withColumn(
        spans_col, F.coalesce("_found", F.array().cast(SPANS))).drop("_blob", "_found")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``[kind]``; overlapping spans share the mark of the first."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    step = F.aggregate(
        F.sort_array(spans), F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.struct(
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                F.get(names, s["kind"]))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, step).otherwise(text)


def described(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    at = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == at)).cast("bigint")

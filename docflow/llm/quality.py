"""Quality rules and a hashed n-gram likelihood ratio between trusted text and the raw corpus.

Byte n-grams are hashed into ``2**bits`` buckets and counted over all documents
(raw) and over those with a trusted label (target). A text's score is the mean
over its n-grams of ``log(p_target / p_raw)``, so its length does not matter.
Every document is judged by the same threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from docflow.llm.common import text_buffers, text_bytes, when_small, written
from docflow.llm.words import find_words, mixed, word_hashes

GRAM = 3
BITS = 16
THRESHOLD = -0.4
MIN_WORDS = 50
REPEATED = 50  # percent of words in repeated windows, at most

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def buckets(data: np.ndarray, offsets: np.ndarray, gram: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram and the index of its text; none crosses from one text to the next."""
    n = max(0, len(data) - gram + 1)
    value = np.zeros(n, dtype=np.uint64)
    for i in range(gram):
        value = (value << np.uint64(8)) | data[i : n + i]
    found = ((value + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    sizes = np.maximum(np.diff(offsets) - gram + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return found[offsets[:-1][text] + within], text


def count_grams(docs: DataFrame, trusted: DataFrame, gram: int, bits: int) -> DataFrame:
    """``(bucket, raw, target)`` over all rows of ``(doc_id, text)``; tasks send sums of what they read."""
    flagged = docs.join(when_small(trusted.withColumn("good", F.lit(True))), "doc_id", "left").select(
        F.coalesce("good", F.lit(False)).alias("good"), "text")

    def run(batches):
        raw, target = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            good = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, offsets in text_buffers(batch.column(1)):
                found, text = buckets(data, offsets, gram, bits)
                raw += np.bincount(found, minlength=1 << bits)
                target += np.bincount(found[good[first : first + len(offsets) - 1][text]], minlength=1 << bits)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, raw[at], target[at])], ["bucket", "raw", "target"])

    return flagged.mapInArrow(run, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, bits: int) -> np.ndarray:
    """One weight per bucket, by counts plus one; all 0 without trusted text."""
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for r in counts.collect():  # at most 2**bits rows
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.any():
        return np.zeros(1 << bits)
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def _duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, n = set(), 0
    for line in lines:
        if line.strip():
            n += line in seen
            seen.add(line)
    return n


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text: words, code points in words, symbols, words in repeated windows of three."""
    n = len(offsets) - 1
    starts, ends, texts = find_words(data, offsets)

    def per_text(mask):
        return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])

    n_words = np.bincount(texts, minlength=n)
    repeated = np.zeros(len(starts), dtype=bool)
    if len(starts) > 2:
        h = word_hashes(data, starts, ends)
        window = mixed(mixed(mixed(h[:-2]) + h[1:-1]) + h[2:]) ^ mixed(texts[2:].astype(np.uint64) + np.uint64(1))
        inside = np.flatnonzero(texts[2:] == texts[:-2])
        _, which, times = np.unique(window[inside], return_inverse=True, return_counts=True)
        again = inside[times[which] > 1]
        for i in range(3):
            repeated[again + i] = True
    return [n_words, per_text(((data & 0xC0) != 0x80) & ~_BLANK[data]), per_text(_SYMBOL[data]),
            np.bincount(texts[repeated], minlength=n)]


NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    gram: int = GRAM, bits: int = BITS, threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows and columns of ``docs`` with the five numbers, ``quality_score``, ``base_failed`` and ``kept``.

    ``kept`` is false where ``base_failed`` or the score is below ``threshold``.
    Null texts have no words. Texts shorter than an n-gram score 0, as do all
    texts where no label is trusted (1). Repeated rows count as often as they
    occur; an id that is trusted once is trusted. Rows with a null id are raw
    text. Columns of ``docs`` with the added names are replaced; an empty table
    gives an empty result. Labels never decide about a document themselves.
    """
    trusted = written(labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("doc_id")).distinct(), "trusted")
    raw = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    weights = log_ratios(count_grams(raw, trusted, gram, bits), bits)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    own = [*NUMBERS, "quality_score"]
    kept = docs.drop(*own, "base_failed", "kept")
    names = [*kept.columns, *own]
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            text = batch.column(at)
            columns = [[] for _ in own]
            lines = [_duplicate_lines(x) for x in text_bytes(text)]
            for first, data, offsets in text_buffers(text):
                words, chars, symbols, repeats = measure(data, offsets)
                found, of = buckets(data, offsets, gram, bits)
                sums = np.bincount(of, weights=sent.value[found], minlength=len(words))
                score = sums / np.maximum(1, np.bincount(of, minlength=len(words)))
                part = lines[first : first + len(words)]
                for column, values in zip(columns, (words, chars, symbols, part, repeats, score), strict=True):
                    column.extend(values)
            new = [pa.array(np.asarray(c), pa.float64() if n == own[-1] else pa.int64()) for n, c in zip(own, columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    schema = StructType([*kept.schema.fields, *(StructField(n, LongType()) for n in NUMBERS), StructField(own[-1], DoubleType())])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return kept.mapInArrow(run, schema).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold))

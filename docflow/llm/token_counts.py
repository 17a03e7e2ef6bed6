"""Token counts through a cache keyed by content and tokenizer-version digests."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored, text_bytes
from docflow.session import scratch_dir

WORDS_KEPT = 1_000_000
TEXTS_AT_ONCE = 200
_LOADED: dict = {}


class _Counter(dict):
    """Tokens of a word (no ASCII white space inside), as the tokenizer gives them."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def learn(self, words: list[bytes]) -> None:
        """Count new words in one call; the places of the tokens tell the words apart."""
        if len(self) + len(words) > WORDS_KEPT:
            self.clear()
        text = [w.decode() for w in words]
        starts = np.cumsum([0, *(len(x) + 1 for x in text[:-1])])
        found = self.tokenizer.encode(" ".join(text), add_special_tokens=False)
        places = np.fromiter((a for a, _ in found.offsets), dtype=np.int64, count=len(found.ids))
        counts = np.bincount(np.searchsorted(starts, places, side="right") - 1, minlength=len(words))
        self.update(zip(words, counts.tolist(), strict=True))

    def totals(self, texts: list[bytes]) -> list[int]:
        out = []
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            known, new = [], []
            for text in texts[i : i + TEXTS_AT_ONCE]:
                # the tokenizer has no case, but its special strings do
                words = (text if b"<|" in text else text.lower()).split()  # ASCII white space only
                counts = list(map(self.get, words))
                missing = [w for w, c in zip(words, counts, strict=True) if c is None] if None in counts else []
                new += missing
                known.append((sum(filter(None, counts)), missing))
            if new:
                self.learn(list(dict.fromkeys(new)))
            out += [n + sum(map(self.__getitem__, missing)) for n, missing in known]
        return out


def _counter(spec: str, version: str) -> _Counter:
    if version not in _LOADED:
        _LOADED.clear()
        _LOADED[version] = _Counter(spec)
    return _LOADED[version]


def version_of(spec: str) -> str:
    return hashlib.sha256(spec.encode()).hexdigest()


def normalised(text):
    """Runs of ASCII white space become one space, none at the ends.

    For a tokenizer that drops white space and never joins across it, this
    changes no count; case is kept, as special strings depend on it.
    """
    return F.trim(F.regexp_replace(text, "[ \\t\\n\\x0B\\f\\r]+", " "))


def encode_counts(texts: DataFrame, spec: str) -> DataFrame:
    """``(digest, n_tokens)`` from ``(digest, text)``. Words are counted once per task and added up per text."""
    shared, version = texts.sparkSession.sparkContext.broadcast(spec), version_of(spec)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counts = _counter(shared.value, version)
        for batch in batches:
            found = counts.totals(text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens bigint")


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 2048,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    ``tokenizer`` is the path of a ``tokenizers`` file whose normaliser drops
    case and white space. ``cache`` is a folder that all executors share; it holds
    ``(digest, version, n_tokens)`` and grows by what this call had to encode.
    Without it the call starts with an empty cache. Texts whose digest is stored
    are not encoded; copies are encoded once. Null and empty texts have 0 bytes
    and 0 tokens. Null ids and repeated rows are kept; other columns are ignored.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    version = version_of(spec)
    cache = cache or scratch_dir(spark, "llm-token-cache")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2(normalised(F.col("text")), 256)))
    known = stored(spark, cache)
    misses = rows.select("digest", "text")
    if known is not None:
        misses = misses.join(known.where(F.col("version") == version).select("digest"), "digest", "left_anti")
    distinct = misses.groupBy("digest").agg(F.first("text").alias("text"))  # copies meet in their own task first
    encode_counts(distinct, spec).withColumn("version", F.lit(version)).write.mode("append").parquet(cache)
    counts = spark.read.parquet(cache).where(F.col("version") == version).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens"))
    return rows.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")).join(
        counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

"""Toxicity by logistic regression, trained with FTRL-proximal over hashed word features.

Features are the distinct words, pairs of neighbours and pairs with one word
between them, hashed into ``2**bits`` coordinates. Each coordinate has its own
learning rate, and the L1 term leaves few weights, which are broadcast to score
all documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import text_buffers, written
from docflow.llm.words import find_words, pairs, word_hashes

BITS = 20
CHUNK = 500_000  # bytes of text whose features are made at once
SAMPLE = 4000  # labelled documents per class, at most
SETTINGS = {"alpha": 1.0, "beta": 1.0, "l1": 10.0, "l2": 1.0, "rounds": 4}


def features(data: np.ndarray, offsets: np.ndarray, bits: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(text, coordinate)`` of the distinct features, sorted; ``wanted`` tells which coordinates matter."""
    starts, ends, texts = find_words(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    found = [(words, texts), pairs(words, texts), pairs(words, texts, skip=1)] if len(words) > 2 else [(words, texts)]
    if len(words) == 2:
        found.append(pairs(words, texts))
    at = np.concatenate([h >> np.uint64(64 - bits) for h, _ in found]).astype(np.int64)
    text = np.concatenate([t for _, t in found])
    if wanted is not None:
        keep = wanted[at]
        at, text = at[keep], text[keep]
    both = np.unique(text << np.int64(bits) | at)
    return both >> np.int64(bits), both & np.int64((1 << bits) - 1)


def train(rows: list[np.ndarray], labels: list[int], bits: int, alpha: float, beta: float, l1: float, l2: float,
          rounds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates and weights that are not zero, and the bias, which is not penalised."""
    z, n, bias, bias_n = np.zeros(1 << bits), np.zeros(1 << bits), 0.0, 0.0
    toxic = sum(labels)
    weight = {0: 1.0, 1: max(1.0, (len(labels) - toxic) / max(1, toxic))}  # both classes count the same

    def weights(at):
        big = np.abs(z[at]) > l1
        return np.where(big, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    for _ in range(rounds):
        for at, y in zip(rows, labels, strict=True):
            w = weights(at)
            g = weight[y] * (1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y)
            new = n[at] + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(n[at])) / alpha * w
            n[at] = new
            bias_n += g * g
            bias -= alpha / (beta + np.sqrt(bias_n)) * g
    at = np.flatnonzero(np.abs(z) > l1)
    return at, weights(at), bias


def held_out(ids: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, bits: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``(label, place, at)``: features of at most ``sample`` documents of each class, chosen by a digest of the id.

    Of documents that repeat an id, the text with the least digest is learned from.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # contradictory labels of one document count as toxic
    place = F.xxhash64(F.lit(7), "doc_id")
    once = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("place", place)
    chosen = once.where("label = 0").orderBy("place", "doc_id").limit(sample).unionByName(
        once.where("label = 1").orderBy("place", "doc_id").limit(sample))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # one row per id, combined before the shuffle: an id that documents repeat can't outgrow the sample
    joined = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "place").agg(
        F.min_by("text", F.sha2("text", 256)).alias("text")).select("label", "place", "text")

    def run(batches):
        for batch in batches:
            for first, data, offsets in text_buffers(batch.column(2), CHUNK):
                text, at = features(data, offsets, bits)
                cuts = np.searchsorted(text, np.arange(len(offsets)))
                part = slice(first, first + len(offsets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], pa.array(
                        [at[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:], strict=False)], pa.list_(pa.int32()))],
                    ["label", "place", "at"])

    return joined.mapInArrow(run, "label int, place bigint, at array<int>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", **settings) -> DataFrame:
    """``(at, weight)``: the model, with the bias at -1. One task trains on the bounded sample.

    Without labelled documents the model is the bias 0 alone.
    """
    settings = SETTINGS | settings
    rows = training_rows(docs, labels, sample, bits, id_col, text_col, label_col)

    def run(group):
        # alternate as the digests fall; ties and repeated rows in a fixed order
        group = group.assign(size=group["at"].map(len)).sort_values(["place", "label", "size"], kind="stable")
        at, weight, bias = train([np.asarray(x, dtype=np.int64) for x in group["at"]], group["label"].tolist(), bits, **settings)
        return pd.DataFrame({"at": np.append(at, -1), "weight": np.append(weight, bias)})

    return rows.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(run, "at bigint, weight double")


def score(docs: DataFrame, model: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    ``score`` is the logistic of the weights of the text's distinct features and
    the bias; a null or empty text has the bias alone. Ids may be null or repeated;
    other columns, labels among them, are ignored. An empty table gives an empty result.
    """
    rows = model.collect()  # at most 2**bits + 1, in practice a few hundred after the L1 term
    weights, bias = np.zeros(1 << bits, dtype=np.float32), 0.0
    for r in rows:
        if r["at"] < 0:
            bias = r.weight
        else:
            weights[r["at"]] = r.weight
    kept = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((kept, weights[kept], bias))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        at, values, base = sent.value
        table = np.zeros(1 << bits)
        table[at] = values
        for batch in batches:
            totals = [np.empty(0)]
            for _, data, offsets in text_buffers(batch.column(1), CHUNK):
                text, found = features(data, offsets, bits, table != 0)
                totals.append(np.bincount(text, weights=table[found], minlength=len(offsets) - 1) + base)
            total = np.clip(np.concatenate(totals), -500, 500)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-total)))], ["doc_id", "score"])

    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Train on ``labels`` outside the held-out fold, then score every row of ``docs``."""
    model = written(fit(docs, labels, id_col=id_col, text_col=text_col, **settings), "toxicity-model")
    return score(docs, model, settings.get("bits", BITS), id_col, text_col)

"""Toxicity: held-out accuracy, folds, and features against plain hashing."""

import math
import random
import zlib

import numpy as np
import pytest
from cases import texts
from pyspark.sql import functions as F

from docflow.llm import queries, toxicity
from docflow.llm.words import find_words, word_hashes


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def marked(ready):
    rng = random.Random(4)
    words, bad = [f"w{i}" for i in range(400)], ["vile", "nasty"]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        toxic = i % 4 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(bad)
        rows.append((i, " ".join(text), int(toxic)))
    docs = ready.createDataFrame([(i, t, 1, 0.5) for i, t, _ in rows], "doc_id bigint, text string, label int, score double").repartition(3)
    return docs, ready.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int"), rows


def test_held_out_accuracy(marked):
    docs, labels, rows = marked
    truth = {i: y for i, _, y in rows}
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == len(rows)
    assert all(r.held_out == held(r.doc_id) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in found)
    out = [r for r in found if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out)


def test_labels_of_the_held_out_fold_change_nothing(marked):
    docs, labels, _ = marked
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score_toxicity(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_edge_cases(ready, docs):
    labels = ready.createDataFrame([(4, 1), (5, 0), (8, 0), (8, 1), (1, 1), (None, 1), (6, None), (12, 0), (777, 1)], "doc_id bigint, toxic int")
    found = toxicity.score_toxicity(docs, labels).collect()
    assert sorted((str(r.doc_id) for r in found)) == sorted(str(i) for i, _ in texts())
    assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1


def test_nothing_to_learn_from(ready, docs, empty):
    none = ready.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.5}
    assert toxicity.score_toxicity(empty, none).count() == 0


def test_features():
    text = ["The cat sat", "", "one", "a b", " x  y\tz w \n"]
    raw = [t.encode() for t in text]
    offsets = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    starts, ends, of = find_words(data, offsets)
    assert [(int(t), bytes(data[a:b]).decode()) for a, b, t in zip(starts, ends, of, strict=True)] == [
        (i, w) for i, t in enumerate(text) for w in t.split()]
    which, at = toxicity.features(data, offsets, 20)
    assert [int((which == i).sum()) for i in range(5)] == [3 + 2 + 1, 0, 1, 3, 4 + 3 + 2]
    single = [toxicity.features(np.frombuffer(r, dtype=np.uint8), np.array([0, len(r)]), 20)[1].tolist() for r in raw]
    assert [at[which == i].tolist() for i in range(5)] == single
    upper = toxicity.features(np.frombuffer(raw[0].upper(), dtype=np.uint8), np.array([0, len(raw[0])]), 20)[1]
    assert upper.tolist() == single[0]
    twice = np.frombuffer(b"ab ab AB", dtype=np.uint8)
    h = word_hashes(twice, np.array([0, 3, 6]), np.array([2, 5, 8]))
    assert h[0] == h[1] != h[2]


def test_l1_leaves_few_weights():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(10, 1 << 12, 60)) for _ in range(400)]
    labels = [int(i % 2) for i in range(400)]
    rows = [np.unique(np.append(r, 3)) if y else r for r, y in zip(rows, labels, strict=True)]
    at, weights, bias = toxicity.train(rows, labels, 12, **toxicity.SETTINGS)
    assert len(at) < 1 << 9 and at[np.argmax(weights)] == 3 and math.isfinite(bias)


def plain_model(rows, alpha, beta, l1, l2, rounds):
    """FTRL-proximal one coordinate after the other; ``rows`` are lists of coordinates with a label."""
    z, n, bias, bias_n = {}, {}, 0.0, 0.0
    toxic = sum(y for _, y in rows)
    up = max(1.0, (len(rows) - toxic) / max(1, toxic))

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(rounds):
        for at, y in rows:
            w = {i: weight(i) for i in at}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()) + bias))))
            g = (p - y) * (up if y else 1.0)
            for i in at:
                rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
            bias_n += g * g
            bias -= alpha / (beta + math.sqrt(bias_n)) * g
    return {i: weight(i) for i in z}, bias


def coordinates(text):
    """Words, neighbours and pairs with one word between, hashed one text at a time."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return toxicity.features(raw, np.array([0, len(raw)]), toxicity.BITS)[1].tolist()


def plain_scores(ready, docs, labels):
    """Scores by a plain restatement of the whole operator; ``docs`` and ``labels`` are lists of pairs."""
    marks = {}
    for i, y in labels:
        if i is not None and y in (0, 1) and not held(i):
            marks[i] = max(y, marks.get(i, 0))
    place = {r.i: r.h for r in ready.createDataFrame([(i,) for i in marks], "i bigint").select("i", F.xxhash64(F.lit(7), "i").alias("h")).collect()}
    known = [(place[i], marks[i], coordinates(t)) for i, t in docs if i in marks]
    known.sort(key=lambda r: (r[0], r[1], len(r[2])))
    weights, bias = plain_model([(at, y) for _, y, at in known], **toxicity.SETTINGS)
    # weights are sent as single floats
    return {i: 1 / (1 + math.exp(-sum(float(np.float32(weights.get(a, 0.0))) for a in coordinates(t)) - bias)) for i, t in docs}


def test_scores_equal_a_plain_restatement(ready, marked):
    docs, labels, rows = marked
    want = plain_scores(ready, [(i, t) for i, t, _ in rows], [(i, y) for i, _, y in rows])
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 1e-6 for i in want)
    assert max(want.values()) - min(want.values()) > 0.5


def test_query_equals_a_plain_restatement(ready, sf_dir, sf_texts):
    labels = [(r.doc_id, r.toxic) for r in ready.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    want = plain_scores(ready, sf_texts, labels)
    found = {r.doc_id: r.score for r in queries.QUERIES["op2_toxicity"](ready, sf_dir).collect()}
    assert found.keys() == want.keys() and all(abs(found[i] - want[i]) < 1e-6 for i in want)


def test_repeated_ids_are_learned_from_once(ready, marked):
    docs, labels, _ = marked
    often = docs.where("doc_id % 50 = 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("copy")
    mixed = docs.unionByName(often).unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    train = toxicity.training_rows(mixed, labels, 4000, 20, "doc_id", "text", "toxic")
    assert train.count() == labels.where(~toxicity.held_out(F.col("doc_id"))).count()
    a = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    b = {(r.doc_id, r.score) for r in toxicity.score_toxicity(docs.unionByName(often), labels).collect()}
    assert set(a.items()) == b


def test_query(ready, sf_dir):
    """On the smallest table every document has a score; accuracy is measured on a larger one."""
    assert queries.QUERIES["op2_toxicity"](ready, sf_dir).count() == ready.read.parquet(f"{sf_dir}/documents.parquet").count()
    sf = "/root/testdata/sf0.1"
    found = queries.QUERIES["op2_toxicity"](ready, sf).where("held_out").join(ready.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert found.where("predicted = toxic").count() >= 0.9 * found.count()

"""Quality numbers against plain counting, verdicts against plain sums."""

import math
import random
import re
from collections import Counter

import pytest
from cases import rows_of, texts

from docflow.llm import quality, queries

NAMES = ("doc_id", *quality.NUMBERS, "base_failed")


def plain(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = set()
    for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if windows[w] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def score_of(rows, good):
    grams = [[x[i : i + 3] for i in range(len(x) - 2)] for x in ((t or "").encode() for _, t in rows)]
    key = {g: ((int.from_bytes(g, "big") + 1) * 0x9E3779B97F4A7C15 % 2**64) >> 48 for x in grams for g in x}
    raw, target = Counter(), Counter()
    for (i, _), x in zip(rows, grams, strict=True):
        raw.update(key[g] for g in x)
        if i in good:
            target.update(key[g] for g in x)
    total, best = raw.total() + 65536, target.total() + 65536

    def weight(k):
        return math.log((target[k] + 1) / best) - math.log((raw[k] + 1) / total) if target else 0.0

    return [sum(weight(key[g]) for g in x) / max(1, len(x)) for x in grams]


def extra():
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta"]
    line = " ".join(rng.choice(words) for _ in range(9))
    return [(100, "\n".join([line, line, "", "", " ", "x", line])), (101, " ".join(words * 30)), (102, "*** $$$ ||| <b>" * 30),
            (103, " ".join(f"{rng.randrange(10**6)}" for _ in range(60))), (104, "a b c a b c x"), (105, "é" * 3 + "\r\n" + "é" * 3)]


@pytest.fixture(scope="module")
def more(ready, docs):
    return docs.select("doc_id", "text", "n_tokens", "key").union(
        ready.createDataFrame([(*x, "n", "k") for x in extra()], docs.select("doc_id", "text", "n_tokens", "key").schema))


def test_edge_cases(ready, more):
    labels = ready.createDataFrame([(4, 1, 0), (8, 1, 0), (8, 1, 0), (102, 0, 0), (999, 1, 1), (None, 1, 0), (6, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    judged = quality.judge(more, labels)
    rows = texts() + extra()
    assert rows_of(judged, *NAMES) == sorted(((i, *plain(t)) for i, t in rows), key=str)
    scores = score_of(rows, {4, 8})
    got = sorted(((r.doc_id, r.text or "", r.quality_score, r.kept, r.base_failed) for r in judged.collect()), key=str)
    want = sorted(((i, t or "", s) for (i, t), s in zip(rows, scores, strict=True)), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], abs=1e-9) and g[3] == (not g[4] and w[2] >= quality.THRESHOLD)


def test_without_trusted_labels_rules_decide(ready, more):
    judged = quality.judge(more, ready.createDataFrame([], "doc_id bigint, quality int"))
    assert judged.where("quality_score != 0 or kept = base_failed").count() == 0


def test_empty(ready, empty):
    assert quality.judge(empty, ready.createDataFrame([], "doc_id bigint, quality int")).count() == 0


def test_query(ready, sf_dir, sf_texts):
    found = queries.QUERIES["op8_quality"](ready, sf_dir)
    assert rows_of(found, *NAMES) == sorted(((i, *plain(t)) for i, t in sf_texts), key=str)
    good = {r.doc_id for r in ready.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    scores = {i: s for (i, _), s in zip(sf_texts, score_of(sf_texts, good), strict=True)}
    for r in found.collect():
        assert r.quality_score == pytest.approx(scores[r.doc_id], abs=1e-9)


def test_verdicts_agree_with_labels(ready):
    """Documents with a good label stay and nine in ten of those with a bad one go."""
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES["op8_quality"](ready, sf).join(ready.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert found.where("quality = 1 and not kept and not base_failed").count() == 0
    assert n.get((0, False), 0) >= 0.9 * (n.get((0, False), 0) + n.get((0, True), 0))

"""Scored phrases, collocations and dictionary names against plain versions."""

import math
import random
import re
from collections import Counter

import pytest
from plans import nodes
from pyspark.sql import functions as F

from docflow.functions.text import key_phrases
from docflow.operators import keyed, phrases
from docflow.operators.keyed import may_be_among
from docflow.operators.search import WORD_BREAK

TEXTS = "id INT, text STRING"


def some_texts(seed, n=40):
    rng = random.Random(seed)
    words = ["the", "of", "Compatibility", "systems", "linear", "constraints", "set", "Numbers", "été", "a", "is"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" "] * 6 + [", ", ". ", "\n", "  "]) for _ in range(rng.randrange(60)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, "the of"), (None, "linear systems, linear set")]


def test_scored_phrases(spark):
    df = spark.createDataFrame(some_texts(1), TEXTS)
    want = {}
    for r in df.select("id", key_phrases("text").alias("p")).collect():
        listed = [p.lower().split(" ") for p in r.p or []]
        freq, degree = Counter(), Counter()
        for p in listed:
            for w in p:
                freq[w] += 1
                degree[w] += len(p)
        for p in listed:
            want[r.id, " ".join(p)] = (sum(q == p for q in listed), sum(degree[w] * 1_000_000 // freq[w] for w in p) / 1_000_000)
    scored = phrases.scored_phrases(df, ["id"])
    got = {(r.id, r.phrase): (r.n, r.score) for r in scored.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    for r in phrases.best_phrases(scored, ["id"], 3).collect():
        own = sorted((-got[k][1], k[1]) for k in got if k[0] == r.id)
        assert r.KeyPhrases == [p for _, p in own[:3]]


def test_word_collocations(spark):
    rows = some_texts(2, 80)
    counts = Counter()
    for _, text in rows:
        for piece in re.split(phrases.BREAKS, (text or "").lower()):
            w = [x for x in piece.split(" ") if x]
            counts.update(zip(w, w[1:], strict=False))
    total, first, second = sum(counts.values()), Counter(), Counter()
    for (a, b), n in counts.items():
        first[a] += n
        second[b] += n
    want = {p: (n, math.log(n * total / first[p[0]] / second[p[1]]) / math.log(total / n)) for p, n in counts.items() if n >= 3}
    got = {(r.first, r.second): (r.n, r.npmi) for r in phrases.word_collocations(spark.createDataFrame(rows, TEXTS), min_count=3).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-5) for k in want)
    only = spark.createDataFrame([(1, "x y"), (2, "x y")], TEXTS)
    assert [tuple(r) for r in phrases.word_collocations(only, min_count=1).collect()] == [("x", "y", 2, 1.0)]
    assert phrases.word_collocations(only.limit(0)).count() == 0


def brute_names(rows, names):
    cut = lambda t: tuple(w for w in re.split(WORD_BREAK, (t or "").lower()) if w)
    of = {}
    for name, kind in names:
        if name is not None and cut(name):
            of[cut(name)] = min((name, kind), of.get(cut(name), (name, kind)))
    longest = max(map(len, of), default=0)
    out = []
    for key, text in rows:
        w, at = cut(text), 0
        while at < len(w):
            n = next((n for n in range(min(longest, len(w) - at), 0, -1) if w[at : at + n] in of), 0)
            if n:
                out.append((key, at, n, *of[w[at : at + n]]))
            at += n or 1
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_a_large_dictionary(spark, monkeypatch, limit):
    monkeypatch.setattr(phrases, "NAMES_BROADCAST", limit)
    rng = random.Random(3)
    words = ["new", "york", "city", "Été", "of", "bank"] + [f"w{i}" for i in range(400)]
    names = {(" ".join(rng.choices(words, k=rng.randrange(1, 5))), rng.choice("ABC")) for _ in range(100_000)}
    names = [*names, ("New York", "P"), ("new-york", "Q"), ("new york city bank of", "L"), ("", "N"), ("...", "N"), (None, "N")]
    rows = [(i, " ".join(rng.choice(words + ["other"] * 300) for _ in range(rng.randrange(80)))) for i in range(60)] + [
        (900, "the NEW york, city (bank) of new york"), (901, None), (902, "")]
    got = phrases.dictionary_entities(spark.createDataFrame(rows, TEXTS), spark.createDataFrame(names, "name STRING, type STRING"), ["id"])
    want = brute_names(rows, names)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) > 500


def test_no_names(spark):
    texts = spark.createDataFrame(some_texts(4, 3), TEXTS)
    assert phrases.dictionary_entities(texts, spark.createDataFrame([("..", "x")], "name STRING, type STRING"), ["id"]).count() == 0


def test_scored_phrases_move_texts_once(spark):
    df = spark.createDataFrame(some_texts(5), TEXTS)
    assert len(nodes(phrases.scored_phrases(df, ["id"]), "Exchange")) == 1
    twice = phrases.scored_phrases(df.where("id = 1").unionByName(df.where("id = 1")), ["id"]).collect()
    once = {r.phrase: r for r in phrases.scored_phrases(df.where("id = 1"), ["id"]).collect()}
    assert len(twice) == len(once) and all(r.n == 2 * once[r.phrase].n and r.score == once[r.phrase].score for r in twice)


def test_words_of_a_text_do_not_move_with_each_place(spark, monkeypatch):
    monkeypatch.setattr(phrases, "NAMES_BROADCAST", 0)
    names = spark.createDataFrame([("linear systems", "x"), ("set", "y")], "name STRING, type STRING")
    found = phrases.dictionary_entities(spark.createDataFrame(some_texts(6), TEXTS), names, ["id"])
    assert nodes(found, "Exchange") and not any("_w#" in x for x in nodes(found, "Exchange"))


def test_a_filter_loses_no_row(spark):
    rows = spark.range(20_000).selectExpr("id", "cast(id as string) as name")
    kept = {r.id for r in may_be_among(rows, rows.where("id % 7 = 0"), "name").collect()}
    assert kept >= set(range(0, 20_000, 7)) and len(kept) < 3_000


def test_a_filter_grows_with_what_it_holds(spark, monkeypatch):
    """Few of the rows that are not among the others are let by, however many these are."""
    monkeypatch.setattr(keyed, "FILTER_BITS", 16)
    rows = spark.range(200_000).selectExpr("id", "cast(id as string) as name")
    others = rows.where("id % 2 = 0")
    kept = may_be_among(rows, others, "name", 100_000).agg(F.count("*").alias("n"), F.count_if(F.expr("id % 2 = 0")).alias("same")).first()
    assert kept.same == 100_000 and kept.n < 102_000
    monkeypatch.setattr(keyed, "MOST_FILTER_BITS", 17)  # too small: no row is lost
    assert may_be_among(rows, others, "name", 100_000).where("id % 2 = 0").count() == 100_000

"""Ranked search, search inside words, and the closure of lineage, against plain versions."""

import math
import random
import re
from collections import Counter

from plans import nodes
from pyspark.sql import functions as F

from docflow.operators import lineage, ranked, search

INDEX = "documentId STRING, page INT, KeyPhrases ARRAY<STRING>, Entities MAP<STRING,STRING>, text STRING"


def pages(seed, n=120):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "delta-x", "alphabet", "été", "of", "a", "ab"] + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = " ".join(words[int(len(words) * rng.random() ** 2)] for _ in range(rng.choice([0, 5, 40, 200])))
        rows.append((f"d{i // 3}", i % 3, ["alpha gamma"] if i % 7 == 0 else [], {"T": "beta"} if i % 11 == 0 else {}, text if i % 17 else None))
    return rows


def words_of(row):
    content = " ".join(x for x in [row[4], " ".join(row[2]), " ".join(row[3].values())] if x is not None)
    return [w for w in re.split(search.WORD_BREAK, content.lower()) if w]


def bm25(rows, words, k, every):
    cut = {(r[0], r[1]): words_of(r) for r in rows}
    mean = sum(map(len, cut.values())) / len(cut)
    df = {w: sum(w in c for c in cut.values()) for w in words}
    out = []
    for key, c in cut.items():
        tf = Counter(c)
        held = [w for w in words if tf[w]]
        if held and (not every or len(held) == len(words)):
            score = sum(math.log(1 + (len(cut) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(c) / mean)) for w in held)
            out.append((-round(score, 6), *key, len(held)))
    return [(i, doc, page, n, -s) for i, (s, doc, page, n) in enumerate(sorted(out)[:k], 1)]


def test_bm25(spark, tmp_path):
    rows = pages(1)
    ranked.write_postings(spark.createDataFrame(rows, INDEX), str(tmp_path / "p"))
    for terms, words in ((["Alpha", "w3"], ["alpha", "w3"]), (["delta-x été"], ["delta", "x", "été"]), (["nowhere", "of"], ["nowhere", "of"])):
        for k in (5, 1000):
            for mode in ("any", "all"):
                got = [tuple(r) for r in ranked.search_ranked(spark, str(tmp_path / "p"), terms, k, mode).collect()]
                want = bm25(rows, words, k, mode == "all")
                assert [g[:4] for g in got] == [w[:4] for w in want]
                assert all(abs(g[4] - w[4]) < 2e-6 for g, w in zip(got, want, strict=True))
    assert ranked.search_ranked(spark, str(tmp_path / "p"), ["...", ""]).count() == 0
    ranked.write_postings(spark.createDataFrame([], INDEX), str(tmp_path / "none"))
    assert ranked.search_ranked(spark, str(tmp_path / "none"), ["a"]).count() == 0
    plan = ranked.search_ranked(spark, str(tmp_path / "p"), ["alpha"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "PushedFilters: [In(token" in plan or "EqualTo(token" in plan


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_inside_words(spark, tmp_path):
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcé", k=rng.randrange(1, 12))) for _ in range(900)})
    ranked.write_gram_table(spark.createDataFrame([(w,) for w in words + words[:9]] + [(None,)], "name STRING"), str(tmp_path / "g"), "name")
    table = spark.read.parquet(str(tmp_path / "g"))
    for part in ("abc", "aaaa", "abcab", "éab", "ab", "a", "", "zzz"):
        assert sorted(r.word for r in ranked.words_with(table, part).collect()) == [w for w in words if part in w]
    for word, edits in (("abcabcab", 1), ("abcabcab", 2), ("aéabcca", 2), ("abc", 1), ("ab", 1), ("", 2), (words[40], 0)):
        got = sorted((r.word, r.edits) for r in ranked.words_like(table, word, edits).collect())
        assert got == [(w, distance(w, word)) for w in words if distance(w, word) <= edits]
    assert table.where(F.col("gram").isin(ranked._grams_of("abcab"))).count() < len(words) / 2


def test_derivations(spark):
    rng = random.Random(6)
    pairs = {(i, i + 1) for i in range(40)} | {(rng.randrange(70), rng.randrange(70)) for _ in range(45)} | {(5, 5), (60, 61), (61, 60)}
    rows = [("b", str(a), "b", str(b)) for a, b in pairs] * 2 + [("b", "1", "b", None), ("b", None, "b", "1")]
    edges = spark.createDataFrame(rows, "sourceBucketName STRING, sourceFileName STRING, targetBucketName STRING, targetFileName STRING")
    want = {}
    for start in range(70):
        level, depth, seen = {start}, 0, {start}
        while level:
            depth += 1
            level = {b for a, b in pairs if a in level} - seen
            seen |= level
            want |= {(start, b): depth for b in level}
    ways = lineage.derivations(edges)
    short = {(int(r.source[7:]), int(r.target[7:])): r.depth for r in ways.collect()}
    assert short == want and ways.count() == len(want)
    derived = {b for _, b in want}
    got = {(int(r.target[7:]), int(r.origin[7:]), r.depth) for r in lineage.origins(ways).collect()}
    assert got == {(b, a, d) for (a, b), d in want.items() if a not in derived}
    assert lineage.derivations(edges.limit(0)).count() == 0


def test_postings_move_once(spark):
    rows = pages(7, 30)
    df = spark.createDataFrame([*rows, *rows[:9]], INDEX)  # of repeated pages the words are added up
    ordered = ranked.ordered_postings(df)
    assert len(nodes(ordered, "Exchange")) == 1
    want = Counter()
    for r in [*rows, *rows[:9]]:
        want.update((w, r[0], r[1]) for w in words_of(r))
    assert {(r.token, r.documentId, r.page): r.tf for r in ordered.collect()} == want

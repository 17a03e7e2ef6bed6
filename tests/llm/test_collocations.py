"""Collocations against plain counts."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import texts
from sql_check import compare

from docflow.llm import collocations, queries

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, least=30, top=2000):
    """By counting all phrases in dictionaries; ``rows`` are (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        count = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                count.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, count in counts.items():
        found, covered = [], {}
        often = {w: f for w, f in count.items() if len(w) > 1 and f >= least}
        for w, f in often.items():
            for n in range(2, len(w)):
                for i in range(len(w) - n + 1):
                    covered[w[i : i + n]] = max(f, covered.get(w[i : i + n], 0))
        for w, a in often.items():
            score, k = min((2_000_000 * a // (count[w[:k]] + count[w[k:]]), k) for k in range(1, len(w)))
            if 100 * covered.get(w, 0) < 80 * a:
                found.append((-score, -a, " ".join(w).encode(), count[w[:k]], count[w[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in collocations.collocations(df, **kw).select(*NAMES).collect())


def corpus(seed, n=400):
    """Few words with very uneven counts, fixed phrases, all separators, odd bytes and languages."""
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "x\x01", "x", "ÄB", "äb", "new", "york", "city", "hall", "\x00", "日本", "it's"]
    fixed = ["new york city hall", "new york", "NEW YORK CITY", "x x\x01", "a a a a a"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(40)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else words[int(len(words) * rng.random() ** 2)])
            parts.append(rng.choice([" "] * 9 + ["\t", "  ", ", ", ".", "\n", "\x0b", "\r\n", "; ", "!?"]))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), "".join(parts)))
    return rows


@pytest.mark.parametrize(("least", "top"), [(1, 2000), (30, 7)])
def test_small_shards(ready, least, top):
    rows = corpus(least)
    df = ready.createDataFrame(rows, "lang string, text string").repartition(3)
    small = {"shard_words": 50, "task_phrases": 100, "segment_phrases": 64}
    assert found(df, min_count=least, top=top, **small) == brute(rows, least, top) != []


def test_edge_cases(ready, docs):
    rows = [("en", t) for _, t in texts()]
    assert found(docs, min_count=2) == brute(rows, 2)


def test_no_candidates(ready, docs, empty):
    assert found(empty) == [] == found(docs, min_count=10**6)
    assert found(ready.createDataFrame([(None, None), ("en", None), ("en", "one")], "lang string, text string"), min_count=1) == []


def test_very_long_text(ready, monkeypatch):
    """A text that is cut several times, and longer than a shard."""
    monkeypatch.setattr(collocations, "CUT_BYTES", 100)
    text = "".join(t or "" for _, t in corpus(9))
    ids = collocations._Ids()
    whole = np.concatenate(list(collocations.word_ids(text.encode(), ids)))
    monkeypatch.setattr(collocations, "CUT_BYTES", 10**9)
    assert (whole == np.concatenate(list(collocations.word_ids(text.encode(), ids)))).all()
    df = ready.createDataFrame([("en", text)], "lang string, text string")
    assert found(df, min_count=3, shard_words=64) == brute([("en", text)], 3)


@pytest.mark.parametrize("bits", [2, 6, 28, 32, 34, 62])
def test_filters_are_lossless(bits):
    """Permutation, filter and back, in one key and in two."""
    rng = np.random.default_rng(bits)
    left, right = (rng.integers(0, 2**bits, 5000, dtype=np.uint64) for _ in range(2))
    both = collocations.restore(*collocations.permute(left, right, bits), bits)
    assert (both[0] == left).all() and (both[1] == right).all()
    want = Counter(zip(left.tolist(), right.tolist(), strict=True))
    keys, counts = collocations.counted(collocations.joined(*collocations.permute(left, right, bits), bits))
    counts = counts * rng.choice([1, 200, 10**12], len(counts))
    for lead in {0, 1, bits // 2, bits}:
        width = (2 if len(keys) == 1 else 1) * bits
        got = {}
        top = (keys[0] >> np.uint64(width - lead)).astype(int) if lead else np.zeros(len(counts), int)
        for segment in np.unique(top)[:50]:
            at = top == segment
            data = collocations.encode([k[at] for k in keys], counts[at], bits, lead)
            back, n = collocations.decode(data, bits, lead, int(segment))
            assert all((x == k[at]).all() for x, k in zip(back, keys, strict=True)) and (n == counts[at]).all()
            pairs = collocations.restore(*collocations.halves(back, bits), bits)
            got.update(zip(zip(*(x.tolist() for x in pairs), strict=True), n.tolist(), strict=True))
        assert set(got) <= set(want)


def test_merged():
    rng, tables, want = np.random.default_rng(1), [], Counter()
    for _ in range(40):
        values = rng.integers(0, 500, rng.integers(1, 300), dtype=np.uint64)
        want.update(values.tolist())
        tables.append(collocations.counted([values]))
    keys, counts = collocations.merged(tables)
    assert dict(zip(keys[0].tolist(), counts.tolist(), strict=True)) == want


def peak_mb(fn):
    """MB that numpy and Python take at most while ``fn`` runs, without what was there before."""
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_merged_ranges():
    """Ranges are sorted, share no key and hold what plain counts give, whatever the keys."""
    rng = np.random.default_rng(2)
    for n, width in ((1, 1), (2, 1), (3, 2), (60, 1), (60, 2)):
        tables, want = [], Counter()
        for _ in range(n):
            keys = [rng.integers(0, 300, rng.integers(1, 400), dtype=np.uint64) for _ in range(1)] * width
            want.update(zip(*(k.tolist() for k in keys), strict=True))
            tables.append(collocations.counted(list(keys)))
        found = [(key, c) for keys, counts in collocations.merged_ranges(tables, 50)
                 for key, c in zip(zip(*(k.tolist() for k in keys), strict=True), counts.tolist(), strict=True)]
        assert found == sorted(want.items())
    same = [([np.full(1, 7, np.uint64)], np.ones(1, np.int64))] * 500
    assert [(k[0].tolist(), c.tolist()) for k, c in collocations.merged_ranges(same, 50) if len(c)] == [([7], [500])]


@pytest.mark.parametrize("bits", [32, 40])
def test_memory_of_counting(bits):
    """Filters of a task, and their merge, take little more than the counters (and an order) themselves."""
    rng, lead, n = np.random.default_rng(bits), 4, 400_000
    ids = rng.integers(2, 60_002, n).astype("<u4")
    known = pa.array([((np.arange(60_000) << 32) | np.arange(1, 60_001))], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), known], ["ids", "known"])
    filters = list(collocations.build_filters([batch], bits, 4, lead, 300_000, 20_000))
    built = peak_mb(lambda: [None for _ in collocations.build_filters([batch], bits, 4, lead, 900_000, 20_000)])
    places = 960_000 * (1 if bits == 32 else 2) * 8 / 1e6  # of a task
    assert built < places * 2 + 20

    rows = [(s, blob) for b in filters for s, blob in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    rows.sort(key=lambda r: r[0])
    assert {s for s, _ in rows} == set(range(1 << lead))
    ordered = pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], ["segment", "filter"])
    merged = list(collocations.merge_filters([ordered], bits, lead, 1, 10**6))
    got = Counter(dict(r for b in merged for r in zip(zip(*(c.to_pylist() for c in b.columns[:4]), strict=True), b.column(4).to_pylist(), strict=True)))
    words = (ids - 1).tolist()
    want = Counter((*words[i : i + m], *[0] * (4 - m)) for m in (2, 3, 4) for i in range(n - m + 1))
    assert got == want


def test_memory_of_merging():
    """Counters are merged by ranges: beside all of them stand the sums and what one range takes."""
    rng = np.random.default_rng(3)
    tables = [collocations.counted([rng.integers(0, 2**62, 100_000, dtype=np.uint64)]) for _ in range(20)]
    total = sum(len(c) for _, c in tables) * 16 / 1e6
    assert peak_mb(lambda: [None for _ in collocations.merged_ranges(tables)]) < total
    assert peak_mb(lambda: collocations.merged(tables)) < 3 * total


def test_query(ready, sf_dir):
    assert compare(ready, sf_dir, "op11_collocations") > 0
    rows = [(r.lang, r.text) for r in ready.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = queries.QUERIES["op11_collocations"](ready, sf_dir)
    assert sorted(tuple(r) for r in out.select(*NAMES).collect()) == brute(rows)

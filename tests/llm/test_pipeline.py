"""Every stage of the pipeline against a plain version, on its own input."""

import random
import re
from collections import Counter

import pytest
from cases import SF_DIR, texts
from test_packing import check
from test_quality import plain, score_of
from test_secret_scan import spans
from test_simhash import brute as groups

import corpus_pipeline as pipeline
from docflow.llm import mixing, quality

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def some(ready, sf_dir):
    """The smallest table with edge cases, repeated rows and rows without id."""
    extra = ready.createDataFrame([(None if i is None else i + 10**6, t, "en", None, len(t or "")) for i, t in texts()], DOCS)
    table = ready.read.parquet(f"{sf_dir}/documents.parquet")
    return table.unionByName(extra).unionByName(table.where("doc_id < 20")).unionByName(extra.where("doc_id < 1000006"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "near duplicates", "secret scans", "mixing sources", "packing"]
    assert pipeline.ORACLE_SQL is None


def test_quality(ready, some):
    pairs = [(r.doc_id, r.text) for r in some.collect()]
    good = {r.doc_id for r in ready.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()}
    verdict = [not plain(t)[-1] and s >= quality.THRESHOLD for (_, t), s in zip(pairs, score_of(pairs, good), strict=True)]
    out = pipeline.quality_rules(ready, some, SF_DIR)
    assert out.columns == some.columns
    assert rows(out) == sorted((tuple(r) for r, v in zip(some.collect(), verdict, strict=True) if v), key=str)


def test_near_duplicates(ready, some):
    out = pipeline.near_duplicates(ready, some, SF_DIR)
    numbered = sorted((tuple(r) for r in some.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    of = {i: c for i, _, c in groups([(i, r[1]) for i, r in enumerate(numbered)])}
    assert out.columns == some.columns
    assert rows(out) == sorted((r for i, r in enumerate(numbered) if of[i] == i), key=str)


def test_secrets(ready, some):
    out = pipeline.secret_scans(ready, some, SF_DIR)
    assert out.columns == some.columns and out.count() == some.count()
    want = []
    for r in some.collect():
        text, at, parts = r.text, 0, []
        if text and not re.search("PRIVATE KEY|eyJ", text):
            for a, b, k in spans(text):
                if a >= at:
                    parts += [text[at:a], f"[{('assign', 'access', 'hex')[k]}]"]
                at = max(at, b)
            text = "".join(parts) + text[at:]
        want.append((r.doc_id, text, r.lang, r.source, len(text) if parts else r.n_chars))
    assert rows(out) == sorted(want, key=str)


def test_mixing(ready, some):
    out = pipeline.mixing_sources(ready, some, SF_DIR)
    assert out.columns == some.columns and rows(out) == rows(some)


def test_packing(ready, some):
    assert check(pipeline.packed(ready, some, SF_DIR).collect(), [(r.doc_id, r.text) for r in some.collect()]) == 0


def test_packing_keeps_the_mixture(ready, tmp_path):
    """Read from several files, sequences in the order of their numbers have each source's share, run by run."""
    rng = random.Random(3)
    sizes = {"a": 900, "b": 60, "c": 300}  # words; packing by length alone would tell the sources apart
    docs, rest = [], {s: 1_200_000 for s in sizes}
    while any(x > 0 for x in rest.values()):
        for s in [s for s in sizes if rest[s] > 0]:
            text = " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(sizes[s] // 2, sizes[s])))
            docs.append((len(docs), text, "en", s, len(text)))
            rest[s] -= len(text)
    mixed = pipeline.mixing_sources(ready, ready.createDataFrame(docs, DOCS), SF_DIR)
    mixed.repartition(7).write.parquet(str(tmp_path / "mixed"))
    pieces = pipeline.packed(ready, ready.read.parquet(str(tmp_path / "mixed")), SF_DIR).collect()
    assert check(pieces, [(r[0], r[1]) for r in docs]) == 0
    source, total = {r[0]: r[3] for r in docs}, sum(p.length for p in pieces)
    slots = {r.doc_id: r.mix_slot for r in mixing.mix(mixed).collect()}
    seen, parts, at, run = Counter(), [Counter() for _ in range(3)], 0, 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        run = max(run, slots[p.doc_id] // pipeline.RUN_SLOTS)
        assert slots[p.doc_id] // pipeline.RUN_SLOTS >= run - 1  # only what is carried into the next run's window
        parts[min(2, 3 * at // total)][source[p.doc_id]] += p.length
        seen[source[p.doc_id]] += p.length
        at += p.length
    for part in parts:
        for s in sizes:
            # a third has 18 slots, and may end inside a run on both sides
            assert abs(part[s] / sum(part.values()) - seen[s] / total) < 0.15, parts


def test_empty(ready, some):
    for _, stage in pipeline.STAGES:
        assert stage(ready, some.limit(0), SF_DIR).count() == 0


def test_run(ready, sf_dir):
    """The whole pipeline equals its stages one after the other."""
    docs = ready.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = ready.createDataFrame(stage(ready, docs, sf_dir).collect(), DOCS)
    pieces = pipeline.run(ready, sf_dir).collect()
    assert check(pieces, [(r.doc_id, r.text) for r in docs.collect()]) == 0

"""License scans against plain searches in every block."""

import random
import re

import pytest
from cases import texts
from sql_check import compare

from docflow.llm import license_scan as ls

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, templates=ls.TEMPLATES, phrases=ls.PHRASES, percent=ls.CONTAINMENT_PERCENT):
    cut = [(label, words(t)) for label, t in templates]
    step, out = max((len(w) for _, w in cut), default=1), []
    for key, text in rows:
        w = words(text)
        places = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        matches = []
        for start in range(0, max(1, len(w) - step), step):
            block = set(w[start : start + 2 * step])
            for i, (label, t) in enumerate(cut):
                both = len(block & set(t))
                if t and 100 * both >= percent * len(set(t)):
                    matches.append((start, label, i, both / len(set(t))))
        base = sorted({x for _, x in places})
        score = 1.0 if places else max((m[3] for m in matches), default=0.0)
        at = [i for i, _ in places]
        out.append((key, len(w), len(places), min(at, default=None), max(at, default=None), base,
                    sorted({*base, *(m[1] for m in matches)}), score, sorted(matches)))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted((tuple([tuple(m) for m in x] if isinstance(x, list) and x and not isinstance(x[0], str) else x for x in r)
                   for r in ls.find_licenses(df, **kw).collect()), key=str)


def with_notices(seed, n=120):
    """Notices whole, wrapped, shuffled, with words missing or put between, near the ends of blocks; odd bytes."""
    rng, rows = random.Random(seed), []
    notices = [t for _, t in ls.TEMPLATES] + ["ALL RIGHTS\nRESERVED", "cc-by cc by by", "General Public; license", "İ ſ Ä all rights reserved"]
    common = ["the", "of", "is", "and", "word", "Straße", "日本", "ware", "x9"]
    for i in range(n):
        out = []
        for _ in range(rng.randrange(5)):
            out += [rng.choice(common) for _ in range(rng.choice([0, 3, 40, 90, 400]))]
            part = rng.choice(notices).split()
            kind = rng.random()
            if kind < 0.2:
                rng.shuffle(part)
            elif kind < 0.5:
                part = [p for p in part if rng.random() > 0.08]
            elif kind < 0.6:
                part = [x for p in part for x in (p, "mid")]
            out += part
        rows.append((i, rng.choice([" ", "\n", " \x00", "--"]).join(out)))
    return rows


@pytest.mark.parametrize("percent", [60, 90, 100])
def test_notices(ready, percent):
    rows = with_notices(percent) + texts()
    df = ready.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows, percent=percent)
    assert found(df, percent=percent) == want
    assert sum(bool(r[-1]) for r in want) > 30


def test_own_templates_and_none(ready, docs):
    templates = [("w", "w1 w2 w3"), ("none", " ,"), ("b", "b a"), ("c", "c a b b")]
    rows = texts()
    assert found(docs, templates=templates, phrases={"a b": "ab"}, percent=50) == brute(rows, templates, {"a b": "ab"}, 50)
    assert found(docs, templates=[]) == brute(rows, [])
    assert found(docs, phrases={}) == brute(rows, phrases={})


def test_empty(empty):
    assert ls.find_licenses(empty).count() == 0


def test_every_template_is_found_anywhere(ready):
    """A whole notice at any place of a long text lies in a block."""
    rng, rows = random.Random(2), []
    for i, (_, t) in enumerate(ls.TEMPLATES):
        for at in rng.sample(range(300), 12):
            rows.append((i, " ".join(["pad"] * at) + f"\n{t}\n" + " ".join(["pad"] * rng.randrange(200))))
    out = ls.find_licenses(ready.createDataFrame(rows, "doc_id bigint, text string"))
    assert all(ls.TEMPLATES[r.doc_id][0] in r.labels for r in out.collect())


def test_query(ready, sf_dir):
    assert compare(ready, sf_dir, "op12_licenses") > 0

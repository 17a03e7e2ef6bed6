"""Vector codes against plain Lloyd rounds."""

import hashlib
import math
import random

import numpy as np
import pytest
from sql_check import compare

from docflow.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, dims int, n int, part string"


def brute(rows, entries=256, rounds=4):
    """Rows of (id, vector, label); whole numbers in Python."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v and None not in v and all(map(math.isfinite, v))]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    dims = next((len(v) for _, v, _ in kept if len(v) % 4 == 0), 4)
    kept = [r for r in kept if len(r[1]) == dims]
    d = dims // 4
    parts = [[tuple(v[p * d : p * d + d]) for _, v, _ in kept] for p in range(4)]
    books = [list(x[:entries]) for x in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            at = [nearest(x, books[p])[1] for x in parts[p]]
            for j in range(len(books[p])):
                own = [x for x, k in zip(parts[p], at, strict=True) if k == j]
                if own:
                    books[p][j] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    found = [[nearest(x, books[p]) for x in parts[p]] for p in range(4)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(found[p][i][0] for p in range(4)) for i in range(len(kept))]
    of = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        of[lab] = of.get(lab, 0) + e
    return sorted(((r[0], "".join(f"{found[p][i][1]:02x}" for p in range(4)), errors[i], of[r[2]], sha)
                   for i, r in enumerate(kept)), key=str)


def found(ready, rows, **kw):
    df = ready.createDataFrame([(*r, "z", 1, 2, "y") for r in rows], SCHEMA).repartition(3)
    out = vc.compress(df, **kw).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted(map(tuple, out), key=str)


def vectors(seed, n, dims):
    """Clusters of near and equal vectors, ties between entries, and what is left out."""
    rng = random.Random(seed)
    middle = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(8)]
    rows = []
    for i in range(n):
        spread = rng.choice([0, 0.001, 0.05, 1])
        v = [x + rng.gauss(0, spread) for x in rng.choice(middle)]
        rows.append((rng.randrange(5 * n), v, rng.choice([0, 0, 0, 1, 2, None])))
    rows += rows[:5]
    rows += [(None, middle[0], 1), (None, middle[1], None), (-1, None, 1), (-2, [], 1), (-3, [None] * dims, 1), (-4, [math.nan] * dims, 1),
             (-5, [math.inf] + [0.0] * (dims - 1), 2), (-6, [0.5] * (dims + 1), 2), (9, [0.0] * dims, 1), (9, [-0.0] * dims, 1)]
    return rows


@pytest.mark.parametrize(("seed", "n", "dims", "block"), [(1, 300, 8, 4096), (2, 150, 4, 7), (3, 200, 16, 64)])
def test_small(ready, seed, n, dims, block):
    rows = vectors(seed, n, dims)
    assert found(ready, rows, entries=16, block_vectors=block) == brute(rows, 16)


def test_fewer_vectors_than_entries(ready):
    rows = vectors(5, 20, 8)
    assert found(ready, rows) == brute(rows)


def test_ties_and_large_numbers(ready):
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate([[0] * 4, [2] * 4, [1] * 4, [1] * 4, [60_000] * 4, [-60_000] * 4] * 3)]
    assert found(ready, rows, entries=3) == brute(rows, 3)


def test_too_large(ready):
    with pytest.raises(Exception, match="too large"):
        found(ready, [(1, [1e30] * 4, 1)])


def test_nothing_left(ready):
    assert found(ready, [(1, None, 1)]) == [] == found(ready, [(1, [1.0] * 5, 1)])
    df = ready.createDataFrame([], SCHEMA)
    assert vc.compress(df).count() == 0


def test_trees_are_exact_and_prune():
    rng = np.random.default_rng(3)
    middle = rng.integers(-900, 900, (40, 16))
    points = middle[rng.integers(0, 40, 3000)] + rng.integers(-3, 4, (3000, 16))
    tree = vc.CoverTree.from_bytes(vc.CoverTree(points).to_bytes())
    assert sorted(tree.order.tolist()) == list(range(3000)) and (tree.points == points[tree.order]).all()
    for i in range(len(tree.begin)):
        run = tree.points[tree.begin[i] : tree.end[i]]
        away = np.sqrt(vc.distances(run, run[:1])[:, 0])
        assert away.max() <= tree.radius[i] + 1e-9
        if tree.children[i]:
            kids = range(tree.child[i], tree.child[i] + tree.children[i])
            centres = tree.points[tree.begin[list(kids)]]
            apart = np.sqrt(vc.distances(centres, centres)) + np.eye(len(centres)) * 1e9
            assert apart.min() > tree.radius[i] / 2  # separated
            assert tree.begin[kids[0]] == tree.begin[i] and tree.end[kids[-1]] == tree.end[i]  # nested
    for entries in (middle, points[:256], middle[:1], np.repeat(middle[:3], 2, axis=0)):
        got, compared = tree.nearest(entries)
        assert (got == vc.distances(tree.points, entries).argmin(axis=1)).all()
        counts, sums = tree.sums(entries)
        assert all((sums[e] == tree.points[got == e].sum(axis=0)).all() and counts[e] == (got == e).sum() for e in range(len(entries)))
    assert tree.nearest(middle)[1] < 300  # nearly all points go with their subtree


def test_query(ready, sf_dir):
    assert compare(ready, sf_dir, "op13_vector_codes") > 0
    rows = [tuple(r) for r in ready.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert len(rows) > 256

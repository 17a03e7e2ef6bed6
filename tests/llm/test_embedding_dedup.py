"""Embedding links and components against all pairs."""

import numpy as np
import pytest
from cases import SF_DIR, rows_of
from pyspark.sql import functions as F

from docflow.llm import embedding_dedup as dedup
from docflow.llm import queries

NAMES = ("vec_id", "n_links", "component_id", "kept")


def brute(rows, threshold=0.93):
    units = []
    for _, v, label in rows:
        ok = label is not None and v and None not in v and np.isfinite(v).all() and np.any(np.asarray(v))
        units.append(np.asarray(v, dtype=np.float64) / np.linalg.norm(np.asarray(v, dtype=np.float64)) if ok else None)
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((r[0], links[i], least.get(find(i), r[0]), r[0] == least.get(find(i), r[0])) for i, r in enumerate(rows)), key=str)


def vectors(n=240, dims=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.normal(size=dims) * rng.choice([0.02, 0.25, 0.4, 2])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(2))))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(30)]  # a common vector
    rows += [(2000, [2 * x for x in rows[0][1]], rows[0][2])]
    rows += [(3000, None, 0), (3001, [0.0] * dims, 0), (3002, [None] + [1.0] * (dims - 1), 0), (3003, [float("nan")] * dims, 0),
             (3004, [float("inf")] + [1.0] * (dims - 1), 0), (3005, [], 0), (3006, rows[0][1], None), (3007, rows[0][1][:5], 0),
             (3008, rows[0][1][:5], 0), (None, rows[1][1], rows[1][2]), (None, None, 1), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2]),
             (3009, [1e30 * x for x in rows[3][1]], rows[3][2]), (3010, [1e-30 * x for x in rows[3][1]], rows[3][2])]
    return rows


@pytest.fixture(scope="module")
def rows():
    return vectors()


@pytest.fixture(scope="module")
def frame(ready, rows):
    return ready.createDataFrame(
        [(*r, "x", 1, b"z") for r in rows], "vec_id bigint, embedding array<float>, label int, cid string, n int, unit binary").repartition(3)


@pytest.mark.parametrize("settings", [
    {}, {"cell_vectors": 40, "margin": 1.0, "block_vectors": 7}, {"block_vectors": 3}, {"cell_vectors": 5, "max_cells": 6}])
def test_all_links_are_found(frame, rows, settings):
    assert rows_of(dedup.near_duplicates(frame, **settings), *NAMES) == brute(rows)


def test_small_tiles_and_blocks_of_few_bytes(frame, rows, monkeypatch):
    monkeypatch.setattr(dedup, "TILE", 5)
    monkeypatch.setattr(dedup, "BLOCK_BYTES", 16 * 8 * 20)
    assert rows_of(dedup.near_duplicates(frame), *NAMES) == brute(rows)


def test_links_of_a_block():
    rng = np.random.default_rng(1)
    data = rng.normal(size=(1300, 3))
    data /= np.linalg.norm(data, axis=1)[:, None]
    want = data @ data.T >= 0.995
    np.fill_diagonal(want, False)
    linked = dedup._links(data, 0.995)
    assert (linked == want).all() and (linked == linked.T).all()
    label = dedup._labels(linked)
    for i in range(0, len(data), 97):  # a plain walk from some rows
        seen, todo = {i}, [i]
        while todo:
            more = set(np.flatnonzero(want[todo.pop()]).tolist()) - seen
            seen |= more
            todo += more
        assert label[i] == min(seen)


def placed(frame, cell_vectors, block_vectors):
    """Blocks as they are compared, for vectors without copies."""
    classes = dedup.units(frame, "vec_id", "embedding", "label").withColumn("cid", F.col("vec_id").cast("string")).withColumn("n", F.lit(1).cast("bigint"))
    large = dedup.large_labels(classes, cell_vectors, 1024)
    sized = classes.join(large.select("label", "dims", "cells"), ["label", "dims"], "left").na.fill({"cells": 1})
    return dedup.in_blocks(dedup.assign(sized, dedup.fit_cells(sized, large, 1000), 0.93, 1.0), block_vectors)


def test_what_is_compared(ready):
    """Labels that a block holds visit nothing but it; of others every pair of blocks meets once at most."""
    rng = np.random.default_rng(2)
    sizes = {0: 300, 1: 90, 2: 90, 3: 1}
    rows = [(1000 * label + i, [float(x) for x in rng.normal(size=8)], label) for label, n in sizes.items() for i in range(n)]
    frame = ready.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert placed(frame, 1000, 1000).count() == len(rows)
    assert placed(frame, 100, 1000).where("label > 0").count() == 181
    meets = {}
    homes = {}
    for r in placed(frame, 100, 40).where("label = 0").collect():
        meets.setdefault((r.cell, r.block), set()).add(r.cid)
        if not r.guest:
            assert homes.setdefault(r.cid, (r.cell, r.block)) == (r.cell, r.block)
    assert len(homes) == 300 and len({c for c, _ in homes.values()}) > 1
    pairs = [(a, b) for at, ids in meets.items() for a in ids if homes[a] == at for b in ids if homes[b] != at]
    assert len(pairs) == len({frozenset(p) for p in pairs})


def test_recall_of_the_default_margin(ready):
    """In many cells, all links of vectors that are hard to tell apart are found."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(300, 64))
    rows = [(3 * i + k, [float(x) for x in b + rng.normal(size=64) * 0.2 * k], 0) for i, b in enumerate(base) for k in range(3)]
    frame = ready.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in dedup.near_duplicates(frame, cell_vectors=30).collect()}
    want = {i: n for i, n, *_ in brute(rows)}
    assert found == want and sum(want.values()) > 300


@pytest.mark.parametrize("dims, noise", [(2, 0.2), (3, 0.2), (64, 0.2)])
def test_many_cells_lose_no_link(ready, dims, noise):
    """With the default margin many cells give what all pairs give, also where few dimensions or lines lead to borders."""
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(100, dims))
    near = [b + rng.normal(size=dims) * noise * k for b in base for k in range(3)]
    ends = rng.normal(size=(2, dims))
    line = [(1 - t) * ends[0] + t * ends[1] for t in np.linspace(0, 1, 60)]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(near + line)]
    frame = ready.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert rows_of(dedup.near_duplicates(frame, cell_vectors=30), *NAMES) == brute(rows)


def test_empty(frame):
    assert dedup.near_duplicates(frame.limit(0)).count() == 0


def test_query_equals_sql(ready, sf_dir):
    from sql_check import compare

    assert compare(ready, SF_DIR, "op6_embedding_cells") and queries.QUERIES

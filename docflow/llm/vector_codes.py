"""Codes for vectors: product quantization by Lloyd rounds over cover trees.

Vectors become whole numbers and are cut into parts. Every task makes blocks of its
vectors and a cover tree per block and part: a node covers a run of points around
its first one, and its children cover those within half its radius around centres
that are further apart than that. Sums along the run are cumulative, so a subtree's sum is one subtraction.
In a round a node whose centre is nearer to one codebook entry than to any other by
more than twice its radius (triangle inequality) goes to it whole; other nodes descend, and
points of ambiguous leaves are compared one by one. Only sums per entry leave a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import when_small, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK_VECTORS = 4096
LEAF_POINTS = 16
EXACT = 2**50  # sums of squares below it are exact in doubles


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, dims, numbers)``: ``floor(1024 * x)`` as 32-bit integers; other vectors are left out."""
    chosen = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}

    def run(batches):
        for batch in batches:
            keep, dims, found = [], [], []
            for i, x in enumerate(batch.column(2)):
                if not x.is_valid or not len(x.values) or x.values.null_count:
                    continue
                v = x.values.to_numpy()
                if not np.isfinite(v).all():
                    continue
                v = np.floor(v * SCALE)
                if len(v) / PARTS * (2 * np.abs(v).max()) ** 2 >= 2**62 or np.abs(v).max() >= 2**31:
                    raise ValueError("components are too large for distances of 64 bits")
                keep.append(i), dims.append(len(v)), found.append(v.astype("<i4").tobytes())
            rows = batch.select([0, 1]).take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(dims, pa.int32()), pa.array(found, pa.binary())], ["vec_id", "label", "dims", "numbers"])

    return chosen.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, dims int, numbers binary")


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points (rows) to entries (columns)."""
    top = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * points.shape[1] * int(top) ** 2 < EXACT:
        x, c = points.astype(np.float64), entries.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * (x @ c.T)).astype(np.int64)
    out = np.zeros((len(points), len(entries)), dtype=np.int64)
    for j in range(points.shape[1]):
        out += (points[:, j, None] - entries[None, :, j]) ** 2
    return out


class CoverTree:
    """Points in the order of the tree; node ``i`` covers ``[begin[i], end[i])`` around the first of them."""

    def __init__(self, points: np.ndarray, leaf_points: int = LEAF_POINTS):
        points = points.astype(np.int64)
        order, begin, end, radius, child, children = np.arange(len(points)), [0], [len(points)], [], [], []
        at = 0
        while at < len(begin):
            lo, hi = begin[at], end[at]
            rest = order[lo:hi]
            away = np.sqrt(distances(points[rest], points[rest[:1]])[:, 0])
            radius.append(float(away.max()))
            child.append(len(begin))
            if hi - lo > leaf_points and radius[at] > 0:
                groups, reach = [], radius[at] / 2
                while len(rest):
                    near = away <= reach
                    groups.append(rest[near])  # its first one is the centre
                    rest = rest[~near]
                    if len(rest):
                        away = np.sqrt(distances(points[rest], points[rest[:1]])[:, 0])
                order[lo:hi] = np.concatenate(groups)
                ends = lo + np.cumsum([len(g) for g in groups])
                begin += [lo, *ends[:-1].tolist()]
                end += ends.tolist()
            children.append(len(begin) - child[at])
            at += 1
        self.order, self.points = order, points[order]
        self.begin, self.end = np.array(begin), np.array(end)
        self.radius, self.child, self.children = np.array(radius), np.array(child), np.array(children)

    def to_bytes(self) -> bytes:
        head = np.array([*self.points.shape, len(self.begin)], dtype="<i4")
        whole = [self.order, self.points, self.begin, self.end, self.child, self.children]
        return b"".join([head.tobytes(), self.radius.astype("<f8").tobytes(), *(x.astype("<i4").tobytes() for x in whole)])

    @classmethod
    def from_bytes(cls, data: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        n, dims, nodes = np.frombuffer(data, "<i4", 3).tolist()
        tree.radius = np.frombuffer(data, "<f8", nodes, 12)
        rest = np.frombuffer(data, "<i4", offset=12 + 8 * nodes).astype(np.int64)
        tree.order, tree.points, tree.begin, tree.end, tree.child, tree.children = np.split(rest, np.cumsum(
            [n, n * dims, nodes, nodes, nodes]))
        tree.points = tree.points.reshape(n, dims)
        return tree

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, int]:
        """For each point, in the order of the tree, its nearest entry (the first of equals); and how many were compared one by one."""
        out, level, compared = np.zeros(len(self.points), dtype=np.int64), np.zeros(min(1, len(self.points)), dtype=np.int64), 0
        while len(level):
            square = distances(self.points[self.begin[level]], entries)
            best = square.argmin(axis=1)
            away = np.sqrt(square)
            rows = np.arange(len(level))
            limit = away[rows, best] + 2 * self.radius[level]
            away[rows, best] = np.inf
            # not closer than the limit by more than roundings: all points have the same nearest entry
            one = (away.min(axis=1) > limit * (1 + 1e-9) + 1e-9) | (self.radius[level] == 0)
            for node, entry in zip(level[one], best[one], strict=True):
                out[self.begin[node] : self.end[node]] = entry
            level = level[~one]
            leaves = level[self.children[level] == 0]
            if len(leaves):
                at = _ranges(self.begin[leaves], self.end[leaves])
                out[at] = distances(self.points[at], entries).argmin(axis=1)
                compared += len(at)
            level = level[self.children[level] > 0]
            level = _ranges(self.child[level], self.child[level] + self.children[level])
        return out, compared

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and their sums per entry, from cumulative sums along runs of one entry."""
        found, _ = self.nearest(entries)
        total = np.concatenate([np.zeros((1, self.points.shape[1]), np.int64), np.cumsum(self.points, axis=0)])
        first = np.flatnonzero(np.diff(found, prepend=-1))
        ends = np.append(first[1:], len(found))
        counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        np.add.at(counts, found[first], ends - first)
        np.add.at(sums, found[first], total[ends] - total[first])
        return counts, sums


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges one after the other."""
    size = end - begin
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def trees_of(numbers: DataFrame, dims: int, block_vectors: int) -> DataFrame:
    """``(vec_ids, labels, trees)``: blocks of a task's vectors with a tree per part."""
    kinds = {f.name: f.dataType.simpleString() for f in numbers.schema}

    def made(ids, labels, found):
        data = np.frombuffer(b"".join(found), "<i4").reshape(len(found), PARTS, -1)
        trees = [CoverTree(data[:, p]).to_bytes() for p in range(PARTS)]
        lists = [pa.ListArray.from_arrays([0, len(x)], x) for x in (pa.concat_arrays(ids), pa.concat_arrays(labels))]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.binary()))], ["vec_ids", "labels", "trees"])

    def run(batches):
        ids, labels, found = [], [], []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block_vectors - len(found))
                ids.append(part.column(0)), labels.append(part.column(1))
                found += part.column(2).to_pylist()
                at += part.num_rows
                if len(found) == block_vectors:
                    yield made(ids, labels, found)
                    ids, labels, found = [], [], []
        if found:
            yield made(ids, labels, found)

    return numbers.where(F.col("dims") == dims).select("vec_id", "label", "numbers").mapInArrow(
        run, f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees array<binary>")


def one_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, position) after one round over all blocks; unused entries stay."""

    def run(batches):
        counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.column(0):
                for p, data in enumerate(row.values):
                    more = CoverTree.from_bytes(data.as_py()).sums(books[p])
                    counts[p] += more[0]
                    sums[p] += more[1]
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    rows = trees.select("trees").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    totals = rows.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(books.shape[2])]).alias("sums"))
    after = books.copy()
    for r in totals.collect():  # at most a row for each entry
        after[r.part, r.entry] = [s // r.n for s in r.sums]
    return after


def encoded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """``(vec_id, label, code, error)`` of every vector."""
    kinds = {f.name: f.dataType.elementType.simpleString() for f in trees.schema if f.name != "trees"}

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                codes, error = np.zeros((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
                for p, data in enumerate(batch.column(2)[i].values):
                    tree = CoverTree.from_bytes(data.as_py())
                    found, _ = tree.nearest(books[p])
                    codes[tree.order, p] = found
                    error[tree.order] += ((tree.points - books[p][found]) ** 2).sum(axis=1)
                digits = codes.tobytes().hex()
                width = 2 * PARTS
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([digits[j : j + width] for j in range(0, len(digits), width)], pa.string()), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"vec_id {kinds['vec_ids']}, label {kinds['labels']}, code string, error bigint")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS, block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """``(vec_id, label, code, error, label_error, codebooks_sha256)``, one row per vector that is kept.

    Left out are vectors that are null, empty or hold null or non-finite components, and
    vectors whose length is not that of the vector with the smallest id whose length is a multiple of four.
    A part's codebook starts as the parts of the ``entries`` (at most 256) smallest ids, fewer where there are fewer
    vectors; null ids come last, and equal ids are ordered by their vectors' bytes. Repeated rows count as often as they
    come. ``label_error`` sums the errors of equal labels, nulls together. Components
    must stay below 2**28 / 1024 (for 64 dimensions), or the job ends: distances would pass 64 bits. Other columns are ignored; an empty table
    gives an empty result.

    Assignments and sums are exact whatever the blocks. Codebooks are what is collected and sent to tasks:
    at most ``entries`` times the dimensions.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits")
    numbers = written(whole_numbers(vectors, id_col, vector_col, label_col), "whole-vectors")
    order = [F.col("vec_id").asc_nulls_last(), "numbers"]
    first = numbers.where(F.col("dims") % PARTS == 0).orderBy(*order).select("dims").first()
    dims = first.dims if first else PARTS
    starts = [r.numbers for r in numbers.where(F.col("dims") == dims).orderBy(*order).limit(entries).collect()]
    books = np.frombuffer(b"".join(starts), "<i4").reshape(len(starts), PARTS, -1 if starts else 1).transpose(1, 0, 2).astype(np.int64)
    trees = written(trees_of(numbers, dims, block_vectors), "cover-trees")
    for _ in range(rounds if starts else 0):
        books = one_round(trees, books)
    coded = written(encoded(trees, books), "codes")
    errors = when_small(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    return coded.join(errors, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

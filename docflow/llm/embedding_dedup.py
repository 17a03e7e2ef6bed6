"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products inside them.

Only vectors of one label are compared. A label that one block holds is one cell;
a larger one has as many cells as its vectors fill. A vector lives in the cell of
its nearest centre and is a guest in cells whose border it is close to: a vector
linked with it differs by at most ``sqrt(2 - 2 * threshold)``, and where the step
towards another centre ``c`` from the own centre ``h`` is more than ``margin`` of
that, the other cell need not be asked. At ``margin`` 1, the default, no link can
be lost, whatever the cells; a smaller one loses links whose difference points at
a border with more than ``margin`` of its length. The test holds for each of two
linked vectors, so a guest visits cells of smaller numbers only, and every pair of
cells, like every pair of blocks, is compared once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import components, when_small, written

SAMPLE = 20_000
MAX_CELLS = 1024
CELL_VECTORS = 8192
BLOCK_VECTORS = 8192
BLOCK_BYTES = 32_000_000  # vectors of many dimensions make smaller blocks
TILE = 512  # rows of a block multiplied together
MARGIN = 1.0


def unit(column, kind=np.float64) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None where a vector can't be compared."""
    out = []
    for x in column.to_pylist():
        if not x or None in x:
            out.append(None)
            continue
        v = np.asarray(x, dtype=kind)
        top = np.abs(v).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        v = v / top  # keeps the norm of very large and very small vectors finite
        out.append(v / np.sqrt(v @ v))
    return out


def units(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, dims, unit)``: ``unit`` holds doubles and is null where nothing links."""
    chosen = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}

    def run(batches):
        for batch in batches:
            found = unit(batch.column(2))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([0 if x is None else len(x) for x in found], pa.int32()),
                pa.array([None if x is None else x.tobytes() for x in found], pa.binary())], ["vec_id", "label", "dims", "unit"])

    return chosen.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, dims int, unit binary")


def spherical_kmeans(data: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centres; starts from evenly spaced rows, keeps a centre that loses all its rows."""
    centres = data[np.linspace(0, len(data) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = np.concatenate([np.argmax(data[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(data), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, data)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 1e-12, sums / np.maximum(norms, 1e-12)[:, None], centres)
    return centres


def large_labels(classes: DataFrame, cell_vectors: int, max_cells: int) -> DataFrame:
    """``(label, dims, vectors, cells)`` of those above ``cell_vectors``; cells are powers of two, so few sets of centres serve all."""
    count = classes.groupBy("label", "dims").agg(F.count("*").alias("vectors")).where(F.col("vectors") > cell_vectors)
    cells = F.least(F.lit(max_cells), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("vectors") / F.lit(cell_vectors)))).cast("int"))
    return written(count.withColumn("cells", cells), "labels")


def fit_cells(classes: DataFrame, large: DataFrame, sample: int) -> dict[tuple[int, int], np.ndarray]:
    """Centres per (dimensions, cells), fitted on at most ``sample`` vectors of large labels, the first by digest."""
    sets = large.groupBy("dims").agg(F.sum("vectors").alias("n"), F.collect_set("cells").alias("cells")).orderBy(F.desc("n")).limit(16).collect()
    found = {}
    for dims, _, cells in sets:
        rows = classes.where((F.col("dims") == dims) & (F.col("cells") > 1)).orderBy("cid").limit(sample).select("unit").collect()
        data = np.stack([np.frombuffer(r.unit) for r in rows])
        found |= {(dims, k): spherical_kmeans(data, min(k, len(rows))) for k in cells}
    return found


def assign(classes: DataFrame, centres: dict[tuple[int, int], np.ndarray], threshold: float, margin: float) -> DataFrame:
    """``(label, dims, cell, guest, cid, n, unit)``: a row for the home cell and for each earlier cell visited."""
    reach = margin * np.sqrt(max(0.0, 2 - 2 * threshold) + 1e-12)  # more than products are rounded by
    sent = classes.sparkSession.sparkContext.broadcast(centres)
    label = classes.schema["label"].dataType.simpleString()

    def run(batches):
        apart = {d: np.stack([np.linalg.norm(c - x, axis=1) for x in c]) for d, c in sent.value.items()}
        for batch in batches:
            dims, sets = batch.column(1).to_numpy(), batch.column(5).to_numpy()
            rows, cells, guests = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, bool)]
            for d, k in set(zip(dims.tolist(), sets.tolist(), strict=True)):
                at = np.flatnonzero((dims == d) & (sets == k))
                if (d, k) not in apart:
                    rows.append(at), cells.append(np.zeros(len(at), np.int64)), guests.append(np.zeros(len(at), bool))
                    continue
                data = np.frombuffer(b"".join(batch.column(4).take(pa.array(at)).to_pylist())).reshape(-1, d)
                near = data @ sent.value[d, k].T
                home = near.argmax(axis=1)
                own = near[np.arange(len(at)), home][:, None]
                close = own - near <= reach * apart[d, k][home] + 1e-12
                row, cell = np.nonzero(close & (np.arange(near.shape[1]) <= home[:, None]))
                rows.append(at[row]), cells.append(cell), guests.append(cell != home[row])
            row = np.concatenate(rows)
            take = pa.array(row)
            for i in range(0, len(row), 8192):
                part = slice(i, i + 8192)
                picked = [c.take(take[part]) for c in batch.columns[:5]]
                yield pa.RecordBatch.from_arrays(
                    [picked[0], picked[1], pa.array(np.concatenate(cells)[part], pa.int32()),
                     pa.array(np.concatenate(guests)[part]), picked[2], picked[3], picked[4]],
                    ["label", "dims", "cell", "guest", "cid", "n", "unit"])

    return classes.select("label", "dims", "cid", "n", "unit", "cells").mapInArrow(
        run, f"label {label}, dims int, cell int, guest boolean, cid string, n bigint, unit binary")


def _tiles(n: int):
    return [slice(i, min(i + TILE, n)) for i in range(0, n, TILE)]


def _links(data: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows are linked, as a symmetric boolean matrix: every product is made once, tile by tile."""
    linked = np.zeros((len(data), len(data)), dtype=bool)
    for t in _tiles(len(data)):
        linked[t, : t.stop] = data[t] @ data[: t.stop].T >= threshold
        own = np.tril(linked[t, t], -1)
        linked[t, t] = own | own.T
        linked[: t.start, t] = linked[t, : t.start].T
    return linked


def _labels(linked: np.ndarray) -> np.ndarray:
    """The least row that each row of a symmetric boolean matrix reaches."""
    n = len(linked)
    label = np.arange(n, dtype=np.int32)
    while True:
        least = np.concatenate([np.where(linked[t], label, n).min(axis=1, initial=n) for t in _tiles(n)])
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Block:
    """Home vectors of one block, then its guests, compared as they arrive."""

    def __init__(self, threshold: float):
        self.threshold, self.cids, self.data, self.weights = threshold, [], [], []
        self.label = None

    def home(self, cid, n, vector):
        self.cids.append(cid), self.data.append(vector), self.weights.append(n)

    def close(self):
        """All homes are there: products among them."""
        self.data, self.weights = np.stack(self.data), np.asarray(self.weights, dtype=np.float64)
        linked = _links(self.data, self.threshold)
        self.links = np.concatenate([linked[t] @ self.weights for t in _tiles(len(linked))])
        self.label = _labels(linked)
        self.order = np.argsort(self.label, kind="stable")
        self.firsts = np.flatnonzero(np.diff(self.label[self.order], prepend=-1))
        self.reps = [self.cids[i] for i in self.label[self.order][self.firsts]]
        return [(c, self.cids[r], None) for c, r in zip(self.cids, self.label, strict=True) if self.cids[r] != c]

    def guests(self, cids, weights, vectors):
        """Edges of guests, and their links with this block, which no other task counts."""
        linked = self.data @ np.stack(vectors).T >= self.threshold
        self.links += linked @ np.asarray(weights, dtype=np.float64)
        counts = self.weights @ linked
        group, guest = np.nonzero(np.logical_or.reduceat(linked[self.order], self.firsts, axis=0))
        return [(cids[g], self.reps[c], None) for c, g in zip(group, guest, strict=True)] + [
            (cids[g], None, int(counts[g])) for g in np.flatnonzero(counts)]

    def totals(self):
        return [(c, None, int(x)) for c, x in zip(self.cids, self.links, strict=True)]


def compare(placed: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, links)``: weights of links per vector, to be added up, and edges ``a``-``b`` that connect what is linked.

    The rows of a block come sorted with the homes first, so a task holds one
    block of homes and a batch of the vectors compared with it.
    """

    def run(batches):
        key, block, waiting = None, None, ([], [], [])

        def flush():
            out = []
            if block is not None:
                if block.label is None:
                    out += block.close()
                if waiting[0]:
                    out += block.guests(*waiting)
                for x in waiting:
                    x.clear()
            return out

        for batch in batches:
            out = []
            for *k, guest, cid, n, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if block is not None:
                        out += flush() + block.totals()
                    key, block = k, None
                if not guest:
                    block = block or _Block(threshold)
                    block.home(cid, n, np.frombuffer(vector))
                elif block is not None:
                    if block.label is None:
                        out += block.close()
                    waiting[0].append(cid), waiting[1].append(n), waiting[2].append(np.frombuffer(vector))
                    if len(waiting[0]) >= TILE:
                        out += flush()
            yield made(out)
        if block is not None:
            yield made(flush() + block.totals())

    def made(out):
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
            ["a", "b", "links"])

    keys = ["label", "dims", "cell", "block"]
    ready = placed.repartition(*keys).sortWithinPartitions(*keys, "guest", "cid")
    return ready.select(*keys, "guest", "cid", "n", "unit").mapInArrow(run, "a string, b string, links bigint")


def in_blocks(assigned: DataFrame, block_vectors: int) -> DataFrame:
    """Cut the homes of each cell into blocks: guests of the cell visit each of them, homes visit those before their own."""
    keys = ["label", "dims", "cell"]
    bytes_each = F.col("dims") * F.lit(8)
    counts = assigned.where(~F.col("guest")).groupBy(*keys).count().select(*keys, F.ceil(F.greatest(
        F.col("count") / F.lit(block_vectors), F.col("count") * bytes_each / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
    last = F.when(F.col("guest"), F.col("blocks") - 1).otherwise(F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    rows = assigned.join(counts, keys).withColumn("last", last)
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last")))).withColumn(
        "guest", F.col("guest") | (F.col("block") != F.col("last"))).drop("last", "blocks")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", cell_vectors: int = CELL_VECTORS, block_vectors: int = BLOCK_VECTORS,
    max_cells: int = MAX_CELLS, sample: int = SAMPLE, margin: float = MARGIN,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Vectors of equal, non-null label and equal length are linked where their
    cosine in double precision is at least ``threshold``. Vectors that are null,
    empty, zero or hold null or non-finite components, and those without label,
    link with nothing. Equal unit vectors are one class that is compared once
    (copies link with each other), so a common vector costs one comparison.
    Repeated rows are vectors of their own; null ids are linked but name a
    component only where it has no other id. ``kept`` marks the row whose id
    names its component. Other columns are ignored; an empty table gives an
    empty result.

    The centres are fitted on at most ``sample`` vectors for each of the 16
    commonest dimensions and there are at most ``max_cells`` in a set, which bounds
    what is collected and broadcast; all vectors are assigned. A label beyond these
    dimensions is one cell. A cell above ``block_vectors`` (or ``BLOCK_BYTES``) is
    cut into blocks that are compared in different tasks.
    """
    # ids of classes are digests, so repeated or missing vec_ids do no harm
    rows = written(units(vectors, id_col, vector_col, label_col).withColumn("cid", F.when(
        F.col("unit").isNotNull() & F.col("label").isNotNull(),
        F.md5(F.concat(F.col("unit"), F.encode(F.col("label").cast("string"), "UTF-8"))))), "units")
    linkable = rows.where(F.col("cid").isNotNull())
    classes = written(linkable.groupBy("cid").agg(
        F.first("label").alias("label"), F.first("dims").alias("dims"), F.first("unit").alias("unit"),
        F.count("*").alias("n"), F.min("vec_id").alias("least")), "classes")
    large = large_labels(classes, cell_vectors, max_cells)
    sized = classes.join(when_small(large.select("label", "dims", "cells")), ["label", "dims"], "left").withColumn(
        "cells", F.coalesce("cells", F.lit(1)))
    assigned = written(assign(sized, fit_cells(sized, large, sample), threshold, margin), "cells")
    found = written(compare(in_blocks(assigned, block_vectors), threshold), "links")
    roots = components(found.where(F.col("b").isNotNull()).select("a", "b"), "vectors")
    named = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "cid", "least", F.coalesce("component", "cid").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    links = found.where(F.col("links").isNotNull()).groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    described = classes.select("cid", "n").join(named, "cid").join(least, "root").join(links, "cid").select(
        "cid", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    joined = rows.select("vec_id", "cid").join(described, "cid", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))

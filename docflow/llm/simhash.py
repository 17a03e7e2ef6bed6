"""Near-duplicates by SimHash fingerprints, searched with BK-trees.

Fingerprints are linked where at most four bits differ. Cut into six blocks,
two such fingerprints have at least two blocks in common, so all links are found
inside the shards named by a pair of blocks. A shard's tree goes to the task
that has the shard's queries; it is not broadcast to all tasks, because all
trees together grow with the documents. A shard above ``tree_limit`` is split
into several trees and its queries are sent to each of them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import components, text_bytes, written

WIDTHS = (11, 11, 11, 11, 10, 10)
SEED = 42


def shingles(text: bytes, width: int) -> np.ndarray:
    """Hashes of the word shingles in their order. ASCII letters count as lower case; fewer words make one shingle."""
    words = text.lower().split()  # bytes.split cuts at \x20 and \x09-\x0d
    if not words:
        return np.empty(0, dtype="<u8")
    line, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    return np.fromiter((digest(line[a:b], SEED) for a, b in spans), dtype="<u8", count=n)


def fingerprint(text: bytes, width: int = 4) -> int:
    """SimHash of the word shingles; 0 without words."""
    return simhash(shingles(text, width))


def simhash(hashes: np.ndarray) -> int:
    n = len(hashes)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):
        bits = np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every whole text; null and empty texts have 0."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(x) for x in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp bigint")


class BKTree:
    """Children keyed by their distance to the parent."""

    def __init__(self):
        self.root = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            d = (node[0] ^ value).bit_count()
            if d == 0:
                return
            child = node[1].get(d)
            if child is None:
                node[1][d] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            at, children = todo.pop()
            d = (at ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for e, child in children.items():
                if d - radius <= e <= d + radius:
                    todo.append(child)
        return found


class _Shard:
    """The tree of one shard and which of its members are connected so far; what only asks is not kept."""

    def __init__(self, radius: int):
        self.tree, self.root, self.radius = BKTree(), {}, radius

    def _find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def ask(self, value: int) -> list[tuple[int, int]]:
        """An edge to one member of every group that ``value`` is linked with; these groups are one from now on."""
        groups = {}
        for other in self.tree.within(value, self.radius):
            if other != value:
                groups.setdefault(self._find(other), other)
        if groups:
            self.root |= dict.fromkeys(groups, min(groups))
        return [(value, other) for other in groups.values()]

    def add(self, value: int) -> list[tuple[int, int]]:
        """``ask``, then become a member: so every pair of members is compared once."""
        found = self.ask(value)
        self.root[value] = self._find(found[0][1]) if found else value
        self.tree.add(value)
        return found


def _shards(fps: DataFrame, tree_limit: int) -> DataFrame:
    """``(key, salt, tree, fp)``: each fingerprint under every pair of its blocks."""
    starts = np.cumsum((0, *WIDTHS[:-1])).tolist()
    blocks = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(starts, WIDTHS, strict=True)]
    keys = F.array(*[
        F.shiftleft(F.lit(i).cast("bigint"), 22).bitwiseOR(F.shiftleft(blocks[a], 11)).bitwiseOR(blocks[b])
        for i, (a, b) in enumerate(combinations(range(len(WIDTHS)), 2))])
    rows = fps.select("fp", F.explode(keys).alias("key"))
    # shards of one fingerprint have no links; large ones are split
    counts = rows.groupBy("key").count().where("count > 1").withColumn(
        "trees", F.ceil(F.col("count") / F.lit(tree_limit)).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    return rows.join(counts, "key").select(
        "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("salt")
    ).select("key", "salt", "fp", (F.col("own") == F.col("salt")).alias("tree"))


def links(fps: DataFrame, radius: int = 4, tree_limit: int = 4096) -> DataFrame:
    """``(a, b)``: edges between distinct fingerprints that connect all within ``radius`` (at most 4)."""
    if not 0 <= radius < len(WIDTHS) - 1:
        raise ValueError("the blocks serve a radius of at most 4")

    def run(batches):
        key, shard = None, None
        for batch in batches:
            found = []
            for k, salt, fp, tree in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k, salt) != key:
                    key, shard = (k, salt), _Shard(radius)
                fp &= (1 << 64) - 1
                found += shard.add(fp) if tree else shard.ask(fp)
            yield edges(list(zip(*found, strict=True)) or [[], []])

    def edges(out):
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in out], ["a", "b"])

    placed = _shards(fps.select("fp"), tree_limit).repartition("key", "salt").sortWithinPartitions(
        "key", "salt", F.desc("tree"), "fp")  # members first, so a task holds one tree and a batch of what asks it
    return placed.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Documents are linked where their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the least id reachable. Null and empty texts, and
    texts without words, have fingerprint 0 and are linked like any other.
    Repeated rows stay repeated; rows with a null id are linked but never name a
    component that has another id. An empty table gives an empty result. Other
    columns are ignored.
    """
    found = written(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes, radius), "simhash")
    rooted = written(classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")), "simhash-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return found.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

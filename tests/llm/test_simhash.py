"""SimHash groups against all pairs."""

import random

import xxhash
from cases import rows_of, texts
from pyspark.sql import functions as F

from docflow.llm import queries, simhash


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    of = {fp: fp for fp in fps}

    def find(x):
        while of[x] != x:
            x = of[x]
        return x

    distinct = sorted(of)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin(a ^ b).count("1") <= 4:
                of[find(a)] = find(b)
    least = {}
    for (i, _), fp in zip(rows, fps, strict=True):
        if i is not None:
            least[find(fp)] = min(i, least.get(find(fp), i))
    return sorted(((i, f"{fp:016x}", least.get(find(fp))) for (i, _), fp in zip(rows, fps, strict=True)), key=str)


NAMES = ("doc_id", "fingerprint", "component_id")


def test_edge_cases(docs):
    assert rows_of(simhash.near_duplicates(docs), *NAMES) == brute(texts())


def test_query(ready, sf_dir, sf_texts):
    assert rows_of(queries.QUERIES["op10_simhash"](ready, sf_dir), *NAMES) == brute(sf_texts)


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_fingerprint_is_sparks_hash(ready):
    row = ready.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first()
    assert simhash.fingerprint(b"a b c d") == row.h % 2**64


def test_links_with_split_shards(ready):
    """Chains and clumps give the same components whatever the size of the trees."""
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:20]:
        for _ in range(30):
            b ^= sum(1 << p for p in rng.sample(range(64), rng.randrange(1, 6)))
            fps.add(b)
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    df = ready.createDataFrame(signed, "fp bigint")

    def groups(limit):
        from docflow.llm.common import components

        found = {}
        for r in components(simhash.links(df, tree_limit=limit)).collect():
            found.setdefault(r.component, set()).add(r.node % 2**64)
        return sorted(map(sorted, found.values()))

    want, todo = [], set(fps)
    while todo:
        group, grow = set(), {todo.pop()}
        while grow:
            group |= grow
            grow = {y for y in todo if any((x ^ y).bit_count() <= 4 for x in grow)}
            todo -= grow
        if len(group) > 1:
            want.append(sorted(group))
    assert groups(4096) == sorted(want)
    assert groups(3) == sorted(want)


def test_a_shard_keeps_its_members_only():
    """Many questions leave the shard as it is; each gives an edge per group it meets, and joins these groups."""
    shard = simhash._Shard(4)
    assert shard.add(0) == [] and shard.add(0xFF) == [] and shard.add(1) == [(1, 0)]
    assert sorted(first for _, first in shard.ask(0x0F)) in ([0, 0xFF], [1, 0xFF])
    for value in range(1 << 12, 1 << 13):
        assert len(shard.ask(value)) <= 1  # one group by now
    assert set(shard.root) == {0, 1, 0xFF} and len({shard._find(x) for x in shard.root}) == 1


def test_repeated_rows_and_hot_shards(ready):
    """One block value for thousands of fingerprints: trees of any size give the same edges' groups."""
    from docflow.llm.common import components

    rng = random.Random(8)
    low = [rng.getrandbits(20) for _ in range(1500)]
    df = ready.createDataFrame([(x,) for x in sorted(set(low))], "fp bigint")
    groups = [{r.node: r.component for r in components(simhash.links(df, tree_limit=n)).collect()} for n in (4096, 100)]
    assert groups[0] == groups[1] and len(groups[0]) > 100

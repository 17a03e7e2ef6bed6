"""Mixing: the schedule's bounds, every row once, order by target."""

from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from cases import SF_DIR

from docflow.llm import mixing


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [1000, 1, 1, 1], [7] * 11, [0, 5], [0, 0], [1, 2, 3, 4, 5, 6, 7, 50]])
def test_schedule_stays_within_a_block(ready, weights):
    slots = 64
    target = ready.createDataFrame([(f"s{i:02d}", w) for i, w in enumerate(weights)], "_source string, weight bigint")
    plan = mixing.schedule(mixing.shares(target, slots), slots).collect()
    assert sorted(r.slot for r in plan) == list(range(slots))
    q = {r._source: r.q for r in plan}
    assert len(q) == len(weights) and sum(q.values()) == slots and min(q.values()) >= 1
    total = sum(weights)
    for i, w in enumerate(weights):
        if total:
            assert abs(q[f"s{i:02d}"] - 1 - Fraction((slots - len(weights)) * w, total)) < 1
    done = defaultdict(int)
    for r in sorted(plan, key=lambda r: r.slot):
        assert r.k == done[r._source]
        assert r.k * slots // r.q <= r.slot < -(-(r.k + 1) * slots // r.q)  # released and in time
        done[r._source] += 1
        for s in q:
            assert abs(done[s] - Fraction((r.slot + 1) * q[s], slots)) < 1


def test_too_many_sources(ready):
    target = ready.createDataFrame([(str(i), 1) for i in range(9)], "_source string, weight bigint")
    with pytest.raises(Exception, match="more sources"):
        mixing.shares(target, 8).collect()


@pytest.mark.parametrize("given, whole", [([0.6, 0.3, 0.1], [6, 3, 1]), ([1.5, None, 0.0], [1, 0, 0]), ([2.0, 4.0, 1.0], [2, 4, 1])])
def test_fractions_keep_their_proportions(ready, given, whole):
    def found(weights, kind):
        rows = ready.createDataFrame([(str(i), w) for i, w in enumerate(weights)], f"_source string, weight {kind}").na.fill({"weight": 0})
        return {r._source: r.q for r in mixing.shares(rows).collect()}

    assert found(given, "double") == found(whole, "bigint")
    assert found([Decimal(w) / 2 for w in whole], "decimal(9, 2)") == found(whole, "bigint")


@pytest.mark.parametrize("weights", [[1.0, -0.5], [1.0, float("nan")], [1.0, float("inf")]])
def test_odd_weights_are_refused(ready, weights):
    rows = ready.createDataFrame([(str(i), w) for i, w in enumerate(weights)], "_source string, weight double")
    with pytest.raises(Exception, match="a weight is"):
        mixing.shares(rows).collect()


@pytest.mark.parametrize("broadcast", [1 << 16, 1])
def test_more_sources_than_usual(ready, monkeypatch, broadcast):
    """The period follows the number of sources, and every row is in the mixture once."""
    monkeypatch.setattr(mixing, "SLOTS", 8)
    monkeypatch.setattr(mixing, "BROADCAST_SLOTS", broadcast)
    assert [mixing.slots_for(n) for n in (0, 1, 8, 9, 33)] == [8, 8, 8, 16, 64]
    rows = ready.createDataFrame([(i, "x" * (i % 7), f"s{i % 33}") for i in range(400)], "doc_id bigint, text string, source string")
    found = mixing.mix(rows, block_bytes=16).collect()
    assert sorted(r.doc_id for r in found) == list(range(400))
    blocks = {(r.source, r.mix_block): r.mix_slot for r in found}
    assert len(set(blocks.values())) == len(blocks)  # a slot has one block
    for (source, block), slot in blocks.items():
        assert blocks.get((source, block + 1), slot + 1) > slot


ROWS = [(i, "x" * (i % 50), "a") for i in range(600)] + [(1000 + i, "y" * 20, "b") for i in range(100)] + [
    (2000, None, None), (2001, "", None), (None, "z", "b"), (None, "z", "b"), (2002, "long" * 5000, "a"), (2003, "q", "")]


@pytest.fixture(scope="module")
def rows(ready):
    return ready.createDataFrame([(*r, 5, "k") for r in ROWS], "doc_id bigint, text string, source string, q int, _key string").repartition(3)


def test_mixture(ready, rows):
    weights = ready.createDataFrame([("a", 3), ("b", 1), (None, 1)], "source string, weight bigint")
    found = mixing.mix(rows, weights, slots=32, block_bytes=256).collect()
    assert sorted(((r.doc_id, r.text, r.source) for r in found), key=str) == sorted(ROWS, key=str)
    plan = {(s, k): (slot, q) for s, q, k, slot in mixing.schedule(mixing.shares(ready.createDataFrame(
        [("=a", 3), ("=b", 1), ("=", 0), ("null", 1)], "_source string, weight bigint"), 32), 32).select("_source", "q", "k", "slot").collect()}
    at = defaultdict(int)
    import hashlib

    key = lambda r: int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16)
    for r in sorted(found, key=lambda r: (key(r), r.doc_id or 0, len(r.text or ""))):
        s = "null" if r.source is None else "=" + r.source
        q = plan[s, 0][1]
        block, offset = divmod(at[s], 256)
        assert (r.mix_block, r.mix_offset, r.mix_slot) == (block, offset, block // q * 32 + plan[s, block % q][0]), r
        at[s] += len(r.text or "") + 1


def test_empty(rows):
    assert mixing.mix(rows.limit(0)).count() == 0


def test_query_equals_sql(ready, sf_dir):
    from sql_check import compare

    assert compare(ready, SF_DIR, "op3_mixing")


def test_no_python_in_the_plan(rows):
    plan = mixing.mix(rows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan

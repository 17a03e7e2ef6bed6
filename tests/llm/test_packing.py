"""Packing: every id in one piece, full sequences, exact checksums."""

import zlib
from collections import defaultdict

import numpy as np
from cases import texts
from tokenizers import Tokenizer

from docflow.llm import packing, queries

PATH = queries.tokenizer("byte_bpe_50k.json")


def ids_of(rows):
    t = Tokenizer.from_file(PATH)
    return [(i, np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], dtype="<u4")) for i, x in rows]


def check(pieces, rows, window=1024):
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    padding = 0
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == s[0].sequence_tokens <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    want, got = defaultdict(list), defaultdict(list)
    for i, ids in ids_of(rows):
        want[i].append(ids)
    for i, copies in want.items():
        n = len(copies[0])
        if len({len(c) for c in copies}) == 1 and len({c.tobytes() for c in copies}) == 1:
            covered = np.zeros(n, dtype=int)
            for p in docs[i]:
                assert p.doc_tokens == n
                assert p.ids_crc32 == zlib.crc32(copies[0][p.start : p.start + p.length].tobytes())
                covered[p.start : p.start + p.length] += 1
            assert (covered == len(copies)).all(), i
        got[i] = sum(p.length for p in docs[i])
        assert got[i] == sum(map(len, copies))
    assert set(docs) == set(want)
    return padding


def test_edge_cases(docs):
    assert check(packing.pack(docs, PATH).collect(), texts()) == 0


def test_query(ready, sf_dir, sf_texts):
    pieces = queries.QUERIES["op4_tier_packing"](ready, sf_dir).collect()
    assert check(pieces, sf_texts) == 0
    assert {p.tier for p in pieces} >= {1024, 512}


def test_small_windows_and_steps(docs):
    pieces = packing.pack(docs, PATH, window=16, smallest=4, step_tokens=64).collect()
    assert check(pieces, texts(), 16) == 0
    steps = defaultdict(int)
    for p in pieces:
        steps[p.sequence_id >> 40, p.tier, p.step_group] += p.length
    assert max(steps.values()) == 64
    assert len({group for _, _, group in steps}) == len(steps)
    for (task, tier, group), tokens in steps.items():
        assert tokens == 64 or (task, tier, group + 1) not in steps


def test_empty(empty):
    assert packing.pack(empty, PATH).count() == 0


def test_chunks_are_encoded_together_and_cut_by_their_bytes():
    """Words after a blank are one call without separators; ids are those of the whole text."""
    with open(queries.tokenizer("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = packing._Encoder(f.read())
    calls = []
    plain = encoder.encode
    encoder.encode = lambda text: calls.append(text) or plain(text)
    texts = ["It's a naïve test, 日本語 'tis\nnext' s line 12 3.5", "na\u0308ive 𝒳 été\nIt's it's", "one"]
    found = encoder.ids(texts)
    assert " a naïve test, 日本語".replace(" ", "") in "".join(calls).replace(" ", "") and any("\n" not in x and " a naïve" in x for x in calls)
    assert found == [plain(x).tobytes() for x in texts]

"""Packing documents into sequences of several context sizes.

Documents are cut into full windows of the largest size; what is left is routed
by its length to a tier of the next power of two. Each tier is packed from its
own pieces, the gaps of a window being filled from shorter tiers: whole pieces
that fit best first, then a piece that is cut. Every task packs what it reads,
so nothing is shuffled.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docflow.llm.common import text_bytes

PIECES_KEPT = 4096
CHUNKS_KEPT = 1_200_000
TEXTS_AT_ONCE = 200
_LOADED: dict = {}
_OTHER_SPACE = re.compile(r"[^\S \n]")
_UNEVEN = ("  ", " \n", "\n ", "\n\n", "\x00", "<|")


def even(text: str) -> bool:
    """White space is single blanks and line ends between other characters, and no special string occurs."""
    return bool(text) and text[0] not in " \n" and text[-1] not in " \n" and not any(
        x in text for x in _UNEVEN) and not _OTHER_SPACE.search(text)


SCHEMA = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "tier int, sequence_tokens bigint, step_group bigint"
)


class _Encoder(dict):
    """Ids of a chunk as little-endian 32-bit numbers.

    A byte-level tokenizer starts a new word at a single blank (which goes with
    the word after it) and at a single line end, so chunks cut there are encoded
    once and joined; a text with other white space is encoded as a whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.sizes = None  # bytes of each id, where ids stand for the bytes of a text
        if type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and self.tokenizer.normalizer is None:
            vocabulary = self.tokenizer.get_vocab()
            self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
            for token, i in vocabulary.items():
                self.sizes[i] = len(token)  # a character for each byte

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def learn(self, chunks: list[str]) -> None:
        """Encode new chunks in one call, a line each; the line ends are single ids and tell them apart."""
        if len(self) + len(chunks) > CHUNKS_KEPT:
            self.clear()
        line_end = self.encode("\n")
        self["\n"] = line_end.tobytes()
        chunks = self._joined([x for x in chunks if x != "\n"])
        if not chunks:
            return
        found = self.encode("\n".join(chunks))
        cuts = np.flatnonzero(found == line_end[0]) if len(line_end) == 1 else []
        if len(cuts) != len(chunks) - 1:  # not a tokenizer whose words end at a line end
            self.update((x, self.encode(x).tobytes()) for x in chunks)
            return
        raw = found.tobytes()
        self.update((x, raw[4 * a + 4 : 4 * b]) for x, a, b in zip(chunks, [-1, *cuts], [*cuts, len(found)], strict=True))

    def _joined(self, chunks: list[str]) -> list[str]:
        """Encode the chunks that begin with a blank as one text, cut by the bytes of its ids; the others are left."""
        spaced = [x for x in chunks if x[0] == " "]
        if self.sizes is None or not spaced:
            return chunks
        found = self.encode("".join(spaced))
        at = np.cumsum(self.sizes[found])
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, spaced)), dtype=np.int64, count=len(spaced)))
        cuts = np.searchsorted(at, ends)
        if at[-1] != ends[-1] or not np.array_equal(at[cuts], ends):
            return chunks
        raw, cuts = found.tobytes(), (4 * (cuts + 1)).tolist()
        self.update(zip(spaced, [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)], strict=True))
        return [x for x in chunks if x[0] != " "]

    def ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            known, new = [], []
            for text in texts[i : i + TEXTS_AT_ONCE]:
                if not even(text):
                    known.append(self.encode(text).tobytes())
                    continue
                chunks = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
                found = list(map(self.get, chunks))
                missing = [n for n, x in enumerate(found) if x is None] if None in found else []
                new += [chunks[n] for n in missing]
                known.append((found, [(n, chunks[n]) for n in missing]))
            if new:
                self.learn(list(dict.fromkeys(new)))
            for item in known:
                if not isinstance(item, bytes):
                    found, missing = item
                    for n, chunk in missing:
                        found[n] = self[chunk]
                    item = b"".join(found)
                out.append(item)
        return out


def _encoder(spec: str) -> _Encoder:
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = _Encoder(spec)
    return _LOADED[key]


class TierPacker:
    """Packs pieces ``(ids, document, start)`` into windows whose sizes are the tiers."""

    def __init__(self, window: int, smallest: int, step_tokens: int, first_id: int):
        if window & (window - 1) or smallest & (smallest - 1) or smallest > window:
            raise ValueError("tiers are powers of two")
        self.window, self.smallest, self.step_tokens = window, smallest, step_tokens
        self.first_id = self.next_id = first_id
        self.sequences = {}
        self.by_length = [[] for _ in range(window + 1)]
        self.lengths = 0  # bit n is set where pieces of length n wait
        self.waiting = self.tokens = 0
        self.carried: list[tuple] = []  # less than a window, from before the last turn
        self.out: list[tuple] = []

    def add(self, ids: bytes, document) -> None:
        n, at = len(ids) // 4, 0
        while n - at >= self.window:
            self._emit([(ids[4 * at : 4 * (at + self.window)], document, at)], self.window)
            at += self.window
        if at < n:
            self._put((ids[4 * at :], document, at))
        if self.waiting >= PIECES_KEPT:
            self._pack(PIECES_KEPT // 8)

    def _put(self, piece) -> None:
        n = len(piece[0]) // 4
        self.by_length[n].append(piece)
        self.lengths |= 1 << n
        self.waiting += 1
        self.tokens += n

    def _take(self, most: int, least: int = 1):
        """The longest waiting piece of ``least`` to ``most`` tokens."""
        n = (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1
        if n < least:
            return None
        return self._pop(n)

    def _pop(self, n: int):
        piece = self.by_length[n].pop()
        if not self.by_length[n]:
            self.lengths ^= 1 << n
        self.waiting -= 1
        self.tokens -= n
        return piece

    def _fill(self, size: int, pieces: list, used: int) -> None:
        """Fill a window of ``size`` exactly; enough tokens are waiting."""
        while used < size:
            piece = self._take(size - used)
            if piece is None:  # all are longer than the gap: the shortest of them is cut
                ids, document, start = self._pop((self.lengths & -self.lengths).bit_length() - 1)
                gap = size - used
                piece = (ids[: 4 * gap], document, start)
                self._put((ids[4 * gap :], document, start + gap))
            pieces.append(piece)
            used += len(piece[0]) // 4
        self._emit(pieces, size)

    def _pack(self, keep: int) -> None:
        """Pack every tier until about ``keep`` pieces wait."""
        pieces, self.carried = self.carried, []
        used = sum(len(x[0]) // 4 for x in pieces)
        if pieces and self.tokens + used >= self.window:
            self._fill(self.window, pieces, used)
        else:
            for piece in pieces:
                self._put(piece)
        size = self.window
        while size >= self.smallest:
            least = size // 2 + 1 if size > self.smallest else 1
            while self.waiting > keep and self.tokens >= size and (piece := self._take(size, least)):
                self._fill(size, [piece], len(piece[0]) // 4)
            size //= 2

    def turn(self) -> None:
        """All that waits goes before what comes; the rest, less than a window, starts the next one."""
        self._pack(0)
        while self.lengths:
            self.carried.append(self._pop((self.lengths & -self.lengths).bit_length() - 1))

    def finish(self) -> None:
        """The rest goes into windows of its binary digits, which need no padding."""
        self._pack(0)
        while self.tokens:
            self._fill(min(self.window, 1 << (self.tokens.bit_length() - 1)), [], 0)

    def _emit(self, pieces: list, size: int) -> None:
        n = self.sequences[size] = self.sequences.get(size, -1) + 1
        group, offset = self.first_id | size.bit_length() << 32 | n * size // self.step_tokens, 0
        for ids, (document, total), start in pieces:
            length = len(ids) // 4
            self.out.append((document, start, length, zlib.crc32(ids), total, self.next_id, offset, size, size, group))
            offset += length
        self.next_id += 1


def pack(
    docs: DataFrame, tokenizer: str, window: int = 1024, smallest: int = 128, step_tokens: int = 16384,
    end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", run_col: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` and ``length`` in the document's ids,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``tier`` (the
    sequence's size), ``sequence_tokens`` and ``step_group``.

    A document's ids are those of its whole text and ``end_id``; each lies in one
    piece. All sequences are full; those shorter than ``smallest`` come from the
    end of a task and are powers of two as well. Within a task and tier, runs of
    sequences with ``step_tokens`` tokens in all form a ``step_group``, so groups
    weigh the same whatever their context size, and its number names task, tier and
    run, so it is a key of its own. Null and empty texts are one
    id. Repeated rows are packed one by one, null ids are kept, other columns are
    ignored, an empty table gives an empty result. ``sequence_id`` names the task,
    so a task that is run again writes the same rows.

    With ``run_col``, consecutive rows of one value form a run. Runs are packed one
    after the other, so ``sequence_id`` follows their order (across tasks, that of
    the partitions) to less than a window; without it, order is by length only.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    end = end_id.to_bytes(4, "little")

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(spec.value)
        packer = TierPacker(window, smallest, step_tokens, TaskContext.get().partitionId() << 40)
        at = None
        for batch in batches:
            documents, texts = batch.column(0).to_pylist(), [x.decode() for x in text_bytes(batch.column(1))]
            turns = batch.column(2).to_pylist()
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                part = slice(i, i + TEXTS_AT_ONCE)
                for document, ids, turn in zip(documents[part], encoder.ids(texts[part]), turns[part], strict=True):
                    if turn != at:
                        packer.turn()
                        at = turn
                    packer.add(ids + end, (document, len(ids) // 4 + 1))
                if len(packer.out) >= 20_000:
                    yield rows(packer)
        packer.finish()
        yield rows(packer)

    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    types = [id_type, *[pa.int64()] * 6, pa.int32(), pa.int64(), pa.int64()]
    names = ["doc_id", *[x.split()[0] for x in SCHEMA.split(", ")]]

    def rows(packer):
        columns = list(zip(*packer.out, strict=True)) or [[]] * len(names)
        packer.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    turn = F.lit(0) if run_col is None else F.col(run_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), turn.alias("run")).mapInArrow(
        run, f"doc_id {kind.simpleString()}, {SCHEMA}")

"""Phrase collocations, counted exactly in counting quotient filters.

Texts become shards of word ids of their own, so no task needs the whole
dictionary. Words below the least count are in no candidate; the others get dense
ids, which are joined back to each shard. A phrase of up to four ids is packed
into two halves and permuted by a Feistel network, which is invertible: the top bits
(the quotient) name a place, all other bits (the remainder) are kept whole, so a
filter loses nothing and no two phrases share a counter. Filters are sorted by
quotient and remainder: a task counts some millions of places, cuts the filter at the
quotient's leading bits into segments, and each segment is merged over all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.common import text_bytes, when_small, written

SHARD_WORDS = 500_000
TASK_PHRASES = 2_000_000  # places that a task counts together before it sends them on
SEGMENT_PHRASES = 2_000_000
PART_WORDS = 50_000  # words whose phrases are made at once
MERGE_ROWS = 250_000  # counters that are merged at once
OUT_BYTES = 2_000_000  # filters that a task hands over at once
CUT_BYTES = 4_000_000
RANK_SALTS = 64
SCALE = 2_000_000

# A-Z become a-z, a break between pieces becomes a line feed, a tab becomes a blank
_TABLE = bytes(
    10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ROUNDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


class _Ids(dict):
    """Numbers words as they come; 0 is a break, 1 is the nothing between two blanks."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def word_ids(text: bytes, ids: _Ids):
    """Arrays of the ids of a whole text, some megabytes of it at a time, with a break at its end."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + CUT_BYTES)  # a blank never lies inside a word
        end = len(text) if end < 0 else end
        part = text[at:end].translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(ids.__getitem__, part), np.uint32, len(part))
        yield found[found != 1]
        at = end
    yield np.zeros(1, np.uint32)


def shards(docs: DataFrame, text_col: str, lang_col: str, shard_words: int) -> DataFrame:
    """``(lang, shard, n, words, counts, ids)``: texts of one language as numbers of the shard's own words.

    A shard ends with a text, so it exceeds ``shard_words`` by less than one text.
    """

    def run(batches):
        from pyspark import TaskContext

        langs, total, made = {}, 0, 0
        part = TaskContext.get().partitionId()

        def flush():
            nonlocal made
            for lang, (ids, parts) in langs.items():
                data = np.concatenate(parts)
                counts = np.bincount(data, minlength=len(ids))[2:]
                if counts.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([f"{part}-{made}"]), pa.array([int(counts.sum())], pa.int64()),
                         pa.array([list(ids)[2:]], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                         pa.array([counts], pa.list_(pa.int64())), pa.array([data.astype("<u4").tobytes()], pa.binary())],
                        ["lang", "shard", "n", "words", "counts", "ids"])
                    made += 1
            langs.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                ids, parts = langs.setdefault(lang, (_Ids(), []))
                for found in word_ids(text, ids):
                    parts.append(found)
                    total += len(found)
                if total >= shard_words:
                    yield from flush()
                    total = 0
        yield from flush()

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        run, "lang string, shard string, n bigint, words array<string>, counts array<bigint>, ids binary")


def _round(half: np.ndarray, key: np.uint64, bits: int) -> np.ndarray:
    h = (half + key) * _ROUNDS[0]
    h = (h ^ (h >> np.uint64(31))) * _ROUNDS[2]
    return h >> np.uint64(64 - bits)


def permute(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of pairs of halves of ``bits`` bits (1 to 62)."""
    for key in _ROUNDS:
        left, right = right, left ^ _round(right, key, bits)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(_ROUNDS):
        left, right = right ^ _round(left, key, bits), left
    return left, right


def joined(left: np.ndarray, right: np.ndarray, bits: int) -> list[np.ndarray]:
    """The halves as one sort key where 64 bits hold both."""
    return [left << np.uint64(bits) | right] if 2 * bits <= 64 else [left, right]


def halves(keys: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 2:
        return keys[0], keys[1]
    return keys[0] >> np.uint64(bits), keys[0] & np.uint64((1 << bits) - 1)


def summed(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys of sorted ones with the sums of their counts (one each without ``counts``)."""
    n = len(keys[0])
    new = np.ones(n, dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(new)
    sums = np.diff(first, append=n) if counts is None else np.add.reduceat(counts, first)
    return [k[first] for k in keys], sums.astype(np.int64, copy=False)


def counted(keys: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys in order with the sums of their counts (one each without ``counts``; a single key array is then sorted in place)."""
    if not len(keys[0]):
        return keys, np.empty(0, np.int64)
    if counts is None and len(keys) == 1:
        keys[0].sort()
    else:
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        keys, counts = [k[order] for k in keys], None if counts is None else counts[order]
    return summed(keys, counts)


def encode(keys: list[np.ndarray], counts: np.ndarray, bits: int, lead: int) -> bytes:
    """A counting quotient filter of keys that share their ``lead`` leading bits.

    A bit string holds a one for each slot and a zero after the run of each
    quotient, which places every slot; slots hold the whole remainders in order. A
    counter takes one byte, and eight more from 256 on.
    """
    width, n = (2 if len(keys) == 1 else 1) * bits, len(counts)
    span = max(0, min(width - lead, n.bit_length() - 1))
    low = width - lead - span
    quotient = keys[0] >> np.uint64(low) & np.uint64((1 << span) - 1)
    marks = np.zeros(n + (1 << span), dtype=bool)
    marks[np.arange(n) + quotient.astype(np.int64)] = True
    rest = [(keys[0] & np.uint64((1 << low) - 1), low), *((k, bits) for k in keys[1:])]
    whole = [k.astype("<u8").view(np.uint8).reshape(n, 8)[:, : (w + 7) // 8].tobytes() for k, w in rest]
    small = np.minimum(counts - 1, 255).astype(np.uint8)
    head = np.array([n, span], dtype="<u4").tobytes()
    return b"".join([head, np.packbits(marks).tobytes(), *whole, small.tobytes(), counts[small == 255].astype("<i8").tobytes()])


def decode(data: bytes, bits: int, lead: int, segment: int) -> tuple[list[np.ndarray], np.ndarray]:
    n, span = (int(x) for x in np.frombuffer(data, "<u4", 2))
    at, size = 8, (n + (1 << span) + 7) // 8
    marks = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n + (1 << span))
    quotient = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    at += size
    width = (2 if 2 * bits <= 64 else 1) * bits
    low, keys = width - lead - span, []
    for w in [low] if 2 * bits <= 64 else [low, bits]:
        size = (w + 7) // 8
        slots = np.zeros((n, 8), dtype=np.uint8)
        slots[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
        keys.append(slots.view("<u8").reshape(n).astype(np.uint64))
        at += n * size
    keys[0] |= (np.uint64(segment << span) | quotient) << np.uint64(low)
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64) + 1
    counts[counts == 256] = np.frombuffer(data, "<i8", offset=at + n)
    return keys, counts


def merged_ranges(tables: list[tuple[list[np.ndarray], np.ndarray]], rows: int = MERGE_ROWS):
    """Sorted tables of the sums of several sorted ones, by ranges of keys; each is made of about ``rows`` rows."""
    n = -(-sum(len(counts) for _, counts in tables) // rows)
    some = np.sort(np.concatenate([keys[0][::100] for keys, _ in tables]))
    limits = np.unique(some[np.arange(1, n) * len(some) // max(1, n)])
    ends = [[0, *np.searchsorted(keys[0], limits).tolist(), len(counts)] for keys, counts in tables]
    for i in range(len(limits) + 1):
        parts = [([k[e[i] : e[i + 1]] for k in keys], counts[e[i] : e[i + 1]]) for (keys, counts), e in zip(tables, ends, strict=True)]
        keys = [np.concatenate(k) for k in zip(*(keys for keys, _ in parts), strict=True)]
        yield counted(keys, np.concatenate([counts for _, counts in parts]))


def merged(tables: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """One sorted table of the sums of several."""
    ranges = list(merged_ranges(tables))
    return [np.concatenate(k) for k in zip(*(keys for keys, _ in ranges), strict=True)], np.concatenate([counts for _, counts in ranges])


def phrases_of(ids: np.ndarray, begins: int, bits: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of every phrase of 2 to ``longest`` ids, none 0, that starts at one of the first ``begins``."""
    known, shift, lefts, rights = ids > 0, np.uint64(bits // 2), [], []
    for m in range(2, longest + 1):
        n = max(0, min(begins, len(ids) - m + 1))
        at = np.flatnonzero(np.logical_and.reduce([known[j : j + n] for j in range(m)]))
        w = [ids[at + j] if j < m else np.uint64(0) for j in range(4)]
        lefts.append(w[0] << shift | w[1])
        rights.append(w[2] << shift | w[3] if m > 2 else np.zeros(len(at), np.uint64))
    return np.concatenate(lefts), np.concatenate(rights)


def filters(keys: list[np.ndarray], bits: int, lead: int):
    """Batches of (``segment``, ``filter``) of unsorted keys; a single key array is sorted in place."""
    width = (2 if len(keys) == 1 else 1) * bits
    if len(keys) == 1:
        keys[0].sort()
    order = np.lexsort(keys[::-1]) if len(keys) == 2 else None
    starts = np.arange(1 << lead, dtype=np.uint64) << np.uint64(width - lead)
    ends = np.append(np.searchsorted(keys[0], starts, sorter=order), len(keys[0]))
    names, blobs, size = [], [], 0
    for i in np.flatnonzero(np.diff(ends)).tolist():
        at = slice(ends[i], ends[i + 1])
        blobs.append(encode(*summed([k[at if order is None else order[at]] for k in keys]), bits, lead))
        names.append(i)
        size += len(blobs[-1])
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["segment", "filter"])
            names, blobs, size = [], [], 0
    if names:
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["segment", "filter"])


def build_filters(batches, bits: int, longest: int, lead: int, task_phrases: int, part_words: int):
    """Batches of (``segment``, ``filter``) from batches of (``ids``, ``known``).

    Phrases are made of ``part_words`` words at once, and go to one place in memory that is used again.
    """
    room = [np.empty(task_phrases + (longest - 1) * part_words, np.uint64) for _ in range(1 if 2 * bits <= 64 else 2)]
    size = 0
    for batch in batches:
        for i in range(batch.num_rows):
            known = batch.column(1)[i].values.to_numpy()
            local = np.frombuffer(batch.column(0)[i].as_buffer(), "<u4")
            to = np.zeros(int(local.max(initial=0)) + 1, np.uint32)
            to[(known >> 32) + 2] = known & 0xFFFFFFFF
            for at in range(0, len(local), part_words):
                part = to[local[at : at + part_words + longest - 1]].astype(np.uint64)
                halved = permute(*phrases_of(part, min(part_words, len(part)), bits, longest), bits)
                for k, found in zip(room, joined(*halved, bits), strict=True):
                    k[size : size + len(found)] = found
                size += len(halved[0])
                if size >= task_phrases:
                    yield from filters([k[:size] for k in room], bits, lead)
                    size = 0
    if size:
        yield from filters([k[:size] for k in room], bits, lead)


def merge_filters(batches, bits: int, lead: int, min_count: int, segment_phrases: int):
    """Batches of (``w1``, ``w2``, ``w3``, ``w4``, ``f``) from batches of (``segment``, ``filter``) in order of segments."""
    at, tables, size = None, [], 0

    def done():
        shift, mask = np.uint64(bits // 2), np.uint64((1 << bits // 2) - 1)
        for keys, counts in merged_ranges(tables):
            often = counts >= min_count
            left, right = restore(*halves([k[often] for k in keys], bits), bits)
            w = [left >> shift, left & mask, right >> shift, right & mask]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.astype(np.int32)) for x in w), pa.array(counts[often], pa.int64())], ["w1", "w2", "w3", "w4", "f"])

    for batch in batches:
        for i, segment in enumerate(batch.column(0).to_pylist()):
            if segment != at:
                if tables:
                    yield from done()
                at, tables, size = segment, [], 0
            tables.append(decode(batch.column(1)[i].as_buffer(), bits, lead, segment))
            size += len(tables[-1][1])
            if size > 2 * segment_phrases:  # permuted phrases spread evenly, so this is rare
                tables = [merged(tables)]
                size = len(tables[0][1])
    if tables:
        yield from done()


def count_phrases(shard_ids: DataFrame, bits: int, longest: int, lead: int, min_count: int, limits: tuple[int, int, int]) -> DataFrame:
    """``(w1, w2, w3, w4, f)``: phrases found ``min_count`` times, from rows of (``ids``, ``known``) per shard.

    ``known`` lists places in the shard's dictionary (the upper 32 bits) with their dense ids (the lower).
    """
    task_phrases, part_words, segment_phrases = limits

    def build(batches):
        return build_filters(batches, bits, longest, lead, task_phrases, part_words)

    def merge(batches):
        return merge_filters(batches, bits, lead, min_count, segment_phrases)

    found = shard_ids.select("ids", "known").mapInArrow(build, "segment int, filter binary")
    placed = found.repartition("segment").sortWithinPartitions("segment")
    return placed.mapInArrow(merge, "w1 int, w2 int, w3 int, w4 int, f bigint")


def dense(vocabulary: DataFrame) -> DataFrame:
    """Add ``id``: 1, 2, ... over all rows. Only the number of rows of each partition goes to the driver."""
    rows = written(vocabulary.withColumn("_at", F.monotonically_increasing_id()), "vocabulary")
    part, offset, total = F.shiftrightunsigned("_at", 33).cast("int"), [], 0
    for r in rows.groupBy(part.alias("part")).count().orderBy("part").collect():
        offset += [F.lit(r.part), F.lit(total)]
        total += r["count"]
    before = F.element_at(F.create_map(*offset), part) if offset else F.lit(0)
    return rows.withColumn("id", (before + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).cast("int")).drop("_at")


def _packed(*words: Column) -> Column:
    w = [*words, *[F.lit(0)] * (4 - len(words))]
    half = lambda a, b: F.shiftleft(a.cast("bigint"), 31).bitwiseOR(b.cast("bigint"))
    return F.struct(half(w[0], w[1]).alias("p"), half(w[2], w[3]).alias("q"))


def _per_length(cases: dict[int, Column]) -> Column:
    return F.when(F.col("w4") > 0, cases[4]).when(F.col("w3") > 0, cases[3]).otherwise(cases[2])


def scored(phrases: DataFrame, unigrams: DataFrame) -> DataFrame:
    """Phrases with their lowest-scoring cut: ``key, w1..w4, a, l, r, score``. Arithmetic is in decimals."""
    w = [F.col(f"w{i}") for i in range(1, 5)]
    counts = phrases.select(_packed(*w).alias("key"), "f").unionByName(unigrams.select(_packed(F.col("id")).alias("key"), F.col("n").alias("f")))
    counts = when_small(written(counts.select("key.p", "key.q", "f"), "phrase-counts"))
    cuts = {m: F.array(*[
        F.struct(F.lit(k).alias("k"), _packed(*w[:k]).alias("left"), _packed(*w[k:m]).alias("right")) for k in range(1, m)])
        for m in (2, 3, 4)}
    rows = phrases.select(*w, F.col("f").alias("a"), F.explode(_per_length(cuts)).alias("cut"))
    for side in ("left", "right"):
        rows = rows.join(
            counts.select(F.col("p").alias("_p"), F.col("q").alias("_q"), F.col("f").alias(side[0])),
            (F.col(f"cut.{side}.p") == F.col("_p")) & (F.col(f"cut.{side}.q") == F.col("_q"))).drop("_p", "_q")
    score = F.expr(f"cast(cast(a as decimal(20, 0)) * {SCALE} div (cast(l as decimal(20, 0)) + r) as bigint)")
    best = rows.groupBy(*w, "a").agg(F.min(F.struct(score.alias("score"), F.col("cut.k").alias("k"), "l", "r")).alias("best"))
    return best.select(*w, "a", "best.l", "best.r", "best.score")


def uncovered(candidates: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer one contains with ``percent`` of their count."""
    w = [F.col(f"w{i}") for i in range(1, 5)]
    inside = {m: F.array(*[_packed(*w[i : i + n]) for n in range(2, m) for i in range(m - n + 1)]) for m in (3, 4)}
    held = longer.where("w3 > 0").select(
        F.explode(F.when(F.col("w4") > 0, inside[4]).otherwise(inside[3])).alias("key"), "f"
    ).groupBy(F.col("key.p").alias("_p"), F.col("key.q").alias("_q")).agg(F.max("f").alias("_top"))
    held = when_small(written(held, "covering"))
    keyed = candidates.withColumn("_key", _packed(*w))
    joined = keyed.join(held, (F.col("_key.p") == F.col("_p")) & (F.col("_key.q") == F.col("_q")), "left")
    covers = F.expr(f"cast(_top as decimal(20, 0)) * 100 >= cast(a as decimal(20, 0)) * {percent}")
    return joined.where(~F.coalesce(covers, F.lit(False))).drop("_key", "_p", "_q", "_top")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, longest: int = 4, top: int = 2000,
    cover_percent: int = 80, shard_words: int = SHARD_WORDS, task_phrases: int = TASK_PHRASES, segment_phrases: int = SEGMENT_PHRASES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of 2 to ``longest`` (at most 4) words of each language.

    A-Z count as a-z. Words are cut by blanks and tabs; phrases lie within pieces
    between ``.,;:!?``, line ends and the ends of texts. ``a``, ``l`` and ``r`` count
    the phrase and the two parts of its lowest-scoring cut (the first of equals), ``n`` counts all words
    of the language, ``score`` is ``floor(2000000 * a / (l + r))``. Phrases below ``min_count`` (at least 1) are no
    candidates; a candidate inside a longer one with ``cover_percent`` of its count is dropped. Order is by
    score, ``a`` (both descending) and the phrase's bytes.

    Null texts are empty, a null language is ``und``. Repeated rows count as often
    as they come. A language without candidates, and an empty table, give no rows. Other columns are
    ignored.

    A hot word or phrase is one counter per shard and then per task, so nothing is
    hot after that; languages are ranked in salted groups first.
    """
    if not 2 <= longest <= 4 or min_count < 1:
        raise ValueError("phrases have 2 to 4 words and are found at least once")
    spark = docs.sparkSession
    cut = written(shards(docs, text_col, lang_col, shard_words), "shards")
    totals = written(cut.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    listed = cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select(
        "lang", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    often = listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    vocabulary = dense(often)
    size = vocabulary.agg(F.max("id")).first()[0] or 0
    bits = 2 * max(1, int(size).bit_length())
    lead = min(bits, max(0, (longest - 1) * n_words // segment_phrases).bit_length())
    places = cut.select("lang", "shard", F.posexplode("words").alias("at", "word"))
    place = F.shiftleft(F.col("at").cast("bigint"), 32).bitwiseOR(F.col("id").cast("bigint"))
    known = places.join(when_small(vocabulary.select("lang", "word", "id")), ["lang", "word"]).groupBy("shard").agg(
        F.collect_list(place).alias("known"))  # bounded by the words of a shard
    limits = task_phrases, min(shard_words, PART_WORDS), segment_phrases
    found = count_phrases(cut.select("shard", "ids").join(known, "shard"), bits, longest, lead, min_count, limits)
    phrases = written(found, "phrases")
    candidates = uncovered(scored(phrases, vocabulary), phrases, cover_percent)

    langs = when_small(vocabulary.select(F.col("id").alias("w1"), "lang"))
    placed = candidates.join(langs, "w1").withColumn("_salt", F.pmod(F.xxhash64("w1", "w2", "w3", "w4"), F.lit(RANK_SALTS)))
    order = [F.desc("score"), F.desc("a")]
    first = placed.withColumn("_r", F.rank().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_r") <= top)
    best = written(first.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_r") <= top), "ranked")
    asked = best.select(F.explode(F.array("w1", "w2", "w3", "w4")).alias("id")).where("id > 0").distinct()
    names = when_small(written(vocabulary.join(when_small(asked), "id").select("id", "word"), "names"))
    for i in range(1, 5):
        best = best.join(names.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"_word{i}")), f"w{i}", "left")
    named = best.withColumn("phrase", F.concat_ws(" ", *[f"_word{i}" for i in range(1, 5)]))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return named.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top).join(when_small(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")

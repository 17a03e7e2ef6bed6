"""Ranked search over pages, and search inside words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.operators.search import PAGE_KEYS, WORD_BREAK, content, term_words

K1 = 1.2
B = 0.75
GRAM = 3


def _words() -> Column:
    return F.filter(F.split(F.lower(content()), WORD_BREAK), lambda w: w != "")


def _counted(words: Column) -> Column:
    """The distinct words of an array with how often each is in it, by sorting."""
    def runs(w: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == 1) | (F.get(w, i - 1) != F.get(w, i - 2)))
        return F.transform(F.array(first), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(w, i - 1).alias("token"), (F.coalesce(F.get(at, k + 1), F.size(w) + 1) - i).alias("tf"))))[0]

    # bound to variables, so the words are made once
    none = F.array().cast("array<struct<token:string,tf:int>>")
    return F.transform(F.array(F.array_sort(words)), lambda w: F.when(F.size(w) > 0, runs(w)).otherwise(none))[0]


def _page_words(index: DataFrame) -> DataFrame:
    """``(token, documentId, page, tf, length)`` of every row of the index."""
    words = index.select(*PAGE_KEYS, F.transform(F.array(_words()), lambda w: F.struct(F.size(w).alias("length"), _counted(w).alias("held")))[0].alias("_w"))
    # the outer form does not make the words a second time to test for them
    return words.select(*PAGE_KEYS, F.col("_w.length").alias("length"), F.explode_outer("_w.held").alias("_t")).where("_t is not null").select(
        F.col("_t.token").alias("token"), *PAGE_KEYS, F.col("_t.tf").alias("tf"), "length")


def _by_page(rows: DataFrame) -> DataFrame:
    return rows.groupBy("token", *PAGE_KEYS).agg(F.sum("tf").cast("int").alias("tf"), F.first("length").alias("length"))


def postings(index: DataFrame) -> DataFrame:
    """``(token, documentId, page, tf, length)``: how often a page holds a token, and the page's words."""
    return _by_page(_page_words(index))


def ordered_postings(index: DataFrame) -> DataFrame:
    """The postings in token order. Rows move once: the ranges that order them also bring those of a page together."""
    order = ["token", *PAGE_KEYS]
    return _by_page(_page_words(index).repartitionByRange(*order)).sortWithinPartitions(*order)


def write_postings(index: DataFrame, path: str) -> None:
    """Write the postings in token order and the totals that scores need; a common token spans many tasks."""
    ordered_postings(index).write.mode("errorifexists").parquet(f"{path}/postings")
    index.agg(F.count(F.lit(1)).alias("pages"), F.sum(F.size(_words())).alias("words")).write.mode("errorifexists").parquet(f"{path}/totals")


def search_ranked(
    spark: SparkSession, path: str, terms: list[str], k: int = 10, mode: str = "any", k1: float = K1, b: float = B,
) -> DataFrame:
    """The ``k`` best pages for the words of the terms, by BM25: ``rank, documentId, page, matched, score``.

    Reads the row groups of these words only. Each task keeps its own best pages
    before they are merged, and nothing else is sorted. Equal scores (to six
    digits) go by page. A word that no page holds counts for nothing; with ``mode`` ``all`` pages must hold
    every one. ``matched`` counts the words found.
    """
    words = sorted({w for ws in term_words(terms) for w in ws})
    rows = spark.read.parquet(f"{path}/postings").where(F.col("token").isin(words))
    totals = spark.read.parquet(f"{path}/totals").first()  # one row
    mean = (totals.words or 0) / max(1, totals.pages)
    # at most as many rows as there are words
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).select(
        "token", F.log1p((totals.pages - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    tf = F.col("tf")
    part = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / mean))
    scores = rows.join(F.broadcast(often), "token").groupBy(*PAGE_KEYS).agg(
        F.count(F.lit(1)).cast("int").alias("matched"), F.round(F.sum(part), 6).alias("score"))
    best = scores.where(F.col("matched") >= (len(words) if mode == "all" else 1)).orderBy(F.desc("score"), *PAGE_KEYS).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), *PAGE_KEYS))  # of k rows
    return best.select(rank.alias("rank"), *PAGE_KEYS, "matched", "score")


def grams(word: Column | str) -> Column:
    """Distinct runs of three characters; none of a shorter word."""
    word = F.col(word) if isinstance(word, str) else word
    starts = F.when(F.length(word) >= GRAM, F.sequence(F.lit(1), F.length(word) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(word, i, F.lit(GRAM))))


def gram_table(words: DataFrame, column: str = "token") -> DataFrame:
    """``(gram, word)`` of the distinct values of a column: tokens of an index, keys of form fields; words too short for a gram have an empty one."""
    distinct = words.select(F.col(column).alias("word")).where("word is not null").distinct()
    listed = F.when(F.length("word") >= GRAM, grams("word")).otherwise(F.array(F.lit("")))
    return distinct.select(F.explode(listed).alias("gram"), "word")


def write_gram_table(words: DataFrame, path: str, column: str = "token") -> None:
    """Write the table in the order of grams, so that a search reads the row groups of its own."""
    gram_table(words, column).repartitionByRange("gram", "word").sortWithinPartitions("gram", "word").write.mode("errorifexists").parquet(path)


def _grams_of(text: str) -> list[str]:
    return sorted({text[i : i + GRAM] for i in range(len(text) - GRAM + 1)})


def words_with(table: DataFrame, part: str) -> DataFrame:
    """``(word,)``: the words that contain ``part``.

    Candidates hold all its grams and are confirmed by looking. A part too short for a gram is looked for in all words.
    """
    wanted = _grams_of(part)
    if not wanted:
        return table.select("word").distinct().where(F.contains("word", F.lit(part)))
    held = table.where(F.col("gram").isin(wanted)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return held.where((F.col("n") == len(wanted)) & F.contains("word", F.lit(part))).select("word")


def words_like(table: DataFrame, word: str, edits: int = 1) -> DataFrame:
    """``(word, edits)``: the words that become ``word`` by at most ``edits`` insertions, deletions and replacements.

    An edit changes three grams at most, so a word must hold the others; it is confirmed by its distance. Where
    no gram need be left, all words are compared.
    """
    wanted = _grams_of(word)
    least = len(wanted) - GRAM * edits
    if least < 1:
        candidates = table.select("word").distinct()
    else:
        held = table.where(F.col("gram").isin(wanted)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        candidates = held.where(F.col("n") >= least)
    near = F.levenshtein("word", F.lit(word))
    return candidates.where(F.abs(F.length("word") - len(word)) <= edits).select("word", near.alias("edits")).where(F.col("edits") <= edits)


def search_inside(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """Pages that hold one of ``words``, from the token table: ``matched`` counts the different ones."""
    found = tokens.join(words.select(F.col("word").alias("token")), "token", "left_semi")
    return found.groupBy(*PAGE_KEYS).agg(F.count(F.lit(1)).alias("matched"))

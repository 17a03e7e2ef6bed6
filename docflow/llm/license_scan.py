"""License scans: an exact set-similarity join of text blocks with license templates.

A text is cut into overlapping blocks of words, so that every run as long as the
longest template lies in one block. A block is the set of its words that some
template holds; a template is found where a block contains the given part of the
template's set. Tokens are ordered by their frequency in all blocks, rarest first: a
block and a template that share ``need`` tokens share one of the first
``size - need + 1`` of each (prefix), both have ``need`` (length), and enough tokens
must be left behind the first shared one (position). What is left is confirmed on the sets.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import text_bytes, when_small, written

CONTAINMENT_PERCENT = 90

# Phrases of the base, and notices as license stewards publish them.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
            " License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
             " Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
            " the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

# words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def template_sets(templates: list[tuple[str, str]], percent: int) -> tuple[list[dict], int]:
    """Label, distinct words and needed overlap of each template, and the words of the longest."""
    cut = [(label, words_of(text.encode())) for label, text in templates]
    sets = [{"template": i, "label": label, "words": set(w), "need": -(-percent * len(set(w)) // 100)}
            for i, (label, w) in enumerate(cut) if w]
    return sets, max((len(w) for _, w in cut), default=1)


def _blocks(docs: DataFrame, id_col: str, text_col: str, ids: dict[bytes, int], phrases: dict[str, str], step: int, least: int) -> DataFrame:
    """Per text the places of the phrases, and its blocks with ``least`` tokens below ``len(ids)`` of templates."""
    get, n_tokens = ids.get, sum(v >= 0 for v in ids.values())
    # words of phrases that no template holds have numbers below -1
    runs = [([ids[w] for w in words_of(p.encode())], label) for p, label in phrases.items()]
    block = pa.list_(pa.struct([("start", pa.int64()), ("tokens", pa.list_(pa.int32()))]))

    def scanned(text):
        words = words_of(text)
        n = len(words)
        found = np.fromiter(map(get, words, repeat(-1)), np.int64, n)
        starts, labels = [], []
        for run, label in runs:
            hit = np.flatnonzero(np.logical_and.reduce([found[j : n - len(run) + 1 + j] == w for j, w in enumerate(run)])) if n >= len(run) else []
            if len(hit):
                starts.append(hit)
                labels.append(label)
        places = np.concatenate(starts) if starts else np.empty(0, np.int64)
        at = np.flatnonzero(found >= 0)
        last = max(0, -(-n // step) - 2)  # the block that ends the text
        home = at // step
        pairs = np.concatenate([(np.minimum(home, last) * n_tokens + found[at]), (home - 1)[home > 0] * n_tokens + found[at][home > 0]])
        pairs = np.unique(pairs)
        number, first = np.unique(pairs // max(1, n_tokens), return_index=True)
        parts = zip(number.tolist(), np.split(pairs % max(1, n_tokens), first[1:]), strict=True) if len(number) else []
        blocks = [{"start": k * step, "tokens": t.tolist()} for k, t in parts if len(t) >= least]
        spans = (int(places.min()), int(places.max())) if len(places) else (None, None)
        return n, len(places), *spans, sorted(set(labels)), blocks

    def run(batches):
        for batch in batches:
            columns = list(zip(*[scanned(t) for t in text_bytes(batch.column(1))], strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), block]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
             "blocks array<struct<start:bigint,tokens:array<int>>>")


def containment_join(blocks: DataFrame, sets: list[dict], ids: dict[bytes, int]) -> DataFrame:
    """``(_row, start, label, template, containment)`` of all blocks ``(_row, start, tokens)`` that meet a template's ``need``."""
    spark = blocks.sparkSession
    # frequencies of template tokens only: as many rows as templates have words
    often = {r.t: r["count"] for r in blocks.select(F.explode("tokens").alias("t")).groupBy("t").count().collect()}
    order = {t: i for i, t in enumerate(sorted(set(ids.values()), key=lambda t: (often.get(t, 0), t)))}
    place = F.array(*[F.lit(order[t]) for t in range(len(order))])
    held = [(s["template"], s["label"], s["need"], sorted(order[ids[w]] for w in s["words"])) for s in sets]
    prefixes = [(t, label, need, tokens, tokens[i], i) for t, label, need, tokens in held for i in range(len(tokens) - need + 1)]
    templates = spark.createDataFrame(
        prefixes, "template int, label string, need int, held array<int>, token int, held_at int")
    ranked = blocks.withColumn("tokens", F.array_sort(F.transform("tokens", lambda t: F.get(place, t))))
    least = min(s["need"] for s in sets)
    probes = ranked.select(
        "_row", "start", "tokens", F.size("tokens").alias("size"),
        F.posexplode(F.slice("tokens", F.lit(1), F.greatest(F.lit(0), F.size("tokens") - least + 1))).alias("at", "token"))
    left = F.least(F.col("size") - F.col("at"), F.size("held") - F.col("held_at"))
    candidates = probes.join(F.broadcast(templates), "token").where(
        (F.col("size") >= F.col("need")) & (F.col("at") <= F.col("size") - F.col("need")) & (left >= F.col("need")))
    overlap = F.size(F.array_intersect("tokens", "held"))
    return candidates.where(overlap >= F.col("need")).select(
        "_row", "start", "label", "template", (overlap / F.size("held")).alias("containment")).distinct()


def find_licenses(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    percent: int = CONTAINMENT_PERCENT, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches)``, one row per row of ``docs``.

    Words are runs of a-z (A-Z count as such), 0-9 and all that is not ASCII. ``n_base`` counts the places where a
    phrase's words stand one after the other, ``first_word`` and ``last_word`` are the
    least and largest start of them (null without any). ``matches`` lists every block of
    twice the longest template's words, starting at its multiples, that
    contains ``percent`` of a template's distinct words: ``start, label, template, containment``. ``labels`` joins the labels of both, and ``score`` is the best
    containment (1 for a phrase, 0 without a match).

    Null and empty texts have no words and no labels. Repeated rows, and rows
    without id, stay, each with its findings. Other columns are ignored; an empty table gives an
    empty result. Templates are a parameter and short, which bounds what is broadcast; texts are not shuffled.
    """
    sets, step = template_sets(templates, percent)
    names = sorted(set().union(*(s["words"] for s in sets)))
    ids = {w: i for i, w in enumerate(names)}
    other = sorted({w for p in phrases for w in words_of(p.encode())} - set(ids))
    least = min((s["need"] for s in sets), default=1)
    found = _blocks(docs, id_col, text_col, ids | {w: -2 - i for i, w in enumerate(other)}, phrases, step, least)
    staged = written(found.withColumn("_row", F.monotonically_increasing_id()), "license-blocks")
    kind = "array<struct<start:bigint,label:string,template:int,containment:double>>"
    matches = None
    if sets:
        blocks = staged.select("_row", F.explode("blocks").alias("b")).select("_row", "b.start", "b.tokens")
        hits = written(containment_join(blocks, sets, ids), "license-matches")
        matches = hits.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "label", "template", "containment"))).alias("matches"))
    rows = staged.drop("blocks") if matches is None else staged.drop("blocks").join(when_small(matches, 100_000), "_row", "left")
    listed = F.coalesce("matches", F.array().cast(kind)) if matches is not None else F.array().cast(kind)
    rows = rows.withColumn("matches", listed)
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", F.transform("matches", lambda m: m["label"]))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(best).alias("score"), "matches")

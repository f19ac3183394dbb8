"""License scans: an exact set-similarity join of text blocks with license templates; column functions only.

A block is a run of consecutive words, twice as many as the template has (:func:`width`), at every place of a text;
line feeds are separators like any other, and a shorter text is one block. A block meets a template if it has at
least ``CONTAINMENT`` of the template's distinct words. The join finds every template that a block of a document meets,
with filters that lose none:

* words are ordered by their count over the whole corpus, rarest first;
* prefix: a block that meets a template of n words with a need of k has one of its n - k + 1 rarest words, so only
  the surroundings of these words, which hold all blocks around them, are looked at;
* length: surroundings with fewer than k words of all templates hold no such block;
* position: if the prefix word is the i-th of its template and the j-th of all template words around it, no more than
  min(i, j) common words are rarer, and no more than the shorter rest has are as frequent.

What passes is compared block by block. Base phrases are templates of consecutive words: the rarest word of a phrase
gives its candidates, and the words around it are compared in order.

The templates are a bounded list and enter the plan as literals, so the join is done inside each row: a text is cut
into words once, texts without a prefix word are passed over, and nothing is shuffled but the word counts.

Null texts have no words. Every row gets its row, repeated ones and null ids too; documents without a match have zero
counts, nulls and empty label strings. Further columns are ignored. No rows give none.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.common import NOT_WORD, ascii_lower, pieces, whole
from moodlens.llm.decontaminate import SEPARATORS, WORD

#: Share of a template's distinct words that a block must have.
CONTAINMENT = 0.8
#: Words that a block has at least.
SHORTEST = 16
# The base phrases with their labels, and license sentences.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("all rights reserved", "rights-reserved"),
)


def needed(words: int, containment: float = CONTAINMENT) -> int:
    return max(1, math.ceil(containment * words - 1e-9))


def width(words: int) -> int:
    """Words of a block for a template of ``words`` words."""
    return max(2 * words, SHORTEST)


def word_order(docs: DataFrame, words: list[str]) -> list[str]:
    """The template words by their count over all documents, rarest first, ties by the word."""
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(w,) for w in words], "word string"))
    every = docs.select(F.explode(pieces(whole(F.col("text")), SEPARATORS)).alias("w")).select(ascii_lower(F.col("w")).alias("word"))
    counts = dict(every.join(wanted, "word").groupBy("word").agg(F.count("*")).collect())
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _around(words: Column, i: Column, size: int) -> Column:
    """The words of all blocks of ``size`` words that hold the word at ``i``."""
    first = F.greatest(i - (size - 1), F.lit(0))
    return F.slice(words, first + 1, i - first + size)


def _containment(words: Column, places: Column, ranked: list[str], size: int, need: int) -> Column:
    """The most template words that a block of ``size`` words has, 0 if none has ``need``.

    ``ranked`` holds the template's words, rarest first. ``places`` are those of prefix words of any template, with the
    template words of any kind around them in the same order.
    """
    template, n = _strings(ranked), len(ranked)
    prefix = _strings(ranked[: n - need + 1])

    def possible(p: Column) -> Column:
        length = F.size(p["around"]) >= need
        at, other = F.array_position(template, p["word"]) - 1, F.array_position(p["around"], p["word"]) - 1
        rest = 1 + F.least(n - 1 - at, F.size(p["around"]) - 1 - other)
        return F.array_contains(prefix, p["word"]) & length & (F.least(at, other) + rest >= need)

    def best(p: Column) -> Column:
        def blocks(near: Column) -> Column:
            starts = F.sequence(F.lit(0), F.greatest(F.size(near) - size, F.lit(0)))
            each = F.transform(starts, lambda s: F.size(F.array_intersect(template, F.slice(near, s + 1, size))))
            return F.when(F.size(F.array_intersect(template, near)) >= need, F.array_max(each)).otherwise(0)

        return _bound(_around(words, p["i"], size), blocks)

    most = F.array_max(F.transform(F.filter(places, possible), best))
    return F.when(most >= need, most).otherwise(0)


def _phrase_starts(words: Column, places: Column, phrase: list[str], offset: int, label: str) -> Column:
    """Where the words of a phrase stand in order, found from the word at ``offset`` in it, with its label."""
    at = F.filter(places, lambda p: (p["word"] == phrase[offset]) & (p["i"] >= offset))
    same = F.filter(at, lambda p: F.slice(words, p["i"] - offset + 1, len(phrase)) == _strings(phrase))
    return F.transform(same, lambda p: F.struct((p["i"] - offset).cast("long").alias("start"), F.lit(label).alias("label")))


def scan(docs: DataFrame, templates: tuple = TEMPLATES, base: tuple = BASE, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 with a base phrase, else the best containment of a block that meets a template, else 0.
    """
    sets = [(re.findall(WORD, t), label) for t, label in templates]
    phrases = [(p.split(" "), label) for p, label in base]
    order = word_order(docs, sorted({w for t, _ in [*sets, *phrases] for w in t}))
    place = {w: k for k, w in enumerate(order)}
    kinds = []
    for found, label in sets:
        ranked = sorted(set(found), key=place.get)
        kinds.append((ranked, label, width(len(found)), needed(len(ranked), containment)))
    anchored = [(p, label, min(range(len(p)), key=lambda k: (place[p[k]], k))) for p, label in phrases]
    rare = _strings(sorted({w for t, _, _, k in kinds for w in t[: len(t) - k + 1]} | {p[o] for p, _, o in anchored}))

    def judge(words: Column, places: Column) -> Column:
        starts = [_phrase_starts(words, places, p, o, label) for p, label, o in anchored]
        met = [F.struct(F.lit(label).alias("label"), (_containment(words, places, t, size, need) / len(t)).alias("score")) for t, label, size, need in kinds]
        return F.struct(F.concat(*starts).alias("base"), F.filter(F.array(*met), lambda m: m["score"] > 0).alias("met"))

    widest, ordered = max([size for _, _, size, _ in kinds], default=1), _strings(order)

    def cut(words: Column) -> Column:
        def place_of(i: Column) -> Column:
            around = F.array_intersect(ordered, _around(words, i, widest))
            return F.struct(i.alias("i"), F.get(words, i).alias("word"), around.alias("around"))

        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(rare, F.get(words, i)))
        found = F.when(F.arrays_overlap(words, rare), _bound(F.transform(at, place_of), lambda places: judge(words, places)))
        return F.struct(F.size(words).cast("long").alias("n_words"), found.alias("found"))

    words = pieces(ascii_lower(whole(F.col("text"))), NOT_WORD)
    rows = docs.select("doc_id", _bound(words, cut).alias("r")).select("doc_id", "r.n_words", "r.found.base", "r.found.met")
    starts = F.transform("base", lambda x: x["start"])

    def names(labels: Column) -> Column:
        return F.coalesce(F.array_join(F.array_sort(F.array_distinct(labels)), ","), F.lit(""))

    of_base, of_met = (F.transform(c, lambda x: x["label"]) for c in ("base", "met"))
    none = F.lit(0).cast("long")
    best = F.coalesce(F.array_max(F.transform("met", lambda x: x["score"])), F.lit(0.0))
    return rows.select(
        "doc_id", "n_words", F.coalesce(F.size("base").cast("long"), none).alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(of_base).alias("base_labels"), names(F.concat(of_base, of_met)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
    )

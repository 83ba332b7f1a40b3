"""License scan by an exact containment join of text blocks with license templates.

Blocks are the lines of a text, templates are short notices; both are sets of words. With ``wrapped``
a notice may run over lines: the blocks of a template of n words are then the lines and every stretch
of n neighbouring words, wherever the lines are broken. (Whole neighbouring lines would be too wide: on
sf0.1 they make "mit" of an Apache notice below a line with that German word.) A stretch is looked at
only if it begins with a word of the template, as the next one holds no less otherwise. A block
meets a template when it holds at least ``ceil(threshold * |template|)`` of its words. The join
is the prefix-filtered one: template words are ordered by how many documents of the whole corpus
hold them (rarest first), so a block that meets the threshold must hold one of the first
``|template| - needed + 1`` words (prefix filter), must hold ``needed`` known words at all
(length filter), and what follows the first common word on both sides must still suffice
(positional filter). What survives is verified on the full sets, so no block is lost.

The template side is a constant of the job (its words are literals in the plan), which makes this a
map-side join: no row of ``documents`` is shuffled and a hot source or a repeated line costs nothing
extra. Only the frequencies of the template words are aggregated (one row per such word).

Edge cases: a null or empty text has no words, counts 0, null positions, empty labels and score 0;
repeated rows and ties are judged row by row; an empty table gives an empty result; columns of the
input other than the id and the text are not looked at, so their names cannot clash.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, literal_array

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the base rule and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices whose wording the licenses prescribe or recommend.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("copyright", "Copyright (c) All rights reserved"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "Licensed under the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)


@dataclass(frozen=True)
class LicenseScan:
    """``threshold`` is the share of a template's words that a block must hold; ``wrapped``: also stretches of words over lines."""
    threshold: float = 0.8
    wrapped: bool = False
    phrases: tuple = PHRASES
    templates: tuple = TEMPLATES
    text_col: str = "text"
    keep: tuple = field(default=("doc_id",))


def all_words(line: str) -> list[str]:
    """Words of a template (driver side, constants only)."""
    import re
    low = line.translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def words_of(line: str) -> list[str]:
    """Distinct words of a template."""
    return sorted(set(all_words(line)))


def spaced(lowered: Column) -> Column:
    """Words of an already lowered text, one space between them."""
    return F.trim(F.regexp_replace(lowered, SEPARATORS, " "))


def word_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str) -> dict[str, int]:
    """Documents of the whole table that hold each template word (one row per word comes back)."""
    words = F.split(spaced(ascii_lower(F.coalesce(F.col(text_col), F.lit("")))), " ")
    hits = docs.select(F.explode(F.array_intersect(words, literal_array(vocabulary))).alias("w"))
    seen = {r["w"]: r["n"] for r in hits.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: seen.get(w, 0) for w in vocabulary}


def template_hits(blocks: Column, words: list[str], needed: int) -> Column:
    """Largest number of ``words`` (rarest first) found in one block, or 0 when no block has ``needed``."""
    full, prefix = literal_array(words), literal_array(words[:len(words) - needed + 1])

    def admissible(b: Column) -> Column:
        first = F.element_at(F.array_intersect(prefix, b), 1)
        left_here = F.size(b) - F.array_position(b, first).cast("int")
        left_there = F.lit(len(words)) - F.array_position(full, first).cast("int")
        return F.arrays_overlap(b, prefix) & (F.lit(1) + F.least(left_here, left_there) >= F.lit(needed))

    long_enough = F.filter(blocks, lambda b: F.size(b) >= F.lit(needed))
    counts = F.transform(F.filter(long_enough, admissible), lambda b: F.size(F.array_intersect(full, b)))
    return F.coalesce(F.array_max(F.filter(counts, lambda n: n >= F.lit(needed))), F.lit(0))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it and wherever a filter carries it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def wrapped_blocks(t: Column, order: list[str], words: list[str], needed: int, length: int) -> Column:
    """The lines and the stretches of ``length`` words; none where the whole text holds too few of the template's."""
    full = literal_array(words)
    first = F.filter(F.transform(t["words"], lambda w, i: F.when(F.array_contains(full, w), i)), lambda i: i.isNotNull())
    stretch = lambda i: F.array_intersect(literal_array(order), F.slice(t["words"], i + 1, length))
    enough = F.size(F.array_intersect(full, t["words"])) >= F.lit(needed)
    return F.when(enough, F.concat(t["lines"], F.transform(first, stretch))).otherwise(F.array().cast("array<array<string>>"))


def scan(docs: DataFrame, spec: LicenseScan = LicenseScan()) -> DataFrame:
    """Per row: kept columns, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates = [(label, words_of(t), len(all_words(t))) for label, t in spec.templates]
    templates = [(label, w, max(1, ceil(spec.threshold * len(w) - 1e-9)), n) for label, w, n in templates if w]
    vocabulary = sorted({w for _, ws, _, _ in templates for w in ws})
    freq = word_frequencies(docs, vocabulary, spec.text_col)
    order = sorted(vocabulary, key=lambda w: (freq[w], w))
    at = {w: i for i, w in enumerate(order)}
    templates = [(label, sorted(ws, key=at.__getitem__), need, n) for label, ws, need, n in templates]
    anchors = sorted({w for _, ws, need, _ in templates for w in ws[:len(ws) - need + 1]})

    low = ascii_lower(F.coalesce(F.col(spec.text_col), F.lit("")))
    df = docs.select(*spec.keep, low.alias("_low"))
    df = df.withColumn("_s", F.concat(F.lit(" "), spaced(F.col("_low")), F.lit(" ")))
    s = F.col("_s")
    gaps = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    df = df.withColumn("n_words", F.when(s == F.lit("  "), F.lit(0)).otherwise(gaps(s) - 1).cast("long"))

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in spec.phrases:
        mark = F.lit(f" {phrase} ")
        has = F.contains(s, mark)
        n = F.when(has, F.regexp_count(s, F.lit(f" {phrase}(?= )"))).otherwise(F.lit(0))
        first = F.when(has, gaps(F.substring_index(s, f" {phrase} ", 1)))
        last = F.when(has, F.col("n_words") - gaps(F.substring_index(s, f" {phrase} ", -1))
                      - F.lit(len(phrase.split(" "))))
        counts.append(n)
        firsts.append(first.cast("long"))
        lasts.append(last.cast("long"))
        labels.append(F.when(has, F.lit(label)))
    best_of = lambda f, cs: f(*cs) if len(cs) > 1 else cs[0]
    n_base = sum(counts[1:], counts[0]).cast("long") if counts else F.lit(0).cast("long")
    none = F.lit(None).cast("long")

    # lines of the texts that hold a prefix word at all; the others cannot meet any template
    near = F.arrays_overlap(F.split(F.trim(s), " "), literal_array(anchors))
    line_words = lambda l: F.array_intersect(literal_array(order), F.split(spaced(l), " "))
    lines = F.filter(F.transform(F.split(F.col("_low"), "\n"), line_words), lambda b: F.size(b) > 0)
    lines = F.when(near, lines).otherwise(F.array().cast("array<array<string>>"))
    hits = lambda blocks: F.array(*[F.struct(F.lit(label).alias("label"),
                                             (template_hits(blocks(ws, need, n), ws, need) / F.lit(len(ws))).alias("share"))
                                    for label, ws, need, n in templates])
    if spec.wrapped:
        text = F.struct(lines.alias("lines"), F.when(near, F.split(F.trim(s), " ")).alias("words"))
        found = bound(text, lambda t: hits(lambda ws, need, n: wrapped_blocks(t, order, ws, need, n)))
    else:
        found = bound(lines, lambda b: hits(lambda ws, need, n: b))
    df = df.select(*spec.keep, "n_words", n_base.alias("n_base"),
                   (best_of(F.least, firsts) if firsts else none).alias("first_word"),
                   (best_of(F.greatest, lasts) if lasts else none).alias("last_word"),
                   F.array_sort(F.array_distinct(F.array_compact(F.array(*labels) if labels else literal_array([]))))
                   .alias("_base"),
                   found.alias("_hits"))
    met = F.filter(F.col("_hits"), lambda h: h["share"] > 0)
    own = F.transform(met, lambda h: h["label"])
    best = F.coalesce(F.array_max(F.transform(met, lambda h: h["share"])), F.lit(0.0))
    return df.select(*spec.keep, "n_words", "n_base", "first_word", "last_word",
                     F.array_join("_base", ",").alias("base_labels"),
                     F.array_join(F.array_sort(F.array_distinct(F.concat(F.col("_base"), own))), ",").alias("labels"),
                     F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"))

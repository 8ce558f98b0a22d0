"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block is a line, or a window: as many consecutive words of the text, over line
ends too, as the template has.  It matches a template when it holds at least
``threshold`` of the template's distinct words, and those that the template needs
(a name, say, that alone tells a short mention from another).  The join is the usual exact one: words are
ordered by how many documents hold them, rarest first; a block can reach the
overlap only if a word of its own prefix is in the template's prefix (prefix
filter), if it has words enough (length filter), and if the words left after
the first common one suffice (positional filter).  Survivors are counted in
full.  Words that no template has cannot add to an overlap, so blocks keep only
the others.  Only templates are broadcast, ``MAX_TEMPLATE_WORDS`` at most.

Windows that start at a word of the template suffice: any other holds no more
than the one that starts at its first such word.  A text is cut into cells of a
window's length, each word is in its cell and the one before, so that all
windows that start in a cell are counted there and no group outgrows two cells.

Defined results: a null text counts as empty (no words, no labels, score 0);
repeated rows each return; an empty table gives an empty result; other columns
do not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch

#: What separates words after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices by label, of those with several after a slash which: the licences' own texts, and short mentions.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0/short": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-nc/long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-3.0/short": "This work is licensed under the GNU General Public License, version 3",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal "
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mit/short": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at",
}
#: What a block must hold of a template beside the threshold: the words that tell short mentions from those of other licences.
NEEDED = {
    "apache-2.0/short": {"apache"},
    "cc-by-nc": {"cc", "by", "nc"},
    "cc-by-nc/long": {"noncommercial"},
    "gpl-3.0": {"gnu", "general"},
    "gpl-3.0/short": {"gnu", "general", "3"},
    "mit/short": {"mit"},
    "mpl-2.0": {"mozilla"},
}
MAX_TEMPLATE_WORDS = 50_000  # templates are broadcast
THRESHOLD = 0.8


def lowered(text: Column) -> Column:
    """Lower case in which no other letter turns into an ASCII one (the Kelvin sign would)."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u2126")))


def words_of(lower: Column) -> Column:
    return F.array_remove(F.split(lower, GAP), "")


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    return {k: sorted(set(re.split(GAP, t.lower())) - {""}) for k, t in templates.items()}


def label_of(key: str) -> str:
    return key.partition("/")[0]


def least_overlap(n: int, threshold: float) -> int:
    """Smallest count c with c / n >= threshold."""
    return next(c for c in range(n + 1) if c >= threshold * n - 1e-9)


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(i):
        fits = F.element_at(words, i + 1) == parts[0]
        for j, p in enumerate(parts[1:], 2):
            fits = fits & (F.element_at(words, i + j) == p)
        return fits

    last = F.size(words) - len(parts)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def _windows(
    rows: DataFrame, sets: dict[str, list[str]], needs: dict[str, int], lengths: dict[str, int], ranks: dict[str, int], musts: dict[str, list[int]]
) -> DataFrame:
    """(row, block, label, containment): for every cell of a text the best window that starts in it and reaches the overlap."""
    side = [
        (k, len(v), needs[k], lengths[k], musts[k], w, ranks[w], i <= len(v) - needs[k])
        for k, v in sets.items()
        for i, w in enumerate(sorted(v, key=ranks.__getitem__))
    ]
    kind = "label string, total int, need int, length int, must array<int>, word string, rank int, prefix boolean"
    side = rows.sparkSession.createDataFrame(side, kind)
    words = rows.where("spots is not null").select("row", "able", F.explode("spots").alias("s")).select("row", "able", "s.*")
    words = words.join(F.broadcast(side), "word").where(F.array_contains("able", F.col("label")))
    cell = F.floor(F.col("at") / F.col("length"))
    words = words.select("row", "label", "total", "need", "length", "must", F.explode(F.array(cell, cell - 1)).alias("cell"), "at", "line", "rank", "prefix")
    cells = words.groupBy("row", "label", "total", "need", "length", "must", "cell").agg(
        F.max("prefix").alias("prefix"), F.array_sort(F.collect_list(F.struct("at", "line", "rank"))).alias("near")
    )

    def distinct(spots: Column) -> Column:
        return F.size(F.array_distinct(F.transform(spots, lambda x: x["rank"])))

    def told(spots: Column) -> Column:
        return F.size(F.array_except("must", F.transform(spots, lambda x: x["rank"]))) == 0

    cells = cells.where(F.col("prefix") & (distinct(F.col("near")) >= F.col("need")))  # prefix and length filters

    def window(s: Column) -> Column:
        inside = F.filter("near", lambda x: (x["at"] >= s["at"]) & (x["at"] < s["at"] + F.col("length")))
        return F.struct(F.when(told(inside), distinct(inside)).otherwise(0).alias("overlap"), (-s["line"]).alias("up"))

    starts = F.filter("near", lambda s: s["at"] < (F.col("cell") + 1) * F.col("length"))
    best = cells.withColumn("best", F.array_max(F.transform(starts, window))).where(F.col("best.overlap") >= F.col("need"))
    return best.select("row", (-F.col("best.up")).alias("block"), "label", (F.col("best.overlap") / F.col("total")).alias("containment"))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, needed: dict[str, set[str]] | None = None) -> DataFrame:
    """For every row: doc_id, n_words, places (phrase label, start), base_labels, labels, score, matches (block, label, containment).

    ``templates`` by label, or label/name where a label has several; ``needed`` words by the same keys.  ``block`` is the line, for a window the one it starts in; ``containment`` the best of the blocks there.
    """
    scratch = Scratch(docs.sparkSession)
    needed = NEEDED if templates is None else needed or {}
    templates = TEMPLATES if templates is None else templates
    sets = template_words(templates)
    if sum(map(len, sets.values())) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates have more than {MAX_TEMPLATE_WORDS} words")
    lengths = {k: len([w for w in re.split(GAP, t.lower()) if w]) for k, t in templates.items()}
    needs = {k: least_overlap(len(v), threshold) for k, v in sets.items()}
    phrase_words = {w for p in PHRASES for w in p.split(" ")}
    vocabulary = sorted(set().union(phrase_words, *sets.values()))

    def among(words: Column) -> Column:
        return F.array_intersect(words, F.array(*map(F.lit, vocabulary)))

    rows = docs.select("doc_id", lowered(F.col("text")).alias("lower")).select("doc_id", "lower", words_of(F.col("lower")).alias("words"))
    rows = rows.select("doc_id", "lower", "words", among(F.col("words")).alias("held"))

    def places_of(phrase: str, label: str) -> Column:
        here = F.transform(_places(F.col("words"), phrase), lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))
        possible = F.size(F.array_except(F.array(*map(F.lit, phrase.split(" "))), F.col("held"))) == 0
        return F.when(possible, here).otherwise(F.array().cast("array<struct<start:int,label:string>>"))

    places = [places_of(p, label) for p, label in PHRASES.items()]

    def can(k: str) -> Column:
        enough = F.size(F.array_intersect("held", F.array(*map(F.lit, sets[k])))) >= needs[k]
        return enough & F.forall(F.array(*map(F.lit, needed[k])), lambda w: F.array_contains("held", w)) if needed.get(k) else enough

    able = [F.when(can(k), k) for k in sets]
    able = F.array_compact(F.array(*able).cast("array<string>"))
    possible = F.size(able) > 0
    by_line = F.transform(F.split("lower", "\n", -1), lambda line, i: F.transform(words_of(line), lambda w: F.struct(i.alias("line"), w.alias("word"))))
    at = F.transform(F.flatten(by_line), lambda x, i: F.struct(i.alias("at"), x["line"].alias("line"), x["word"].alias("word")))
    spots = F.filter(at, lambda x: x["word"].isin(vocabulary))
    blocks = F.transform(F.split("lower", "\n", -1), lambda line: among(words_of(line)))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),  # kept with the table; it joins the matches back
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.array_sort(F.concat(*places)).alias("places"),
        "held",
        F.when(possible, blocks).alias("blocks"),
        F.when(possible, spots).alias("spots"),
        able.alias("able"),
    )
    rows = scratch.save(rows, "rows")

    counts = rows.select(F.explode("held").alias("word")).groupBy("word").count()
    held = {r["word"]: r["count"] for r in counts.collect()}  # at most the templates' words
    ranks = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (held.get(w, 0), w)))}
    ranked = F.create_map(*[F.lit(x) for w, i in ranks.items() for x in (w, i)])
    musts = {k: sorted(ranks[w] for w in needed.get(k, ())) for k in sets}
    prefixes = [
        (k, len(v), needs[k], musts[k], ranks[w], i, sorted(ranks[x] for x in v))
        for k, v in sets.items()
        for i, w in enumerate(sorted(v, key=ranks.__getitem__)[: len(v) - needs[k] + 1])
    ]
    side = docs.sparkSession.createDataFrame(prefixes, "label string, total int, need int, must array<int>, word int, t_at int, t_words array<int>")
    # "places" as a set of integers in global order; each word of a block joins with its position
    lines = rows.where("blocks is not null").select("row", F.posexplode("blocks").alias("block", "words"))
    lines = lines.where(F.size("words") > 0).select("row", "block", F.array_sort(F.transform("words", lambda w: F.element_at(ranked, w))).alias("b_words"))
    words = lines.select("row", "block", "b_words", F.posexplode("b_words").alias("b_at", "word"))
    size = F.size("b_words")
    left = F.lit(1) + F.least(size - F.col("b_at") - 1, F.col("total") - F.col("t_at") - 1)
    pairs = words.join(F.broadcast(side), "word").where((size >= F.col("need")) & (F.col("b_at") <= size - F.col("need")) & (left >= F.col("need")))
    overlap = F.size(F.array_intersect("b_words", "t_words"))
    pairs = pairs.where((overlap >= F.col("need")) & (F.size(F.array_except("must", "b_words")) == 0)).select("row", "block", "label", (overlap / F.col("total")).alias("containment"))
    pairs = pairs.unionByName(_windows(rows, sets, needs, lengths, ranks, musts)).withColumn("label", F.split_part("label", F.lit("/"), F.lit(1)))
    pairs = pairs.groupBy("row", "block", "label").agg(F.max("containment").alias("containment"))
    matches = pairs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("block", "label", "containment"))).alias("matches"))

    out = rows.drop("blocks", "spots", "able", "held").join(matches, "row", "left")
    base = F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"])))
    found = F.coalesce("matches", F.array().cast("array<struct<block:int,label:string,containment:double>>"))
    out = out.select("doc_id", "n_words", "places", base.alias("base_labels"), found.alias("matches"))
    best = F.aggregate("matches", F.lit(0.0), lambda a, m: F.greatest(a, m["containment"]))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("matches", lambda m: m["label"]))))
    return out.withColumn("labels", labels).withColumn("score", F.when(F.size("places") > 0, 1.0).otherwise(best))

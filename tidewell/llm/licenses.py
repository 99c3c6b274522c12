"""Operator 8: license scan by an exact set-similarity join (DataFrame functions only).

Base labels come from phrases whose words stand consecutively. Further labels
come from notice templates. Text blocks are runs of consecutive words, whatever
lines they stand on, because notices are wrapped and also stand inside long
lines: a run has as many words as the template plus as many as it may lack. A
run has the template's label if it holds ``THRESHOLD`` of the template's
distinct words (all of them where the template has fewer than ``WHOLE``), every
word that tells the licence from its relatives, and none that marks a relative
(a notice with "lesser" or "affero" is no plain GPL notice).

The join finds every such pair. Template words are ordered by the number of
documents that hold them, rarest first, so a block that shares ``need`` of a
template's n words must hold one of its first n - need + 1 (prefix filter), must
itself have ``need`` distinct words (length filter), and, when its first shared
word is the template's j-th, must still be able to reach ``need`` with the
words from there on in both orders (positional filter). A pair is taken at its
first shared prefix word only, then its overlap is counted exactly. Runs go
through the join in chunks: chunks of twice the longest run, each half
overlapping the next, hold every run whole, so a chunk meets what its runs meet;
of the chunks that pass, the best run is counted. The templates are a bounded
parameter; they are the broadcast side.

Matches are grouped by text (128 bits of hash), because they depend on the text
alone; so repeated rows and null ids need no key of their own.

Results for odd rows: null text is empty, without words, places or labels and
with score 0; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import attach, materialise

#: Base phrases and their labels, and what separates words once A-Z are lower case: fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

THRESHOLD = 0.8
#: Templates of fewer distinct words must be there whole.
WHOLE = 10


class Template(NamedTuple):
    """A notice, the words a run must hold whatever its share, and those it must not hold."""

    label: str
    text: str
    required: str = ""
    barred: str = ""


#: Words that make another licence of the GPL and of CC BY.
GNU_KIN = "lesser library affero"
CC_KIN = "sharealike noncommercial noderivatives noderivs nc sa nd"
#: Notices of the method's own labels, as published by their stewards.
TEMPLATES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                           "License at", "file compliance obtain"),
    Template("apache-2.0", "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                           "CONDITIONS OF ANY KIND, either express or implied", "basis warranties conditions"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu version 3", GNU_KIN),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                    "by the Free Software Foundation", "gnu general public license", GNU_KIN),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             "gnu lesser"),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
             "gnu affero"),
    Template("mit", "Released under the MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files, to deal in the Software without restriction",
             "permission granted charge software"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                    "that the following conditions are met", "redistribution source binary"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla 2"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                    "hereby granted", "permission granted fee"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             "creative commons attribution sharealike", "noncommercial nc"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             "creative commons attribution", CC_KIN),
    Template("cc0", "has waived all copyright and related or neighboring rights to this work under CC0", "waived cc0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             "unencumbered public domain"),
]


def words_of(text: str) -> list[str]:
    low = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(BREAK, low) if w]


def _words(text: str) -> str:
    """SQL: the words of a text expression, A-Z lowered."""
    return f"filter(split(lower({text}), r'{BREAK}'), x -> x <> '')"


def _key(text: str) -> list:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), F.col(text)).alias("k2")]


def _quoted(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def template_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Documents that hold each word of the templates: at most len(vocabulary) rows reach the driver."""
    text = f"coalesce({text_col}, '')"
    held = docs.select(F.expr(f"array_intersect({_words(text)}, {_quoted(vocabulary)})").alias("w"))
    rows = held.select(F.explode("w").alias("w")).groupBy("w").count().collect()
    return {w: 0 for w in vocabulary} | {r["w"]: r["count"] for r in rows}


def prefixes(templates: list[Template], frequency: dict[str, int], threshold: float = THRESHOLD) -> list[dict]:
    """Per template: its words rarest first, how many a run needs, the run's words, and its prefix."""
    out = []
    for k, t in enumerate(templates):
        ws = sorted(set(words_of(t.text)), key=lambda w: (frequency[w], w))
        need = len(ws) if len(ws) < WHOLE else math.ceil(threshold * len(ws) - 1e-9)
        out.append({"template": k, "label": t.label, "words": ws, "span": len(words_of(t.text)) + len(ws) - need,
                    "need": need, "required": t.required.split(), "barred": t.barred.split(),
                    "prefix": ws[:len(ws) - need + 1]})
    return out


def similar_runs(chunks: DataFrame, plan: list[dict]) -> DataFrame:
    """Chunks (k1, k2, run: words in order) x templates with enough containment: (k1, k2, template, label, share).

    ``share`` is that of the best of the chunk's runs of the template's span that hold its required words
    and none of its barred ones.
    """
    spark = chunks.sparkSession
    rows = [(t["prefix"][j], t["template"], t["label"], t["words"], t["span"], t["need"], j, t["prefix"][:j],
             t["required"], t["barred"]) for t in plan for j in range(len(t["prefix"]))]
    side = spark.createDataFrame(rows, "word string, template int, label string, twords array<string>, span int, need int, "
                                       "place int, before array<string>, required array<string>, barred array<string>")
    firsts = _quoted(sorted({r[0] for r in rows}))
    shared = chunks.withColumn("words", F.array_distinct("run")).withColumn(
        "hit", F.expr(f"array_intersect(words, {firsts})")).where("size(hit) > 0")
    met = shared.select("k1", "k2", "words", "run", F.explode("hit").alias("word")).join(F.broadcast(side), "word")
    met = met.where("size(words) >= need")  # length
    met = met.where("size(twords) - place >= need")  # position: words left from here on
    met = met.where("not arrays_overlap(words, before)")  # first shared prefix word
    met = met.where("size(array_except(required, words)) = 0 and size(array_intersect(words, twords)) >= need")
    runs = "transform(sequence(1, greatest(1, size(run) - span + 1)), i -> slice(run, i, span))"
    fit = f"filter({runs}, r -> size(array_except(required, r)) = 0 and not arrays_overlap(r, barred))"
    met = met.withColumn("overlap", F.expr(
        f"coalesce(array_max(transform({fit}, r -> size(array_intersect(r, twords)))), 0)")).where("overlap >= need")
    return met.select("k1", "k2", "template", "label", (F.col("overlap") / F.size("twords")).alias("share"))


def _places(phrase: str) -> str:
    ws = phrase.split()
    cond = " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(ws))
    return (f"if(contains(joined, '{phrase}') and size(w) >= {len(ws)}, "
            f"filter(sequence(0, size(w) - {len(ws)}), i -> {cond}), cast(array() as array<int>))")


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is 1 where a base phrase stands, else the largest containment found, else 0.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    vocabulary = sorted({w for t in templates for w in words_of(t.text)})
    plan = prefixes(templates, template_frequencies(texts, vocabulary), threshold)
    least = min(t["need"] for t in plan)
    firsts = _quoted(sorted({w for t in plan for w in t["prefix"]}))
    base = texts.select("doc_id", "text", *_key("text")).withColumn("w", F.expr(_words("text")))
    base = base.withColumn("joined", F.array_join("w", " "))
    for k, phrase in enumerate(PHRASES):
        base = base.withColumn(f"p{k}", F.expr(_places(phrase)))
    every = F.flatten(F.array(*[F.col(f"p{k}") for k in range(len(PHRASES))]))
    base = base.withColumn("places", every)
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label))
                                       for k, label in enumerate(PHRASES.values())]))
    # Only texts with a rare template word are cut into chunks; no chunk but the first has fewer than span + 1 words.
    span = max(t["span"] for t in plan)
    chunks = F.expr(f"if(arrays_overlap(w, {firsts}), filter(transform("
                    f"sequence(0, greatest(0, (size(w) - 1) div {span} - 1)), "
                    f"k -> slice(w, int(k * {span}) + 1, {2 * span})), "
                    f"b -> size(array_distinct(b)) >= {least} and arrays_overlap(b, {firsts})), null)")
    marked = base.select("doc_id", "k1", "k2", F.size("w").cast("long").alias("n_words"),
                         F.size("places").cast("long").alias("n_base"),
                         F.array_min("places").cast("long").alias("first_word"),
                         F.array_max("places").cast("long").alias("last_word"),
                         F.array_sort(F.array_distinct(labels)).alias("base"), chunks.alias("chunks"))
    marked = materialise(marked, "license-marks")
    runs = marked.where("size(chunks) > 0").select("k1", "k2", F.explode("chunks").alias("run"))
    found = similar_runs(runs, plan).groupBy("k1", "k2").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share"))
    met = attach(marked.drop("chunks"), materialise(found, "license-found"), ["k1", "k2"])
    both = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    return met.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base", ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
                      F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))

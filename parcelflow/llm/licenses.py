"""License scan: exact phrases, and templates found by an exact set-similarity join.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. *Phrases* are found where their words stand
consecutively. *Templates* are sentences of public license notices; a part of a text matches a template when it holds at least
``percent`` of the template's distinct words. That part is a line or, with ``windows``, a run of consecutive words that many times
as long as the template, anywhere in the text, so a notice wrapped over lines is found and words scattered over a long line are not.

Blocks are the lines, or runs of twice the longest window that overlap by half, so every window lies within one. The join of
blocks and templates finds all pairs of at least that overlap:

* one global order, by how many documents of the corpus hold a word, rare words first;
* prefix filter: a match shares a word of the template's first ``size - needed + 1`` words, so only documents and
  blocks with a word of that kind are taken apart at all, and meet the templates by it in a hash join;
* length filter: the block has at least ``needed`` template words;
* positional filter: from the places of the shared prefix word on, enough words must be left in both;
* a candidate is verified once, from its first shared word: on the whole set of a line, on every window of a run that
  starts at a word of the template, as any other holds no more.

Words that are in no template cannot be in an overlap, so blocks are reduced to template words first. The templates are a
parameter of fixed size: rows of a broadcast table, and two word lists in the plan. DataFrame expressions only.

Defined results: null text is empty; a text without words has n_words 0, no place, no label and score 0; repeated rows
are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import let, whole_text

# fixed values: phrases and labels of the base scan
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: sentences of public license notices and the labels they give
TEMPLATES = {
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
    "compliance with the License.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "mit-notice": "Released under the MIT License.",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files",
    "bsd-header": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced(text: Column) -> Column:
    """The words of a text, each with one space before and after."""
    return F.regexp_replace(F.concat(F.lit(" "), F.translate(text, _UPPER, _LOWER), F.lit(" ")), _NOT_WORD, " ")


def _words(spaced_text: Column) -> Column:
    return F.filter(F.split(spaced_text, " "), lambda w: w != "")


def n_words(spaced_text: Column) -> Column:
    return F.length(spaced_text) - F.length(F.replace(spaced_text, F.lit(" "), F.lit(""))) - 1


def _template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    import re

    found = {}
    for label, text in templates.items():
        lower = text.translate(str.maketrans(_UPPER, _LOWER))
        found[label] = [w for w in re.split(_NOT_WORD, lower) if w]
    return found


def _strings(words: list[str]) -> Column:
    """An array literal; words hold no space."""
    return F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")


def _most_in_window(block: Column, members: Column, length: Column) -> Column:
    """The most distinct members that a window of ``length`` words of the block holds; windows start at a member."""
    numbered = F.transform(block, lambda w, i: F.struct(i.alias("at"), w.alias("word")))

    def most(own: Column) -> Column:
        def held(hit: Column, i: Column) -> Column:
            window = F.filter(F.slice(own, i + 1, length), lambda p: p["at"] < hit["at"] + length)
            return F.size(F.array_distinct(F.transform(window, lambda p: p["word"])))

        return F.array_max(F.transform(own, held))

    return let(F.filter(numbered, lambda p: F.array_contains(members, p["word"])), most)


def _matches(docs: DataFrame, templates: dict[str, str], percent: int, windows: int) -> DataFrame:
    """(doc_id, text_hash, label, score) of every document with a line, or window of words, that meets a template."""
    words = {label: own for label, own in _template_words(templates).items() if own}
    vocabulary = sorted({w for own in words.values() for w in own})
    # the global order: document counts of the template words, over the whole corpus
    held = docs.select(F.explode(F.array_intersect(F.split("spaced", " "), _strings(vocabulary))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    place = {w: i for i, w in enumerate(ordered)}
    rows = []
    for label, own in words.items():
        members = sorted(set(own), key=place.get)
        need = -(-len(members) * percent // 100)
        prefix = members[: len(members) - need + 1]
        rows += [(w, label, members, need, windows * len(own), i) for i, w in enumerate(prefix)]
    prefixes = docs.sparkSession.createDataFrame(
        rows, "word string, label string, members array<string>, need int, length int, template_at int"
    )
    prefix_words = _strings(sorted({r[0] for r in rows}))
    # only documents, then blocks, that hold a prefix word are taken apart
    relevant = docs.filter(F.arrays_overlap(F.split("spaced", " "), prefix_words))
    if windows:
        step = max((windows * len(own) for own in words.values()), default=1)

        def pieces(w: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(step)), lambda at: F.slice(w, at + 1, 2 * step))

        blocks = relevant.select("doc_id", "text_hash", F.explode(let(_words(F.col("spaced")), pieces)).alias("block"))
    else:
        lines = relevant.select("doc_id", "text_hash", F.explode(F.split("text", r"[\r\n]+")).alias("line"))
        blocks = lines.select("doc_id", "text_hash", _words(spaced(F.col("line"))).alias("block"))
    blocks = blocks.filter(F.arrays_overlap("block", prefix_words))
    # template words of the block in the global order
    blocks = blocks.withColumn("block_words", F.array_intersect(_strings(ordered), "block"))
    shared = blocks.select("*", F.posexplode("block_words").alias("block_at", "word"))
    left = F.least(F.size("members") - F.col("template_at"), F.size("block_words") - F.col("block_at"))
    candidates = shared.join(F.broadcast(prefixes), "word").filter(
        (F.size("block_words") >= F.col("need")) & (left >= F.col("need"))
    )
    # a pair that shares several prefix words is verified from the first of them
    common = F.array_intersect("members", "block_words")
    candidates = candidates.withColumn("common", common).filter(F.col("common")[0] == F.col("word"))
    candidates = candidates.filter(F.size("common") >= F.col("need"))
    if windows:
        most = _most_in_window(F.col("block"), F.col("members"), F.col("length"))
    else:
        most = F.size("common")
    verified = candidates.select("doc_id", "text_hash", "label", "need", most.alias("most"), F.size("members").alias("size"))
    return (
        verified.filter("most >= need")
        .groupBy("doc_id", "text_hash", "label")
        .agg(F.max(F.col("most") / F.col("size")).alias("score"))
    )


def _places(words: Column, phrases: dict[str, str]) -> Column:
    """array<struct<at, label>> of all places of all phrases."""

    def of(w: Column, phrase: str, label: str) -> Column:
        parts = phrase.split()

        def stands(i: Column) -> Column:
            return reduce(and_, [F.get(w, i + d).eqNullSafe(F.lit(part)) for d, part in enumerate(parts)])

        here = F.filter(F.sequence(F.lit(0), F.size(w) - 1), stands)
        return F.transform(here, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    return let(words, lambda w: F.concat(*[of(w, phrase, label) for phrase, label in phrases.items()]))


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    percent: int = 90,
    windows: int = 0,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row per document.

    ``score`` is 1 where a phrase stands, else the largest share of a template that a part of the text holds, from ``percent`` on,
    else 0. Parts are lines, or with ``windows`` runs of that many times a template's words.
    """
    text = whole_text()
    prepared = docs.select(
        "doc_id", text.alias("text"), spaced(text).alias("spaced"), F.xxhash64(text).alias("text_hash")
    )
    matched = (
        _matches(prepared, templates, percent, windows)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("label").alias("found"), F.max("score").alias("found_score"))
    )
    any_phrase = F.lit(False)
    for phrase in phrases:
        any_phrase = any_phrase | F.contains("spaced", F.lit(f" {phrase} "))
    none = F.slice(F.array(F.struct(F.lit(0).alias("at"), F.lit("").alias("label"))), 1, 0)
    places = F.when(any_phrase, _places(_words(F.col("spaced")), phrases)).otherwise(none)
    scanned = prepared.select("doc_id", "text_hash", n_words(F.col("spaced")).alias("n_words"), places.alias("places"))
    rows = scanned.join(matched.withColumnRenamed("doc_id", "id").withColumnRenamed("text_hash", "hash"),
                        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    found = F.coalesce("found", F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["at"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("found_score", F.lit(0.0))).alias("score"),
    )

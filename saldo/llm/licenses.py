"""License scans by an exact set-similarity join, in DataFrame and SQL expressions alone.

Templates are notices as sets of words. A text is read in blocks of twice a template's words, a new one after every
so many words, and a block matches if it holds at least ``THRESHOLD`` of the template's set. The words of the
templates are ordered by how many documents have them, the rarest first, counted over all documents; other words
cannot match and are left out of the sets. With ``least`` words in common needed, a block and a template share a word
among the first ``size - least + 1`` of either (prefix), a block has ``least`` words (length), and the words after the
first that both have suffice (position). What is left is compared whole, so every block that meets the threshold is
found. Only documents with a word of some template's prefix come to have blocks.

Beside that, phrases are found where their words stand one after the other.

Defined results: a null text is empty; a text without words has no blocks. Labels are distinct, sorted and joined by
commas, the empty text where there are none; the score is the largest share of a template that a matching block
holds, 1 where a phrase stands, and 0 where nothing is found. Rows that share an id are told apart.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import written

#: Share of a template's words that a block holds at least.
THRESHOLD = Fraction(9, 10)
#: Rows of documents with a match up to which they are sent to every task.
BROADCAST_ROWS = 1 << 16

# Phrases whose words stand one after the other, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices of well-known licenses, with the label of their family.
TEMPLATES = [
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("You may not use this file except in compliance with the License. You may obtain a copy of the License", "apache-2"),
    ("Licensed under the GNU General Public License", "gpl"),
    ("You can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Licensed under a Creative Commons Attribution-NonCommercial International License", "cc-by-nc"),
    ("Licensed under a Creative Commons Attribution-ShareAlike International License", "cc-by-sa"),
]

#: The one letter beyond ASCII whose lower case is in ASCII, besides the letters A to Z.
_KELVIN = "\u212a"
#: What is no part of a word, in lower-case text.
_BETWEEN = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


@dataclass(frozen=True)
class Template:
    """A notice: its label, the number of its words, its distinct words by rank, and how many of them are needed."""

    label: str
    length: int
    tokens: tuple[int, ...]
    least: int

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.tokens[: len(self.tokens) - self.least + 1]


def _literals(words: Sequence[str]) -> str:
    return f"array({', '.join(repr(w) for w in words)})"


def _numbers(numbers: Sequence[int]) -> str:
    return f"array({', '.join(map(str, numbers))})"


def normalised(docs: DataFrame, *columns: str) -> DataFrame:
    """The column ``body``: the words of the text in lower case, one space between them.

    Of all letters beyond ASCII only the Kelvin sign has an ASCII letter as its lower case, so it is replaced first.
    """
    lower = f"lower(replace(coalesce(text, ''), '{_KELVIN}', 'ß'))"
    return docs.selectExpr(*columns, rf"trim(regexp_replace({lower}, '{_BETWEEN}', ' ')) AS body")


def word_order(docs: DataFrame, words: Sequence[str]) -> list[str]:
    """The words by the number of documents that have them, then by name; as many rows as words come to the driver."""
    found = normalised(docs).selectExpr(f"explode(array_intersect(split(body, ' '), {_literals(words)})) AS word")
    counts = {r.word: r["count"] for r in found.groupBy("word").count().collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def indexed(notices: Sequence[tuple[str, str]], order: Sequence[str], threshold: Fraction) -> list[Template]:
    rank = {w: k for k, w in enumerate(order)}
    templates = []
    for text, label in notices:
        words = words_of(text)
        tokens = tuple(sorted({rank[w] for w in words}))
        templates.append(Template(label, len(words), tokens, -(-threshold * len(tokens) // 1)))
    return templates


def _phrase_places(phrase: str) -> tuple[str, str, str]:
    """SQL over ``padded``: the number of places of a phrase, and its first and last place."""
    parts = f"split(padded, '(?<= )(?={phrase} )')"
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    there = f"contains(padded, ' {phrase} ')"
    return (
        f"CASE WHEN {there} THEN size({parts}) - 1 ELSE 0 END",
        f"CASE WHEN {there} THEN {spaces.format(f'get({parts}, 0)')} - 1 END",
        f"CASE WHEN {there} THEN n_words - ({spaces.format(f'element_at({parts}, -1)')}) END",
    )


def _blocks(number: int, template: Template) -> str:
    """SQL over ``ranks`` and ``places``: the blocks that share a prefix word with a template, as sets in rank order."""
    step = template.length
    near = f"filter(places, x -> array_contains({_numbers(template.prefix)}, x.rank))"
    blocks = f"array_distinct(flatten(transform({near}, x -> array(x.place DIV {step}, x.place DIV {step} - 1))))"
    within = f"slice(ranks, CAST(b * {step} + 1 AS INT), {2 * step})"
    tokens = f"array_sort(array_distinct(filter({within}, r -> r >= 0)))"
    return f"transform(filter({blocks}, b -> b >= 0), b -> named_struct('template', {number}, 'block', {tokens}))"


def measured(docs: DataFrame, templates: Sequence[Template], order: Sequence[str], phrases: Mapping[str, str]) -> DataFrame:
    """Every document's words, phrases and candidate blocks."""
    places = [_phrase_places(p) for p in phrases]
    counts, firsts, lasts = ([p[k] for p in places] for k in range(3))
    labels = ", ".join(f"CASE WHEN contains(padded, ' {p} ') THEN '{label}' END" for p, label in phrases.items())
    first_words = sorted({order[r] for t in templates for r in t.prefix})
    some = f"padded RLIKE ' (?:{'|'.join(first_words)}) '"
    prefix = _numbers(sorted({r for t in templates for r in t.prefix}))
    ranks = f"transform(split(body, ' '), w -> CAST(array_position({_literals(order)}, w) - 1 AS INT))"
    with_place = "transform(ranks, (r, i) -> named_struct('rank', r, 'place', i))"
    return (
        normalised(docs, "doc_id")
        .selectExpr("doc_id", "body", "concat(' ', body, ' ') AS padded")
        .selectExpr(
            "*",
            "CASE WHEN body = '' THEN 0L ELSE CAST(length(body) - length(replace(body, ' ', '')) + 1 AS LONG) END AS n_words",
            f"CASE WHEN {some} THEN {ranks} ELSE CAST(array() AS ARRAY<INT>) END AS ranks",
        )
        .selectExpr("*", f"filter({with_place}, x -> array_contains({prefix}, x.rank)) AS places")
        .selectExpr(
            "monotonically_increasing_id() AS row",
            "doc_id",
            "n_words",
            f"CAST({' + '.join(counts)} AS LONG) AS n_base",
            f"CAST(least({', '.join(firsts)}, NULL) AS LONG) AS first_word",
            f"CAST(greatest({', '.join(lasts)}, NULL) AS LONG) AS last_word",
            f"array_distinct(filter(array({labels}), x -> x IS NOT NULL)) AS phrase_labels",
            f"concat({', '.join(_blocks(k, t) for k, t in enumerate(templates))}) AS blocks",
        )
    )


def matches(rows: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Blocks joined with the templates that they hold enough of: (row, label, share)."""
    listed = ", ".join(
        f"struct({k} AS template, '{t.label}' AS label, {_numbers(t.tokens)} AS tokens, {t.least} AS least)"
        for k, t in enumerate(templates)
    )
    table = rows.sparkSession.range(1).selectExpr(f"inline(array({listed}))")
    shared = "array_intersect(slice(tokens, 1, size(tokens) - least + 1), slice(block, 1, greatest(size(block) - least + 1, 0)))"
    # all that both have comes from the first word that both have on
    rest = "1 + least(size(tokens) - array_position(tokens, first), size(block) - array_position(block, first))"
    return (
        rows.selectExpr("row", "inline(blocks)")
        .join(F.broadcast(table), "template")
        .where("size(block) >= least")
        .selectExpr("*", f"get({shared}, 0) AS first")
        .where(f"first IS NOT NULL AND {rest} >= least")
        .selectExpr("row", "label", "least", "size(tokens) AS size", "size(array_intersect(block, tokens)) AS common")
        .where("common >= least")
        .selectExpr("row", "label", "common / size AS share")
    )


def scanned(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """The phrases and the license labels of every document."""
    vocabulary = sorted({w for text, _ in notices for w in words_of(text)})
    order = word_order(docs, vocabulary)
    templates = indexed(notices, order, threshold)
    rows = written(measured(docs, templates, order, phrases), "rows")
    found = matches(rows, templates).groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("share"))
    found = written(found, "found")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    own = "coalesce(own, CAST(array() AS ARRAY<STRING>))"
    return rows.drop("blocks").join(found, "row", "left").selectExpr(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "array_join(array_sort(phrase_labels), ',') AS base_labels",
        f"array_join(array_sort(array_union(phrase_labels, {own})), ',') AS labels",
        "CASE WHEN n_base > 0 THEN 1D ELSE coalesce(share, 0D) END AS score",
    )

"""Licence scans with a positional index of rare licence words.

Of every template's mandatory phrase the words that are rarest in the corpus (highest IDF) are posted with their places
in the template. A text's licence words are looked up in this small index, the rarest first: each hit says where the whole
template would start, and a start stays only if every posted word of the template points at it, too. As the mandatory
phrase must stand whole, no place is missed. What is left of these intersections is verified: the phrase word by word, and
the template's other words at their relative places.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The phrases whose places are counted, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Templates of the method: words, label, phrase that must stand whole.
TEMPLATES = (
    ("licensed under the gnu general public license version 3", "gpl", "gnu general public license"),
    ("gnu lesser general public license", "lgpl", "gnu lesser general public license"),
    ("gnu affero general public license", "agpl", "gnu affero general public license"),
    ("licensed under the apache license version 2 0", "apache", "apache license"),
    ("released under the mit license", "mit", "mit license"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "mit", "granted free of charge to any person",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa"),
    ("creative commons attribution 4 0 international", "cc-by", "creative commons attribution"),
    ("mozilla public license version 2 0", "mpl", "mozilla public license"),
    ("eclipse public license version 2 0", "epl", "eclipse public license"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted", "bsd",
        "redistribution and use in source and binary forms",
    ),
    ("bsd 3 clause license", "bsd", "bsd 3 clause license"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "free and unencumbered software"),
)
#: Whole headers and grants, found where most of their words stand in place.
TEMPLATES += (
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at", "apache", "you may not use this file except in compliance with the license",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version 3 of the license or at your option any later version", "gpl",
        "under the terms of the gnu general public license as published by the free software foundation",
    ),
    (
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software", "mit", "to deal in the software without restriction",
    ),
)
#: Words of a mandatory phrase that are posted, the rarest.
POSTED = 3
#: Share of a template's IDF that must stand in place.
IN_PLACE = 0.7
#: A start is a number: its template times this, and its place, counted from a few words before the text.
_STARTS, _BEFORE = 1 << 40, 1 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    words: list[str]
    label: str
    must: list[int]
    base: bool


def _templates(phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str, str]]) -> list[Template]:
    made = [Template(p.split(), label, list(range(len(p.split()))), True) for p, label in phrases]
    for text, label, phrase in templates:
        words, key = text.split(), phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        made.append(Template(words, label, list(range(at, at + len(key))), False))
    return made


def words_of(text: Column) -> Column:
    """Words of the text in A-Z lower case; null or no words: an empty array."""
    # Of all characters beyond ASCII only the Kelvin sign would become an ASCII letter of its own.
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    parts = F.split(F.regexp_replace(low, "^" + SEPARATORS, ""), SEPARATORS)
    last = F.element_at(parts, -1) == ""
    return F.when(last, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def inverse_frequencies(words: DataFrame, known: Sequence[str]) -> dict[str, float]:
    """IDF of each known word over all rows of ``words.words``: as many numbers as there are known words."""
    listed = F.array(*map(F.lit, known))
    seen = words.select(F.explode(F.array_append(F.array_intersect("words", listed), F.lit(""))).alias("word"))
    counts = {r[0]: r[1] for r in seen.groupBy("word").count().collect()}
    return {w: math.log((1 + counts.get("", 0)) / (1 + counts.get(w, 0))) + 1 for w in known}


def _literal(values, item) -> Column:
    return F.array(*[item(v) for v in values])


def scan(
    docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str, str]] = TEMPLATES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and places of every row.

    ``n_base`` counts all places of ``phrases``, ``first_word`` and ``last_word`` are the smallest and largest start
    (words from 0; null without a place). ``labels`` adds those of ``templates`` found: mandatory phrase whole and at least
    ``IN_PLACE`` of the template's IDF in place. ``score`` is the largest such share, ``places`` lists (label, start,
    share, base). Everything about a text happens in its row: nothing is joined or shuffled, so null ids and repeated
    rows keep their place; null and empty texts have no words; other columns are not read; an empty table gives
    no rows.
    """
    made = _templates(phrases, templates)
    known = sorted({w for t in made for w in t.words})
    split = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    idf = inverse_frequencies(split, known)

    postings: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(POSTED)]
    for k, t in enumerate(made):
        rarest = sorted(t.must, key=lambda i: (-idf[t.words[i]], i))
        for level, rel in enumerate(rarest[:POSTED]):
            postings[level].setdefault(t.words[rel], []).append((k, rel))
    posted = sorted({w for level in postings for w in level})
    none = F.array().cast("array<bigint>")

    def index(level: dict[str, list[tuple[int, int]]]) -> Column:
        """Posted word to its templates and places, such that adding a place in a text numbers the start; empty for words of other levels."""
        number = lambda p: F.lit(p[0] * _STARTS + _BEFORE - p[1]).cast("bigint")
        return F.create_map(*[c for w in posted for c in (F.lit(w), _literal(level[w], number) if w in level else none)])

    table = _literal(
        made,
        lambda t: F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _literal(t.words, F.lit).alias("words"),
            _literal([idf[w] / sum(idf[v] for v in t.words) for w in t.words], F.lit).alias("weights"),
            _literal(t.must, F.lit).alias("must"),
        ),
    )
    numbered = F.transform("words", lambda w, i: F.when(F.array_contains(F.array(*map(F.lit, posted)), w), i))
    looked = split.withColumn("rare", F.filter(numbered, lambda i: i.isNotNull()))

    def starts(level: dict[str, list[tuple[int, int]]]) -> Column:
        at = index(level)
        hits = F.transform("rare", lambda p: F.transform(F.element_at(at, F.get("words", p)), lambda n: n + p))
        return F.array_distinct(F.flatten(hits))

    # The starts of the rarest words, then those that the next words point at as well; templates with fewer words pass.
    depth = F.array(*[F.lit(min(POSTED, len(t.must))) for t in made])
    looked = looked.withColumn("starts", starts(postings[0]))
    for level in range(1, POSTED):
        words = F.lit(level)
        short = F.filter("starts", lambda n: F.get(depth, F.floor(n / _STARTS).cast("int")) <= words)
        looked = looked.withColumn("also", starts(postings[level]))
        looked = looked.withColumn("starts", F.concat(short, F.array_intersect("starts", "also"))).drop("also")

    def word_at(start: Column, i: Column) -> Column:
        return F.when(start + i >= 0, F.get("words", start + i))

    def placed(n: Column) -> Column:
        t, start = F.get(table, F.floor(n / _STARTS).cast("int")), (n % _STARTS - _BEFORE).cast("int")
        share = F.aggregate(
            F.transform(t["words"], lambda w, i: F.when(w == word_at(start, i), F.get(t["weights"], i)).otherwise(0.0)),
            F.lit(0.0), lambda a, x: a + x,
        )
        whole = F.forall(t["must"], lambda i: F.coalesce(word_at(start, i) == F.get(t["words"], i), F.lit(False)))
        return F.struct(
            t["label"].alias("label"), start.alias("start"), F.when(whole, F.least(share, F.lit(1.0))).otherwise(0.0).alias("share"),
            t["base"].alias("base"),
        )

    found = F.when(F.size("rare") > 0, F.filter(F.transform("starts", placed), lambda p: p["share"] >= IN_PLACE))
    placed_rows = looked.select("doc_id", F.size("words").cast("bigint").alias("n_words"), found.alias("places"))
    return placed_rows.select("doc_id", "n_words", *_summary())


def _summary() -> list[Column]:
    places = F.coalesce("places", F.array().cast("array<struct<label:string,start:int,share:double,base:boolean>>"))
    base = F.filter(places, lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"].cast("bigint"))
    named = lambda at: F.array_join(F.array_sort(F.array_distinct(F.transform(at, lambda p: p["label"]))), ",")
    return [
        F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        named(base).alias("base_labels"), named(places).alias("labels"),
        F.coalesce(F.array_max(F.transform(places, lambda p: p["share"])), F.lit(0.0)).alias("score"), places.alias("places"),
    ]

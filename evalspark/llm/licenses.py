"""License scans: phrases that name a license, and an exact set-similarity join of text blocks with license templates.

A block is a window of words, so that neither line ends nor comment marks can part it: a template of at most m words is
looked for in windows of 2 m words at every m-th word (m is a power of two), one of which holds any m words that follow
each other. A block contains a template when it has at least ``THRESHOLD`` of the template's distinct words, all the words
that tell it from its kin (mit; lesser; noncommercial), if there are such, and none that makes it another one.

Only texts that have enough words for some template, and those that tell it from its kin, are cut into blocks.

Words are put in one global order, rarest first by the number of blocks that have them. If block and template share o
words, then a word of the template's first ``|template| - o + 1`` is among the block's first ``|block| - o + 1`` (of those
words that any template has): blocks meet templates on such words only, pairs whose length or word positions leave too
few common words are discarded, and the rest is counted exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions.let import let
from evalspark.llm.order import stored

THRESHOLD = 0.8
LEAST_REACH = 8

#: Phrases that name a license wherever their words follow each other.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    """A license text. ``must`` are words that a block has to have, since without them it is a notice of another license or
    none; ``never`` are words that it must not have. They do not serve speed. No word of a ``plain`` template is so telling:
    the threshold alone decides."""

    label: str
    text: str
    must: tuple[str, ...] = ()
    never: tuple[str, ...] = ()
    plain: bool = False

    def __post_init__(self):
        if not self.must and not self.plain:
            raise ValueError(f"the template of {self.label} names no word that a block has to have, nor is it plain")
        if self.must and self.plain:
            raise ValueError(f"the template of {self.label} is plain, yet names words that a block has to have")


# License texts and notices as they stand in files.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as
published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."""
_GNU_LINE = "under the terms of the GNU {0}General Public License as published by the Free Software Foundation"
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""
_CC = "This work is licensed under a Creative Commons Attribution{0} 4.0 International License"
_RESERVED = "Copyright. All rights reserved. No part of this publication may be reproduced without permission"

TEMPLATES = (
    Template("mit", _MIT, plain=True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", plain=True),
    Template("mit", "released under the MIT license", ("mit",)),
    Template("isc", _ISC, ("fee",)),
    Template("bsd", _BSD, plain=True),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", plain=True),
    Template("apache-2", _APACHE, ("apache",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache",)),
    Template("gpl", _GNU.format("", "3"), ("gnu",), ("lesser", "affero")),
    Template("gpl", _GNU_LINE.format(""), ("gnu",), ("lesser", "affero")),
    Template("lgpl", _GNU.format("Lesser ", "3"), ("gnu", "lesser")),
    Template("lgpl", _GNU_LINE.format("Lesser "), ("gnu", "lesser")),
    Template("agpl", _GNU.format("Affero ", "3"), ("gnu", "affero")),
    Template("agpl", _GNU_LINE.format("Affero "), ("gnu", "affero")),
    Template("mpl-2", _MPL, ("mozilla",)),
    Template("unlicense", _UNLICENSE, plain=True),
    Template("cc-by", _CC.format(""), ("creative", "attribution"), ("sharealike", "noncommercial", "noderivatives")),
    Template("cc-by-sa", _CC.format("-ShareAlike"), ("sharealike",), ("noncommercial",)),
    Template("cc-by-nc", _CC.format("-NonCommercial"), ("noncommercial",), ("sharealike", "noderivatives")),
    Template("cc-by-nd", _CC.format("-NoDerivatives"), ("noderivatives",), ("noncommercial",)),
    Template("cc-by-nc-sa", _CC.format("-NonCommercial-ShareAlike"), ("noncommercial", "sharealike")),
    Template("cc-by-nc-nd", _CC.format("-NonCommercial-NoDerivatives"), ("noncommercial", "noderivatives")),
    Template("all-rights-reserved", _RESERVED, ("reserved",)),
)
# end of fixed values

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Wanted:
    """A template as its distinct words in the global order; ``need`` of them make a block contain it."""

    label: str
    words: tuple[str, ...]
    need: int
    reach: int
    must: tuple[str, ...]
    never: tuple[str, ...]

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.need + 1]

    def is_among(self, words: Column) -> Column:
        """Whether distinct words have those that the template needs."""
        enough = F.size(F.array_intersect(words, F.lit(list(self.words)))) >= self.need
        return enough & (F.size(F.array_except(F.lit(list(self.must)), words)) == 0) if self.must else enough


def spaced(text: Column) -> Column:
    """The words of a text with one space between: A-Z in lower case, other ASCII than letters and digits as gaps."""
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _GAP, " "))


def _words(text: str) -> list[str]:
    lower = text.translate(str.maketrans(_UPPER, _LOWER))
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lower).split()


def reach(template: Template) -> int:
    """m: a power of two that leaves a quarter of room for what stands between a template's words."""
    return max(LEAST_REACH, 1 << (math.ceil(1.25 * len(_words(template.text))) - 1).bit_length())


def in_order(templates: tuple[Template, ...], blocks_with: dict[str, int], threshold: float) -> list[Wanted]:
    out = []
    for t in templates:
        words = tuple(sorted(set(_words(t.text)), key=lambda w: (blocks_with.get(w, 0), w)))
        if words:
            out.append(Wanted(t.label, words, max(1, math.ceil(threshold * len(words) - 1e-9)), reach(t), t.must, t.never))
    return out


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _overlaps_itself(phrase: str) -> bool:
    words = phrase.split(" ")
    return any(words[i:] == words[: len(words) - i] for i in range(1, len(words)))


def phrase_places(words: Column, phrase: str) -> Column:
    """struct(n, first, last) of the places of a phrase in spaced words: word numbers of its starts."""
    if _overlaps_itself(phrase):
        raise ValueError(f"the places of {phrase!r} can overlap each other")
    gaps = F.split(words, f"(?<![^ ]){phrase}(?![^ ])", -1)
    n = F.size(gaps) - 1
    last = _spaces(words) - _spaces(F.element_at(gaps, -1)) - phrase.count(" ")
    place = F.struct(n.alias("n"), F.when(n > 0, _spaces(F.element_at(gaps, 1))).alias("first"), F.when(n > 0, last).alias("last"))
    none = F.struct(F.lit(0).alias("n"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    return F.when(F.contains(words, F.lit(phrase)), place).otherwise(none)


def _vocabulary(templates: list[Wanted]) -> Column:
    return F.lit(sorted({w for t in templates for w in (*t.words, *t.must, *t.never)}))


def _windows(words: Column, m: int, templates: list[Wanted]) -> Column:
    """The blocks of one reach that have enough words for some template: reach, first word, and the words that matter there."""
    starts = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / m).cast("int"))
    blocks = F.transform(
        starts,
        lambda k: F.struct(
            F.lit(m).alias("reach"), (k * m).alias("at"), F.array_intersect(F.slice(words, k * m + 1, F.lit(2 * m)), _vocabulary(templates)).alias("words")
        ),
    )
    return F.filter(blocks, lambda b: F.size(b["words"]) >= min(t.need for t in templates))


_PLACES = "array<struct<n: int, first: int, last: int>>"
_BLOCKS = "array<struct<reach: int, at: int, words: array<string>>>"


def scan(
    docs: DataFrame,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: the columns ``keep``, n_words, places (struct(n, first, last) for each of ``phrases``), and
    found: array of (at, label, containment) of every block that contains a template, sorted; ``at`` is the block's first word.

    Whole texts are searched, once; words count from 0. Null and empty texts have no words. Repeated rows are rows of the
    result each; an empty table gives no rows; other columns are ignored. Without templates or phrases their parts are
    empty. Templates are parameters: their words are literals of the plan. What is stored of a document is its places and
    the words of its blocks that templates have, at most twice its words for each size of blocks.
    """
    keys = [f"__k{i}" for i in range(len(keep))]
    spark = docs.sparkSession
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, keys, strict=True)], spaced(F.coalesce(F.col(text), F.lit(""))).alias("__words"))
    by_reach: dict[int, list[Wanted]] = {}
    for t in in_order(templates, {}, threshold):
        by_reach.setdefault(t.reach, []).append(t)
    none = F.array().cast(_BLOCKS)
    blocks = none
    if by_reach:
        # Most texts have too few words of every template; the others are cut, once, for the sizes that are asked for.
        every = [t for group in by_reach.values() for t in group]

        def windows(words: Column) -> Column:
            def of(seen: Column) -> Column:
                has = {m: reduce(lambda a, b: a | b, [t.is_among(seen) for t in group]) for m, group in by_reach.items()}
                return F.concat(*[F.when(has[m], _windows(words, m, group)).otherwise(none) for m, group in sorted(by_reach.items())])

            return let(F.array_intersect(words, _vocabulary(every)), of)

        blocks = let(F.split("__words", " "), windows)
    noted = stored(
        rows.select(
            *keys,
            F.when(F.col("__words") == "", 0).otherwise(_spaces(F.col("__words")) + 1).cast("long").alias("n_words"),
            F.array(*[phrase_places(F.col("__words"), p) for p in phrases]).cast(_PLACES).alias("places"),
            blocks.alias("blocks"),
        ),
        "license-blocks",
    )
    told = noted.where(F.size("blocks") > 0).select(F.explode("blocks").alias("b"))
    found = told.select(F.explode("b.words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    blocks_with = {r.word: r.n for r in found.collect()}  # at most the words of the templates
    wanted = in_order(templates, blocks_with, threshold)
    order = sorted({w for t in wanted for w in t.words}, key=lambda w: (blocks_with.get(w, 0), w))

    noted = noted.withColumn("__row", F.monotonically_increasing_id())
    blocks = noted.select("__row", F.explode("blocks").alias("b")).select("__row", "b.reach", "b.at", F.col("b.words").alias("every"))
    blocks = blocks.withColumn("words", F.array_intersect(F.lit(order), F.col("every")) if order else F.array().cast("array<string>"))
    least = min((t.need for t in wanted), default=1)
    prefix = F.slice(F.col("words"), F.lit(1), F.greatest(F.lit(0), F.size("words") - least + 1))
    met = blocks.withColumn("p", F.explode(F.transform(prefix, lambda w, i: F.struct(w.alias("word"), i.alias("at")))))
    # As many rows as the templates have prefix words: a parameter.
    met = met.join(F.broadcast(_prefix_table(spark, wanted)), (F.col("reach") == F.col("t_reach")) & (F.col("p.word") == F.col("t_word")))
    size = F.size("words")
    room = F.least("p.at", "t_at") + 1 + F.least(size - F.col("p.at") - 1, F.col("t_size") - F.col("t_at") - 1)
    met = met.where((size >= F.col("t_need")) & (room >= F.col("t_need")))
    met = met.withColumn("common", F.size(F.array_intersect("words", "t_words"))).where(F.col("common") >= F.col("t_need"))
    met = met.where((F.size(F.array_except("t_must", "every")) == 0) & ~F.arrays_overlap("every", "t_never"))
    hit = F.struct(F.col("at"), F.col("t_label").alias("label"), (F.col("common") / F.col("t_size")).alias("containment"))
    per_doc = met.groupBy("__row").agg(F.sort_array(F.collect_set(hit)).alias("found"))
    out = noted.drop("blocks").join(per_doc, "__row", "left")
    empty = F.array().cast("array<struct<at: int, label: string, containment: double>>")
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, keep, strict=True)], "n_words", "places", F.coalesce("found", empty).alias("found"))


def _prefix_table(spark, wanted: list[Wanted]) -> DataFrame:
    """A row for each word of each template's prefix: as large as the templates."""
    words = T.ArrayType(T.StringType())
    schema = T.StructType(
        [T.StructField("t_word", T.StringType()), T.StructField("t_label", T.StringType())]
        + [T.StructField(n, T.IntegerType()) for n in ("t_reach", "t_at", "t_size", "t_need")]
        + [T.StructField(n, words) for n in ("t_words", "t_must", "t_never")]
    )
    rows = [
        (w, t.label, t.reach, at, len(t.words), t.need, list(t.words), list(t.must), list(t.never)) for t in wanted for at, w in enumerate(t.prefix)
    ]
    return spark.createDataFrame(rows, schema)

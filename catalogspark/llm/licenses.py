"""License scans: an exact set-similarity join of text blocks with templates, in Spark functions alone.

A template of n words is looked for in blocks of 2 * s words that begin every s
words, with s the smallest of STRIDES that is n or more, so that any passage as
long as the template lies in one. A block matches a template when it holds at
least THRESHOLD of the template's distinct words. A notice of SHORT words or fewer
has too few words to be told by a share of them: its threshold is all of them, and
of the blocks found so only those count in which they stand one after another. The
join is exact:

- words are ordered by how many documents hold them, over the whole corpus;
- prefix: a match must share one of the template's |T| - need + 1 rarest words,
  so only those are join keys, and only blocks around them are formed;
- length: the block must hold `need` distinct template words;
- position: counting the words after the shared one on both sides must still
  allow `need`;
- the overlap of what is left is counted in full.

Each text is split into words once: that pass finds the base phrases at every
place, and stores of the words only those that some template has, with their
places. Templates are a fixed list, so their index is a small, bounded side.

Only A-Z are lowered. Null and empty texts have no words; texts are read
whole; repeated rows are judged alike, and rows without an id like others; an
empty table gives an empty result. Other columns of the input, whatever their
names, stay out of the result.
"""

from __future__ import annotations

from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {"cc-by": ("cc", "by"), "gpl": ("general", "public", "license"), "reserved": ("all", "rights", "reserved")}
#: Notices by label: fixed wording of well-known licenses.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "apache-short": "licensed under the apache license version 2",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-notice": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "cc0": "to the extent possible under law the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide",
    "creative-commons": "this work is licensed under a creative commons attribution license",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-short": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "mozilla": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "no-reproduction": "no part of this publication may be reproduced stored in a retrieval system or transmitted in any form or by any means without the prior written permission of the publisher",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
THRESHOLD = 0.8
#: Templates of so few words must stand word for word.
SHORT = 12
STRIDES = (16, 32, 64, 128, 256)


def words(text: str = "text") -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def stride_of(template: str) -> int:
    n = len(template.split())
    return next(s for s in STRIDES if s >= n)


def is_short(template: str) -> bool:
    return len(template.split()) <= SHORT


def need_of(template: str, threshold: float = THRESHOLD) -> int:
    """How many of the template's distinct words a block must hold."""
    return ceil((1.0 if is_short(template) else threshold) * len(set(template.split())))


def phrase_starts(w: Column, phrase: tuple[str, ...]) -> Column:
    """0-based places where the phrase's words stand one after another."""
    last = F.size(w) - len(phrase)

    def whole(i: Column) -> Column:
        out = F.get(w, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            out = out & (F.get(w, i + k) == word)
        return out

    none = F.array().cast("array<int>")
    return F.when(F.array_contains(w, phrase[0]) & (last >= 0), F.filter(F.sequence(F.lit(0), last), whole)).otherwise(none)


def read_words(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row a document, stored: id, th (which tell texts apart), n_words, s_<label> (places of the base phrases), hits (p, x: places and template words)."""
    vocabulary = sorted({x for t in templates.values() for x in t.split()})
    slim = docs.select("doc_id", F.xxhash64(F.lit(1), "doc_id").alias("id"), F.xxhash64("text").alias("th"), words().alias("w"))
    hits = F.filter(F.transform("w", lambda x, i: F.struct(i.alias("p"), x.alias("x"))), lambda h: h["x"].isin(vocabulary))
    return stored(slim.select("doc_id", "id", "th", F.size("w").cast("long").alias("n_words"), *[phrase_starts(F.col("w"), p).alias(f"s_{label}") for label, p in BASE.items()], hits.alias("hits")))


def word_order(read: DataFrame, templates: dict[str, str] = TEMPLATES) -> dict[str, int]:
    """In how many documents each template word stands: one number a template word reaches the driver."""
    held = read.select(F.explode(F.array_distinct("hits.x")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    found = {r.w: r.n for r in held.collect()}
    return {x: found.get(x, 0) for x in sorted({x for t in templates.values() for x in t.split()})}


def template_index(order: dict[str, int], threshold: float, templates: dict[str, str] = TEMPLATES) -> list[tuple]:
    """(prefix word, label, its place, size, needed overlap, all words, stride, the words of a short notice in their order) rows, rarest words first."""
    rows = []
    for label, text in templates.items():
        tokens = sorted(set(text.split()), key=lambda x: (order[x], x))
        need = need_of(text, threshold)
        rows += [(t, label, i, len(tokens), need, tokens, stride_of(text), text.split() if is_short(text) else None) for i, t in enumerate(tokens[: len(tokens) - need + 1])]
    return rows


def stands_in(placed: str, phrase: str) -> Column:
    """Whether the phrase's words stand one after another among placed words (p, x)."""
    n, last = F.size(phrase), F.size(placed) - F.size(phrase)
    whole = lambda i: (F.get(f"{placed}.p", i + n - 1) - F.get(f"{placed}.p", i) == n - 1) & (F.slice(f"{placed}.x", i + 1, n) == F.col(phrase))
    return F.when(last >= 0, F.exists(F.sequence(F.lit(0), last), whole)).otherwise(False)


def matches(read: DataFrame, threshold: float = THRESHOLD, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(id, th, found, best): templates that a block of the document contains, and the largest containment."""
    order = word_order(read, templates)
    index = template_index(order, threshold, templates)
    side = read.sparkSession.createDataFrame(index, "word string, label string, place int, size int, need int, tokens array<string>, stride int, phrase array<string>")
    keys, least = sorted({r[0] for r in index}), min(r[4] for r in index)
    rank = F.create_map(*[F.lit(x) for kv in zip(sorted(order, key=lambda x: (order[x], x)), range(len(order)), strict=True) for x in kv])
    # Documents with too few template words, or no rare one, hold no match.
    some = read.where((F.size(F.array_distinct("hits.x")) >= least) & F.arrays_overlap("hits.x", F.array(*[F.lit(k) for k in keys])))
    met = some.select("id", "th", "hits", F.explode(F.filter("hits", lambda h: h["x"].isin(keys))).alias("h")).join(F.broadcast(side.withColumnRenamed("word", "_w")), F.col("h.x") == F.col("_w"))  # the templates: a fixed list
    block = F.floor(F.col("h.p") / F.col("stride")).cast("int")
    each = met.withColumn("b", F.explode(F.array(block, block - 1))).where("b >= 0")
    inside = F.filter("hits", lambda h: (h["p"] >= F.col("b") * F.col("stride")) & (h["p"] < (F.col("b") + 2) * F.col("stride")))
    held = each.withColumn("placed", inside).withColumn("inside", F.array_distinct("placed.x"))
    # A block's template words in the global order; other words cannot overlap and only add to its length.
    known = F.transform(F.array_sort(F.transform("inside", lambda x: F.struct(F.element_at(rank, x).alias("r"), x.alias("x")))), lambda s: s["x"])
    held = held.where(F.size("inside") >= F.col("need")).withColumn("known", known).withColumn("at", F.array_position("known", F.col("h.x")) - 1)
    left_over = F.least(F.col("size") - F.col("place"), F.size("known") - F.col("at"))
    near = held.where(left_over + F.least("place", "at") >= F.col("need"))
    overlap = F.size(F.array_intersect("known", "tokens"))
    good = near.where((overlap >= F.col("need")) & (F.col("phrase").isNull() | stands_in("placed", "phrase"))).select("id", "th", "label", (overlap / F.col("size")).alias("c"))
    return good.groupBy("id", "th").agg(F.collect_set("label").alias("found"), F.max("c").alias("best"))  # labels: a fixed list


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    read = read_words(docs)
    starts = {label: F.col(f"s_{label}") for label in BASE}
    every = F.concat(*starts.values())
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for label, c in starts.items()]))
    placed = read.select("doc_id", "id", "th", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), base.alias("base"))
    out = placed.join(matches(read, threshold), ["id", "th"], "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))

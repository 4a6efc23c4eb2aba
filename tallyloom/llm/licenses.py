"""License scan: an exact set-similarity join of text blocks with license templates, native throughout.

Words are put in one global order, rarest in the corpus first. A block that holds at least
``threshold`` of a template's words must hold one of the template's first ``n - alpha + 1`` words in that
order (prefix filter, ``alpha`` being the least overlap), must hold ``alpha`` template words at all (length
filter), and behind the first word in common both must still be long enough to reach ``alpha`` (positional
filter). What passes is verified by its full overlap. Blocks are windows of twice the longest
template's words, half overlapping, over the whole text, so every run of a template's length is in one.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import ascii_lower, read, stored, text_or_empty

# Phrases whose words, standing consecutively, name a license; fixed by the task.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# The wording of license lines, notices and bodies, in blocks of a sentence or two.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
        " the software to deal in the software without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software",
    ),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of"
        " merchantability fitness for a particular purpose and noninfringement",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " http www apache org licenses license 2 0",
    ),
    (
        "apache",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
        " without warranties or conditions of any kind either express or implied",
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"
        " as published by the free software foundation",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with"
        " this file you can obtain one at",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (
        "bsd",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in"
        " the documentation and or other materials provided with the distribution",
    ),
    (
        "bsd",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
        " from this software without specific prior written permission",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that"
        " the above copyright notice and this permission notice appear in all copies",
    ),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
)
THRESHOLD = 0.8
# A template's words in any order are worth less than a phrase that stands as it is.
BAG = 0.9
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _strings(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    structs = (F.struct(*(F.lit(v).alias(n) for v, n in zip(row, names, strict=True))) for row in rows)
    return spark.range(1).select(F.inline(F.array(*structs)))


def widths(templates) -> dict[int, list[int]]:
    """Templates by the length of their blocks: lengths up to the next power of two share the longest one's."""
    lengths = [len(wording.split()) for _, wording in templates]
    classes: dict[int, list[int]] = {}
    for number, n in enumerate(lengths):
        classes.setdefault(max(n - 1, 1).bit_length(), []).append(number)
    return {max(lengths[t] for t in members): members for members in classes.values()}


def block_of(longest: int) -> tuple[int, int]:
    """Words in a block and words between the beginnings of two: each run of ``longest`` words is in one."""
    step = max(longest // 2, 1)
    return longest + step, step


def _phrase_starts(words: str, phrase: str) -> str:
    """SQL for the positions, from 0, at which a phrase's words stand in an array column."""
    parts = phrase.split()
    same = " and ".join(f"get({words}, i + {k}) = '{part}'" for k, part in enumerate(parts))
    return f"filter(sequence(0, greatest(size({words}) - 1, 0)), i -> coalesce({same}, false))"


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: word and phrase counts, places, labels and the best containment.

    ``score`` is 1 where a phrase stands, else ``BAG`` times the best containment that meets the threshold, else 0. A
    missing text is an empty one and has no words. Repeated ids and rows are scanned each for itself.
    Other columns are ignored. Templates with repeated words count each word once.
    """
    spark = docs.sparkSession
    tokens = [(label, list(dict.fromkeys(wording.split()))) for label, wording in templates]
    least = [max(1, math.ceil(threshold * len(words) - 1e-9)) for _, words in tokens]
    vocabulary = list(dict.fromkeys(word for _, words in tokens for word in words))
    classes = widths(templates)

    text = ascii_lower(text_or_empty())
    words = F.filter(F.split(F.col("__text"), GAP, -1), lambda w: w != "")
    # Only a text that holds a phrase's longest word can hold the phrase.
    marks = [max(phrase.split(), key=len) for phrase, _ in phrases]
    places = F.when(
        F.lit(False) if not marks else F.col("__text").rlike("|".join(sorted(set(map(re.escape, marks))))),
        F.array(*(F.expr(_phrase_starts("__words", phrase)) for phrase, _ in phrases)),
    )
    rows = docs.select("doc_id", text.alias("__text")).withColumn("__words", words)
    rows = rows.withColumn("present", F.array_intersect("__words", _strings(vocabulary)))
    reaches = [F.size(F.array_intersect("present", _strings(words))) >= alpha for (_, words), alpha in zip(tokens, least, strict=True)]
    # The lengths of blocks at which a text can reach a template at all.
    reached = F.array(*(F.when(reduce(or_, (reaches[t] for t in members)), F.lit(longest)) for longest, members in classes.items()))
    reached = F.array_compact(reached.cast("array<int>"))
    base = stored(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("__words").cast("bigint").alias("n_words"),
            places.alias("places"),
            "present",
            reached.alias("reached"),
            F.when(F.size(reached) > 0, F.col("__words")).alias("words"),
        ),
        "license-words",
    )

    # Global order: rarest first; every template word has a rank, also one no document holds.
    seen = base.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = {r["word"]: r["n"] for r in seen.collect()}  # at most a row per template word
    ranked = sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))
    rank = {word: k for k, word in enumerate(ranked)}
    longest_of = {t: longest for longest, members in classes.items() for t in members}
    index = []
    for t, ((_, own), alpha) in enumerate(zip(tokens, least, strict=True)):
        for j, word in enumerate(sorted(own, key=rank.__getitem__)[: len(own) - alpha + 1]):
            index.append((word, longest_of[t], t, j, len(own), alpha))
    prefixes = F.broadcast(_rows(spark, index, ["word", "longest", "template", "j", "n", "alpha"]))  # as large as the templates

    # Blocks of the texts that can reach a template at all, as template words in the global order.
    cut = base.filter("words is not null").select("row", "words", F.explode("reached").alias("longest"))
    step = F.greatest(F.floor(F.col("longest") / 2), F.lit(1)).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), step)
    cut = cut.select("row", "words", "longest", step.alias("step"), F.explode(starts).alias("start"))
    held = F.array_intersect(_strings(ranked), F.slice("words", F.col("start") + 1, F.col("longest") + F.col("step")))
    blocks = cut.select("row", "longest", "start", held.alias("held")).filter(F.size("held") >= min(least))
    probes = blocks.select("row", "longest", "start", "held", F.posexplode("held").alias("i", "word"))
    first = (
        probes.join(prefixes, ["word", "longest"])
        .groupBy("row", "start", "template", "n", "alpha")
        .agg(F.min(F.struct("i", "j")).alias("at"), F.first("held").alias("held"))
    )
    room = F.least(F.col("n") - F.col("at.j"), F.size("held") - F.col("at.i"))
    wordings = F.array(*(_strings(words) for _, words in tokens))
    names = _strings([label for label, _ in tokens])
    overlap = F.size(F.array_intersect("held", F.get(wordings, F.col("template"))))
    met = first.filter((F.size("held") >= F.col("alpha")) & (room >= F.col("alpha"))).withColumn("overlap", overlap).filter("overlap >= alpha")
    found = met.groupBy("row").agg(
        F.collect_set(F.get(names, F.col("template"))).alias("found"),
        F.max(F.col("overlap") / F.col("n")).alias("best"),
        F.count("*").alias("n_blocks"),
    )

    base_names = _strings([label for _, label in phrases])
    held_names = F.transform(
        F.filter(F.arrays_zip(F.col("places").alias("p"), base_names.alias("l")), lambda x: F.size(x["p"]) > 0), lambda x: x["l"]
    )
    spots = F.flatten("places")
    joined = base.drop("words", "present", "reached").join(found, "row", "left")
    joined = joined.withColumn("__base", F.coalesce(held_names, F.array().cast("array<string>"))).withColumn("__spots", spots)
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("__spots"), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min("__spots").cast("bigint").alias("first_word"),
        F.array_max("__spots").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("__base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("__base", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("__base") > 0, 1.0).otherwise(F.coalesce(F.lit(BAG) * F.col("best"), F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_blocks"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses in all documents."""
    return scan(read(spark, sf_dir, "documents"))


def scan_sql(templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> str:
    """The same scan as SQL that compares every block with every template of its length."""
    longest_of = {t: longest for longest, members in widths(templates).items() for t in members}
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def at(phrase: str) -> str:
        same = " and ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split(), 1))
        return f"[i for i in range(len(w)) if coalesce({same}, false)]"

    places = [at(phrase) for phrase, _ in phrases]
    labels = ", ".join(f"case when len({place}) > 0 then '{label}' end" for place, (_, label) in zip(places, phrases, strict=True))
    rows = []
    for number, (label, wording) in enumerate(templates):
        words = list(dict.fromkeys(wording.split()))
        listed = "[" + ", ".join(f"'{word}'" for word in words) + "]"
        least = max(1, math.ceil(threshold * len(words) - 1e-9))
        rows.append(f"('{label}', {listed}, {len(words)}, {least}, {longest_of[number]})")
    cuts = ", ".join(f"({longest}, {', '.join(map(str, block_of(longest)))})" for longest in widths(templates))
    return rf"""
with d as (
    select row_number() over () as r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORD}') as w
    from documents
), base as (
    select r, doc_id, len(w) as n_words, {" || ".join(places)} as spots, [l for l in [{labels}] if l is not null] as base from d
), t(label, words, n, least, longest) as (values {", ".join(rows)}),
c(longest, width, step) as (values {cuts}),
blocks as (
    select r, longest, list_slice(w, s + 1, s + width) as b
    from (select r, w, longest, width, unnest(range(0, greatest(len(w), 1), step)) as s from d, c)
), found as (
    select r, label, n, len(list_intersect(words, b)) as overlap, least from blocks join t using (longest)
), met as (
    select r, list(distinct label) as labels, max(overlap / n) as best, count(*) as n_blocks from found where overlap >= least group by r
)
select doc_id, cast(n_words as bigint) as n_words, cast(len(spots) as bigint) as n_base,
       cast(list_min(spots) as bigint) as first_word, cast(list_max(spots) as bigint) as last_word,
       array_to_string(list_sort(base), ',') as base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') as labels,
       cast(case when len(base) > 0 then 1 else coalesce(cast({BAG} as double) * best, 0) end as double) as score,
       coalesce(n_blocks, 0) as n_blocks
from base left join met using (r)
"""

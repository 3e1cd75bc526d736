"""License scans: phrases by place, and a set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import bound, filled, lower_ascii, read_table, stored, words

#: Digits and lower-case letters of ASCII, and everything beyond ASCII: the complement of
#: [\x00-\x2F\x3A-\x60\x7B-\x7F], which Java matches several times slower.
LICENSE_WORD = r"[0-9a-z\x80-\x{10FFFF}]+"

#: Fixed phrases of the base, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Passages of the notices and headers of well-known licenses, with the labels they get. None is
#: longer than half a block, so each lies whole in one of the overlapping blocks. Licenses that differ in one word have
#: passages of fewer than ten words, of which none may be missing.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "apache license version 2 0 january 2004"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under the creative commons attribution 3 0 license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike license"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("lgpl", "terms of the gnu lesser general public license"),
    ("agpl", "terms of the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("reserved", "copyright all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
)
#: A block meets a template if it has this share of the template's distinct words.
CONTAINMENT = 0.9
#: A text's words are cut into blocks that overlap by half.
BLOCK_WORDS = 64
OVERLAP = 32


def _needed(size: int) -> int:
    """The least whole number of words that meets the threshold."""
    return math.ceil(round(CONTAINMENT * size, 9))


def template_words() -> list[str]:
    """The distinct words of all templates."""
    return sorted({w for _, text in TEMPLATES for w in text.split()})


def word_order(lowered: DataFrame) -> list[str]:
    """The templates' words, rarest in the corpus first; ties by spelling.

    ``lowered`` has a column ``words``. All texts are counted, with one partial
    aggregation to a row for each template word.
    """
    tokens = template_words()
    found = lowered.select(F.explode(F.filter("words", lambda w: w.isin(tokens))).alias("word"))
    counts = {row["word"]: row["count"] for row in found.groupBy("word").count().collect()}
    return sorted(tokens, key=lambda w: (counts.get(w, 0), w))


def _ordered(text: str, order: list[str]) -> tuple[list[str], int]:
    """A template's distinct words in the given order, and how many of them a block needs."""
    tokens = sorted(set(text.split()), key=order.index)
    return tokens, _needed(len(tokens))


def template_prefixes(spark: SparkSession, order: list[str]) -> DataFrame:
    """Rows ``token, template, label, tokens, needed``: the prefix of each template.

    A block that has ``needed`` of a template's words has at least one of its
    first ``len - needed + 1`` words in any fixed order. The order puts rare words
    first, so few blocks are candidates. The table is as small as the templates.
    """
    rows = []
    for number, (label, text) in enumerate(TEMPLATES):
        tokens, needed = _ordered(text, order)
        for token in tokens[: len(tokens) - needed + 1]:
            rows.append(
                F.struct(
                    F.lit(token).alias("token"),
                    F.lit(number).alias("template"),
                    F.lit(label).alias("label"),
                    F.array(*map(F.lit, tokens)).alias("tokens"),
                    F.lit(needed).alias("needed"),
                )
            )
    return spark.range(1).select(F.inline(F.array(*rows)))


def _phrase_places(phrase: str) -> Column:
    """The starts of a phrase among ``words``, counted from 0."""
    first, *rest = phrase.split()

    def places(word_list: Column) -> Column:
        def here(word: Column, i: Column) -> Column:
            found = word == first
            for k, other in enumerate(rest, 1):
                found = found & F.coalesce(F.get(word_list, i + k) == other, F.lit(False))
            return found

        marked = F.transform(word_list, lambda w, i: F.when(here(w, i), i))
        return F.filter(marked, lambda i: i.isNotNull())

    found = bound(F.col("words"), places)
    return F.when(F.array_contains("words", rest[-1]), found).otherwise(F.array().cast("array<int>"))


def _blocks(word_list: Column) -> Column:
    """The distinct template words of each block of a text, in the order of the alphabet and joined by spaces; no block twice.

    Strings, because Spark drops repeated strings by hash and repeated arrays by comparing all pairs.
    """
    tokens = template_words()
    step = BLOCK_WORDS - OVERLAP

    def cut(known: Column) -> Column:
        last = F.greatest(F.size(known) - OVERLAP - 1, F.lit(0))
        starts = F.sequence(F.lit(0), F.floor(last / step).cast("int") * step, F.lit(step))
        block = lambda i: F.array_distinct(F.array_compact(F.slice(known, i + 1, BLOCK_WORDS)))
        return F.array_distinct(F.transform(starts, lambda i: F.concat_ws(" ", F.sort_array(block(i)))))

    return bound(F.transform(word_list, lambda w: F.when(w.isin(tokens), w)), cut)


def _matched(blocks: DataFrame, order: list[str]) -> DataFrame:
    """``at, found, share`` for the texts that meet a template: its labels and the largest share of a template.

    ``blocks`` has ``at`` and the ``block`` of a text. A prefix join: the block's words, rarest first, are looked
    up among the templates' prefixes; pairs are pruned by length and position, then verified.
    """
    known = F.array_intersect(F.array(*map(F.lit, order)), F.split("block", " "))
    tokens = blocks.select("at", known.alias("known")).select("at", "known", F.posexplode("known").alias("i", "token"))
    joined = tokens.join(F.broadcast(template_prefixes(blocks.sparkSession, order)), "token")
    held = F.size(F.array_intersect("known", "tokens"))
    met = joined.where(F.size("known") - F.col("i") >= F.col("needed")).select(
        "at", "label", "needed", held.alias("held"), F.size("tokens").alias("n")
    )
    shares = met.where("held >= needed").select("at", "label", (F.col("held") / F.col("n")).alias("share"))
    return shares.groupBy("at").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))


def license_matches(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Phrases and license templates in every whole text.

    The base finds the places where the words of ``PHRASES`` stand consecutively.
    The templates, passages of licenses, are found by an exact set-similarity join. The words of a text are cut into
    overlapping blocks, wherever its lines end; a block is a set of words. The tokens of all templates are
    ordered by their frequency in the corpus, rarest first; a block is joined by the tokens in the templates'
    prefixes, pruned by length (it must have enough template words) and by position (enough of
    them must follow the first shared one), and the remaining pairs are verified. The order of the words in a block does not count.

    What a text needs later (a few numbers, and of texts with a prefix token the distinct blocks) is stored once under a
    number; blocks travel with that number alone, and only the labels found are joined back. Only the
    table of prefixes is broadcast, whose size is that of the fixed templates. Time and memory
    grow with a text's length, whatever it holds.

    Returns ``row`` (a struct of the ``keep`` columns, all by default, whatever their names are),
    ``n_words``, ``n_base`` (places of all phrases), ``first_word`` and
    ``last_word`` (smallest and largest place, null without any), ``base_labels``,
    ``labels`` (with those of the templates; both distinct, sorted, joined by
    commas, empty without any) and ``score``: 1 with a phrase, else the largest
    share of a template that a block holds if that meets the threshold, else 0. A
    null or empty text has no words. Every row is judged by itself, so ids may be
    null or repeated; an empty table gives no rows.
    """
    keep = docs.columns if keep is None else keep
    lowered = docs.select(F.struct(*keep).alias("row"), lower_ascii(filled(text)).alias("text"))
    lowered = lowered.select("row", words(F.col("text"), LICENSE_WORD).alias("words"))
    order = word_order(lowered)
    both = [_ordered(body, order) for _, body in TEMPLATES]
    heads = sorted({t for tokens, needed in both for t in tokens[: len(tokens) - needed + 1]})
    names = [f"p{k}" for k in range(len(PHRASES))]
    placed = lowered.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        *[_phrase_places(p).alias(n) for n, p in zip(names, PHRASES)],
        F.when(F.arrays_overlap("words", F.array(*map(F.lit, heads))), _blocks(F.col("words"))).alias("blocks"),
    )
    label = lambda n, name: F.when(F.size(n) > 0, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    scanned = stored(
        placed.select(
            "row",
            F.monotonically_increasing_id().alias("at"),
            "n_words",
            sum((F.size(n) for n in names[1:]), F.size(names[0])).cast("bigint").alias("n_base"),
            F.least(*map(F.array_min, names)).cast("bigint").alias("first_word"),
            F.greatest(*map(F.array_max, names)).cast("bigint").alias("last_word"),
            F.concat(*[label(n, name) for n, name in zip(names, PHRASES.values())]).alias("base"),
            "blocks",
        )
    )
    matched = _matched(scanned.select("at", F.explode("blocks").alias("block")), order)
    joined_labels = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return scanned.drop("blocks").join(matched, "at", "left").select(
        "row",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined_labels(F.col("base")).alias("base_labels"),
        joined_labels(F.concat("base", found)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and licenses in all whole documents."""
    rows = license_matches(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("row.doc_id", *[c for c in rows.columns if c != "row"])


def _template_rows() -> str:
    return ", ".join(
        f"({n}, '{label}', {sorted(set(text.split()))}, {_needed(len(set(text.split())))})"
        for n, (label, text) in enumerate(TEMPLATES)
    )


def _phrase_rows() -> str:
    return ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())


#: The twin compares every block with every template.
OP7_SQL = rf"""
WITH templates(template, label, tokens, needed) AS (VALUES {_template_rows()}),
phrases(phrase, label) AS (VALUES {_phrase_rows()}),
docs AS (
  SELECT doc_id, row_number() OVER () AS nr,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
split AS (SELECT *, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM docs),
placed AS (SELECT nr, words, unnest(range(len(words))) AS i FROM split),
places AS (
  SELECT nr, label, i FROM placed, phrases
  WHERE list_slice(words, i + 1, i + len(string_split(phrase, ' '))) = string_split(phrase, ' ')
),
base AS (
  SELECT nr, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY nr
),
blocks AS (
  SELECT nr, list_slice(words, i + 1, i + {BLOCK_WORDS}) AS words
  FROM (SELECT nr, words, unnest(range(0, greatest(1, len(words) - {OVERLAP}), {BLOCK_WORDS - OVERLAP})) AS i FROM split)
),
shares AS (
  SELECT nr, label, len(list_intersect(words, tokens)) / len(tokens) AS share, len(list_intersect(words, tokens)) >= needed AS met
  FROM blocks, templates
),
found AS (SELECT nr, max(share) AS share, list(DISTINCT label) AS labels FROM shares WHERE met GROUP BY nr)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM split LEFT JOIN base USING (nr) LEFT JOIN found USING (nr)
"""

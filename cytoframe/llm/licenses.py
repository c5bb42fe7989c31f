"""License scan by an exact set-similarity join, in DataFrame functions alone.

1. Words are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Places where a base phrase's
   words stand consecutively are counted as they are.
2. A text is cut into overlapping blocks: for each class of template lengths (a power of two, L words) blocks of 2 L words
   every L words, so that any passage as long as a template lies in one block. Only words of the templates' fixed vocabulary
   count for containment, so a block is reduced to those right where the text is read, and blocks (and whole texts) with
   fewer than any template asks for go by the length filter at once.
3. The vocabulary is ordered by the number of documents that hold a word, rare ones first. A block that contains `share` of a
   template's n words (at least t of them) must hold one of the template's first n - t + 1 words in that order: the prefix.
   Blocks meet templates on prefix words, by a broadcast table of a fixed size (one row for each prefix word).
4. A pair is kept at its first common prefix word only; the words that stand behind it in either set bound the overlap (the
   positional filter), and what is left is verified by the exact overlap.

Nothing is approximate: every block with the containment is found. Texts are read once; what leaves that pass are counts,
places and reduced blocks, so no text is shuffled, and rows meet again on a row number of their own, which no key repeats.

Defined results: a null text is empty and has no words; null, equal or repeated ids are rows like any other, one result row
each; equal places tie by label; an empty table gives an empty result; extra columns of any name are ignored. The templates
are a parameter of a bounded size (`VOCABULARY` words).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import checkpoint

#: Share of a template's distinct words that a block must hold.
SHARE = 0.8
#: Distinct words of all templates together, at most: what is collected and broadcast is bounded by this.
VOCABULARY = 1 << 14
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: The notices that public licenses ask to be kept, or their usual one-line statement.
TEMPLATES = [
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http www apache org licenses LICENSE 2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http creativecommons org licenses by 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject "
        "to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http mozilla org MPL 2.0",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
]


def words_of(text: str) -> list[str]:
    """The words of a template."""
    low = text.translate(str.maketrans(UPPER, LOWER))
    return "".join(c if c.isalnum() or c > "\x7f" else " " for c in low).split()


def reach(text: str) -> int:
    """The class of a template: the least power of two, from 16 on, that is not below its number of words."""
    n = 16
    while n < len(words_of(text)):
        n *= 2
    return n


def least_overlap(n: int, share: float) -> int:
    """The least number of common words out of n that gives the share."""
    t = max(1, int(n * share))
    while t / n < share:
        t += 1
    return t


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _places(words: str, phrases: list[tuple[str, str]]) -> Column:
    """array<struct<s, l>>: start and label of every place where a phrase's words stand consecutively."""
    none = F.array().cast("array<struct<s:int,l:string>>")
    out = none
    for phrase, label in phrases:
        parts = phrase.split()
        # most texts lack a phrase's last word and are not walked through
        out = F.concat(out, F.when(F.array_contains(words, parts[-1]), F.filter(F.transform(words, _place(words, parts, label)), lambda x: x.isNotNull())).otherwise(none))
    return out


def _place(words: str, parts: list[str], label: str):
    return lambda w, i: F.when(_ends(w, i, words, parts), F.struct((i - (len(parts) - 1)).alias("s"), F.lit(label).alias("l")))


def _ends(w: Column, i: Column, words: str, parts: list[str]) -> Column:
    cond = w == parts[-1]
    for back, part in enumerate(reversed(parts[:-1]), 1):
        cond = cond & F.coalesce(F.get(words, i - back) == part, F.lit(False))
    return cond


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None, phrases: list[tuple[str, str]] | None = None, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    score is the highest containment of a template that a block reaches, 0 where none reaches `share`.
    """
    templates = [(label, reach(t), sorted(set(words_of(t)))) for label, t in (TEMPLATES if templates is None else templates) if words_of(t)]
    phrases = PHRASES if phrases is None else phrases
    vocabulary = sorted({w for _, _, ws in templates for w in ws})
    if len(vocabulary) > VOCABULARY:
        raise ValueError(f"the templates hold more than {VOCABULARY} words")
    classes = sorted({size for _, size, _ in templates})
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col(doc_id).alias("d"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("w"))
    rows = rows.select("d", "w", F.size("w").alias("n"), F.array_intersect("w", _strings(vocabulary)).alias("v"), _places("w", phrases).alias("places"))
    blocks = F.array().cast("array<struct<c:int,b:int,set:array<string>>>")
    for size in classes:
        own = _strings(sorted({w for _, c, ws in templates if c == size for w in ws}))
        least = min(least_overlap(len(ws), share) for _, c, ws in templates if c == size)
        last = F.greatest(F.lit(0), F.ceil(F.col("n") / size).cast("int") - 2)
        cut = F.transform(F.sequence(F.lit(0), last), lambda j: F.struct(F.lit(size).alias("c"), j.alias("b"), F.array_intersect(F.slice("w", j * size + 1, F.lit(2 * size)), own).alias("set")))
        kept = F.filter(cut, lambda x: F.size(x["set"]) >= least)
        blocks = F.concat(blocks, F.when(F.size(F.array_intersect("v", own)) >= least, kept).otherwise(F.array().cast("array<struct<c:int,b:int,set:array<string>>>")))
    seen = checkpoint(rows.select("d", F.col("n").cast("bigint").alias("n"), "places", "v", blocks.alias("blocks"), F.monotonically_increasing_id().alias("r")))
    met = matched_blocks(seen, templates, vocabulary, share).groupBy("r").agg(F.collect_set("label").alias("more"), F.max("share").alias("score"))
    all_ = seen.select("d", "n", "places", "r").join(met, "r", "left")
    starts, base = F.transform("places", lambda p: p["s"]), F.array_sort(F.array_distinct(F.transform("places", lambda p: p["l"])))
    labels = F.array_sort(F.array_distinct(F.concat(base, F.coalesce("more", F.array().cast("array<string>")))))
    return all_.select(
        F.col("d").alias("doc_id"), F.col("n").alias("n_words"), F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def matched_blocks(seen: DataFrame, templates: list[tuple[str, int, list[str]]], vocabulary: list[str], share: float) -> DataFrame:
    """(r, c, b, label, share): every block of rows (r, v, blocks) with a template that it contains.

    templates are (label, class, distinct words).
    """
    counted = seen.select(F.explode("v").alias("word")).groupBy("word").count()
    # bounded: words of the templates' vocabulary only
    count = {r["word"]: r["count"] for r in counted.collect()}
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    index = []
    for label, size, ws in templates:
        ranked, t = sorted(ws, key=place.__getitem__), least_overlap(len(ws), share)
        for word in ranked[: len(ranked) - t + 1]:
            index.append(F.struct(F.lit(word).alias("word"), F.lit(size).alias("tc"), F.lit(label).alias("label"), _strings(ranked).alias("t"), F.lit(t).alias("least"), _strings(ranked[: len(ranked) - t + 1]).alias("prefix")))
    if not index:
        return seen.select("r", F.lit(0).alias("c"), F.lit(0).alias("b"), F.lit("").alias("label"), F.lit(0.0).alias("share")).limit(0)
    table = seen.sparkSession.range(1).select(F.explode(F.array(*index)).alias("x")).select("x.*")
    first = _strings(sorted({w for _, size, ws in templates for w in sorted(ws, key=place.__getitem__)[: len(ws) - least_overlap(len(ws), share) + 1]}))
    block = seen.where(F.size("blocks") > 0).select("r", F.explode("blocks").alias("x")).select("r", "x.c", "x.b", F.array_intersect(_strings(order), "x.set").alias("set"))
    block = block.select("*", F.explode(F.array_intersect("set", first)).alias("word"))
    pair = block.join(F.broadcast(table), "word").where("c = tc").where(F.size("set") >= F.col("least"))
    pair = pair.where(F.col("word") == F.get(F.array_intersect("prefix", "set"), F.lit(0)))
    behind = F.least(F.size("t") - F.array_position("t", F.col("word")), F.size("set") - F.array_position("set", F.col("word")))
    pair = pair.where(behind + 1 >= F.col("least"))
    common = F.size(F.array_intersect("t", "set"))
    return pair.withColumn("n", common).where("n >= least").select("r", "c", "b", "label", (F.col("n") / F.size("t")).alias("share"))


def license_sql(templates: list[tuple[str, str]] | None = None, phrases: list[tuple[str, str]] | None = None, share: float = SHARE) -> str:
    """The same rows by plain counting, in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    chosen = [(k, label, reach(t), w, len(set(words_of(t)))) for k, (label, t) in enumerate(TEMPLATES if templates is None else templates) for w in sorted(set(words_of(t)))]
    values = ", ".join(f"({k}, {quote(label)}, {size}, {quote(w)}, {n}, {least_overlap(n, share)})" for k, label, size, w, n in chosen)
    found = " UNION ALL ".join(
        f"SELECT r, i - {len(p.split()) - 1} AS s, {quote(label)} AS label FROM tokens WHERE " + " AND ".join(f"w{'' if not back else back} = {quote(part)}" for back, part in enumerate(reversed(p.split())))
        for p, label in (PHRASES if phrases is None else phrases)
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
flat AS (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS w, len(w) AS n FROM d),
tokens AS (SELECT r, i, n, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS w1, lag(w, 2) OVER (PARTITION BY r ORDER BY i) AS w2 FROM flat),
places AS ({found}),
base AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY r),
template(k, label, size, word, words, least) AS (VALUES {values}),
hit AS (SELECT r, k, label, size, words, least, word, n, unnest([i // size - 1, i // size]) AS b FROM tokens JOIN template ON w = word),
block AS (
  SELECT r, k, label, count(DISTINCT word) / words AS share FROM hit
  WHERE b >= 0 AND b <= greatest(0, ceil(n / size) - 2) GROUP BY r, k, label, size, words, least, b HAVING count(DISTINCT word) >= least),
met AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS score FROM block GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ','), '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN met USING (r)
"""

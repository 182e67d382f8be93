"""License scan: an exact set-similarity join of text blocks with license templates.

A template is a notice as a set of words; a block of text contains it when at
least ``threshold`` of the template's words are in the block. Blocks are lines
for short templates and paragraphs (runs of lines that have a word) for long
ones, because licenses are often wrapped.

1. Words of the templates are counted over all texts, one count for each block
   that has the word; the rarest comes first in the order that both sides use.
2. A block is reduced to its template words, sorted in that order. It goes on if
   it is long enough for some template and one of its first words (all but the
   last ``needed - 1``) is among the first words of such a template: two sets
   with ``needed`` words in common share a word of both prefixes.
3. Blocks with equal words are one class, however many copies there are. Classes
   are joined with the templates on the words of the prefixes, then filtered by
   length and by position: after a common word at places i and j, at most
   1 + min(words left) words can be common. What is left is counted in full.
4. Matches go back to the rows that hold the blocks.

Texts are read twice and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.alnum_words import Words, find_words, word_hash
from filmlens.llm.common import table
from filmlens.llm.tokens import slices
from filmlens.sources.staging import materialize

THRESHOLD = (4, 5)
"""Least share of a template's words that a block must have, as numerator and denominator."""
LINE_WORDS = 30
"""Templates with more different words than this are searched in paragraphs instead of lines."""

# The phrases of the base labels, and short forms of published license notices.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("agpl", "This work is licensed under the GNU Affero General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Released under the BSD License"),
    ("mpl-2.0", "This file is licensed under the Mozilla Public License, version 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at. Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ),
)


@dataclass(frozen=True)
class Template:
    """``words`` are sorted, each once; ``needed`` of them make a match; ``level`` 0 is a line, 1 a paragraph."""

    label: str
    words: tuple[str, ...]
    needed: int
    level: int


def prepare(templates: Sequence[tuple[str, str]], threshold: tuple[int, int] = THRESHOLD, line_words: int = LINE_WORDS) -> list[Template]:
    """The templates as sets of words; those without a word are left out."""
    share, whole = threshold
    out = []
    for label, text in templates:
        found = find_words([text.encode()])
        words = tuple(sorted({found.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end, strict=True)}))
        if words:
            out.append(Template(label, words, -(-share * len(words) // whole), int(len(words) > line_words)))
    return out


def _blocks(words: Words) -> list[np.ndarray]:
    """Of each word: its line, and its paragraph, as numbers over all texts."""
    ends = words.data == 10
    ends[words.text_start[1:] - 1] = True
    line = np.searchsorted(np.flatnonzero(ends), words.start)
    # A paragraph ends where a line without a word, or the end of a text, lies between two words.
    text = np.searchsorted(words.text_start, words.start, side="right")
    new = np.concatenate(([True], (np.diff(line) > 1) | (np.diff(text) > 0)))[: len(line)]
    return [line, np.cumsum(new)]


def _in_vocabulary(words: Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that are in the vocabulary (sorted hashes): which of the words, and which of the vocabulary."""
    hashes = words.hashes()
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == hashes)
    return hit, at[hit]


def _sets(block: np.ndarray, token: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (block, token) pairs in that order, and the index of each block's first one."""
    pairs = np.unique(block * size + token)
    block, token = pairs // size, pairs % size
    return block, token, np.flatnonzero(np.concatenate(([True], np.diff(block) > 0))[: len(block)])


def count_words(docs: DataFrame, text_column: str, vocabulary: np.ndarray) -> np.ndarray:
    """In how many paragraphs each word of the vocabulary stands, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for _, texts in slices(batches):
            words = find_words(texts)
            hit, token = _in_vocabulary(words, vocabulary)
            total += np.bincount(_sets(_blocks(words)[1][hit], token, len(vocabulary))[1], minlength=len(vocabulary))
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["token", "n"])

    counted = docs.select(F.col(f"`{text_column}`").alias("text")).mapInArrow(count, "token bigint, n bigint")
    out = np.zeros(len(vocabulary), np.int64)
    for row in counted.groupBy("token").agg(F.sum("n").alias("n")).collect():  # one row a word of the templates
        out[row.token] = row.n
    return out


@dataclass(frozen=True)
class _Order:
    """Template words by rank, rarest first: ``vocabulary`` is sorted by hash, ``rank`` goes with it.

    ``least`` and ``prefix`` have, for each level, the least number of common
    words that makes a match and, by rank, the least such number of the templates
    that have the word in their prefix.
    """

    vocabulary: np.ndarray
    rank: np.ndarray
    least: tuple[int, int]
    prefix: tuple[np.ndarray, np.ndarray]


_NEVER = 1 << 30


def _order(templates: Sequence[Template], docs: DataFrame, text_column: str) -> tuple[_Order, list[list[int]]]:
    """The global order, and each template as sorted ranks."""
    hashes = {w: word_hash(w) for t in templates for w in t.words}
    vocabulary = np.array(sorted(hashes.values()), np.uint64)
    n = count_words(docs, text_column, vocabulary)
    place = {w: int(np.searchsorted(vocabulary, np.uint64(h))) for w, h in hashes.items()}
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.lexsort((np.arange(len(n)), n))] = np.arange(len(n))
    ranked = [sorted(int(rank[place[w]]) for w in t.words) for t in templates]
    least, prefix = [_NEVER, _NEVER], [np.full(len(n), _NEVER), np.full(len(n), _NEVER)]
    for t, ranks in zip(templates, ranked, strict=True):
        least[t.level] = min(least[t.level], t.needed)
        for r in ranks[: len(ranks) - t.needed + 1]:
            prefix[t.level][r] = min(prefix[t.level][r], t.needed)
    return _Order(vocabulary, rank, (least[0], least[1]), (prefix[0], prefix[1])), ranked


def _candidates(words: Words, order: _Order) -> list[list[tuple[int, list[int]]]]:
    """Of each text: level and sorted ranks of every block that may hold a template."""
    out: list[list[tuple[int, list[int]]]] = [[] for _ in words.counts]
    hit, at = _in_vocabulary(words, order.vocabulary)
    if not len(hit):
        return out
    owner = np.searchsorted(words.first, hit, side="right") - 1
    size = len(order.vocabulary)
    for level, block in enumerate(_blocks(words)):
        if order.least[level] == _NEVER:
            continue
        blocks, rank, first = _sets(block[hit], order.rank[at], size)
        length = np.diff(np.append(first, len(blocks)))
        place = np.arange(len(blocks)) - np.repeat(first, length)
        long = np.repeat(length, length)
        # In the block's prefix for the shortest template, and in the prefix of a template that the block is long enough for.
        probe = (place <= long - order.least[level]) & (order.prefix[level][rank] <= long)
        wanted = np.flatnonzero(np.logical_or.reduceat(probe, first))
        for b, text in zip(wanted.tolist(), owner[np.searchsorted(block[hit], blocks[first[wanted]])].tolist(), strict=True):
            out[text].append((level, rank[first[b] : first[b] + length[b]].tolist()))
    return out


def _places(words: Words, hashes: np.ndarray, phrases: Sequence[tuple[Sequence[int], str]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each phrase the words at which it starts, and the text of each word."""
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    found = []
    for phrase, _ in phrases:
        n = max(len(hashes) - len(phrase) + 1, 0)
        here = np.ones(n, bool)
        for k, h in enumerate(phrase):
            here &= hashes[k : k + n] == np.uint64(h)
        start = np.flatnonzero(here)
        found.append(start[owner[start] == owner[start + len(phrase) - 1]])
    return found, owner


_ROW = (
    "row bigint, doc_id {id}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base array<string>, blocks array<struct<level int, ranks array<int>>>"
)
_BLOCKS = pa.list_(pa.struct([("level", pa.int32()), ("ranks", pa.list_(pa.int32()))]))


def _read(docs: DataFrame, id_column: str, text_column: str, order: _Order) -> DataFrame:
    """One row per document: counts, base labels, and the blocks that may hold a template."""
    phrases = [([word_hash(w) for w in phrase.split()], label) for phrase, label in PHRASES]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            words = find_words(texts)
            hashes = words.hashes()
            n = len(texts)
            n_base, first, last = np.zeros(n, np.int64), np.full(n, _NEVER << 30), np.full(n, -1)
            labels: list[list[str]] = [[] for _ in texts]
            found, owner = _places(words, hashes, phrases)
            for start, (_, label) in zip(found, phrases, strict=True):
                text, at = owner[start], start - words.first[owner[start]]
                np.add.at(n_base, text, 1)
                np.minimum.at(first, text, at)
                np.maximum.at(last, text, at)
                for i in np.unique(text).tolist():
                    labels[i].append(label)
            blocks = [[{"level": level, "ranks": ranks} for level, ranks in blocks] for blocks in _candidates(words, order)]
            none = n_base == 0
            yield pa.record_batch(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(n_base),
                    pa.array(first, mask=none),
                    pa.array(last, mask=none),
                    pa.array(labels, pa.list_(pa.string())),
                    pa.array(blocks, _BLOCKS),
                ],
                names=["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base", "blocks"],
            )

    asked = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")
    )
    return asked.mapInArrow(read, _ROW.format(id=asked.schema["doc_id"].dataType.simpleString()))


def join_templates(classes: DataFrame, templates: Sequence[Template], ranked: Sequence[Sequence[int]]) -> DataFrame:
    """``level, ranks, label, common, size`` of every class of blocks and template that match.

    ``classes`` has ``level`` and ``ranks`` (sorted, different).
    """
    spark = classes.sparkSession
    rows = [(i, t.label, t.level, t.needed, list(r)) for i, (t, r) in enumerate(zip(templates, ranked, strict=True))]
    known = spark.createDataFrame(rows, "template int, label string, level int, needed int, words array<int>")
    prefixes = known.select(
        "template", "label", "level", "needed", "words",
        F.posexplode(F.slice("words", F.lit(1), F.size("words") - F.col("needed") + 1)).alias("j", "word"),
    )
    least = known.groupBy("level").agg(F.min("needed").alias("least"))
    probes = classes.join(least, "level").select(
        "level", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.greatest(F.size("ranks") - F.col("least") + 1, F.lit(0)))).alias("i", "word")
    )
    left = F.least(F.size("ranks") - F.col("i"), F.size("words") - F.col("j"))
    pairs = probes.join(prefixes, ["level", "word"]).filter((F.size("ranks") >= F.col("needed")) & (left >= F.col("needed")))
    pairs = pairs.dropDuplicates(["level", "ranks", "template"])
    common = F.size(F.array_intersect("ranks", "words"))
    return pairs.withColumn("common", common).filter("common >= needed").select("level", "ranks", "label", "common", F.size("words").alias("size"))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: tuple[int, int] = THRESHOLD,
    line_words: int = LINE_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 with a base phrase, else the largest share of a template that
    one block contains, if it reaches the threshold, else 0. ``templates`` is a
    list of the caller's, (label, text) each, of which tasks get the different
    words; templates without a word match nothing. Words are told apart by hashes
    of 64 bits.

    Null and empty texts have no words and no labels. Very long texts are read
    whole; a template word that a block repeats counts once. Rows that repeat an
    id or a text, and null ids, are rows of their own. Labels that several
    templates give stand once. An empty table gives an empty result. Other columns
    are not read, so their names do not matter.
    """
    prepared = prepare(templates, threshold, line_words)
    order, ranked = _order(prepared, docs, text_column) if prepared else (None, [])
    if order is None:
        order = _Order(np.zeros(1, np.uint64), np.zeros(1, np.int64), (_NEVER, _NEVER), (np.full(1, _NEVER), np.full(1, _NEVER)))
    rows = materialize(_read(docs, id_column, text_column, order), "licence-blocks")
    held = rows.select("row", F.explode("blocks").alias("block")).select("row", "block.*")
    classes = held.select("level", "ranks").distinct()
    if prepared:
        matches = materialize(join_templates(classes, prepared, ranked), "licence-matches")
    else:
        matches = classes.withColumns({"label": F.lit(""), "common": F.lit(0), "size": F.lit(1)}).limit(0)
    per_class = matches.groupBy("level", "ranks").agg(
        F.collect_set("label").alias("found"), F.max(F.col("common") / F.col("size")).alias("share")
    )
    per_row = held.join(per_class, ["level", "ranks"]).groupBy("row").agg(
        F.array_distinct(F.flatten(F.collect_set("found"))).alias("found"), F.max("share").alias("share")
    )
    nothing = F.array().cast("array<string>")
    listed = lambda labels: F.array_join(F.array_sort(labels), ",")
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        listed(F.array_distinct("base")).alias("base_labels"),
        listed(F.array_union("base", F.coalesce("found", nothing))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


NAME = "op11_license_scan"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates of every document."""
    return scan(table(spark, folder, "documents"))


def _sql() -> str:
    values = ", ".join(f"({i}, '{t.label}', {t.level}, {t.needed}, {len(t.words)}, {list(t.words)})" for i, t in enumerate(prepare(TEMPLATES)))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES)
    return (
        r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM docs
), phrases(phrase, label, n) AS (VALUES """
        + phrases
        + r"""
), starts AS (
  SELECT r, label, unnest(list_filter(range(len(ws) - n + 1), lambda i: array_to_string(ws[i + 1 : i + n], ' ') = phrase)) AS place
  FROM words, phrases WHERE text LIKE '%' || split_part(phrase, ' ', 1) || '%'
), base AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_sort(list(DISTINCT label)) AS base FROM starts GROUP BY r
), templates(template, label, level, needed, size, words) AS (VALUES """
        + values
        + r"""
), wanted AS (SELECT template, label, level, needed, size, unnest(words) AS w FROM templates
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM docs
), worded AS (
  SELECT r, p, regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lines
), numbered AS (
  SELECT r, p, ws, p - row_number() OVER (PARTITION BY r ORDER BY p) AS paragraph FROM worded WHERE len(ws) > 0
), tokens AS (
  SELECT DISTINCT r, level, CASE level WHEN 0 THEN p ELSE paragraph END AS block, w
  FROM (SELECT r, p, paragraph, unnest(ws) AS w FROM numbered), (VALUES (0), (1)) l(level)
), matched AS (
  SELECT r, label, count(*) / size AS share
  FROM tokens JOIN wanted USING (level, w) GROUP BY r, level, block, template, label, needed, size HAVING count(*) >= needed
), found AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM matched GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM words LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""
    )


ORACLE_SQL = _sql()

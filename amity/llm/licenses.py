"""License scans: exact set-similarity join of text blocks with license templates.

Texts are cut into overlapping blocks of ``BLOCK`` words, a new one every
``STRIDE`` words, so any passage of ``BLOCK - STRIDE`` words lies inside one.
A block meets a template if it holds at least the threshold's share of the
template's different words. All such pairs are found, and only they:

* *Global order.* The words of the templates are ordered by how often they
  occur in all documents, rarest first (words of no template cannot count).
* *Prefix.* A block that holds ``a`` of a template's ``t`` words must hold one
  of its ``t - a + 1`` rarest, among its own words less the ``a - 1`` most
  frequent; an index by those words gives the candidates.
* *Length.* A block with fewer than ``a`` words of templates holds no match.
* *Positions.* A shared word at places i and j leaves at most
  ``min(t - i, b - j)`` words to share; a candidate that cannot reach ``a``
  any more is dropped.
* The rest are counted in full.

Templates are a parameter of bounded size (checked), so their index goes to
every task and no text is shuffled; one aggregation of the template words'
frequencies precedes the scan. Phrases are found beside that, word by word.

Defined results: a NULL text is an empty one (no words, no match, score 0); a
NULL doc_id comes back NULL; repeated rows give a row each; an empty table
gives no rows; other columns are not read. A word is a run of ASCII digits,
lower-cased ASCII letters and characters beyond ASCII.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, read_table

BLOCK, STRIDE = 128, 64
THRESHOLD = 0.9
MAX_TEMPLATE_WORDS = 1_000_000  # words of all templates together: what every task holds
# Phrases and their labels
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# The notices that licenses ask to be put on a work, and the short forms in use
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
)
# letters lowered, what is no part of a word blank
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("phrases", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
    ("blocks", pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("word", pa.int64()), ("words", pa.int32()),
                                   ("shared", pa.int32()), ("containment", pa.float64())]))),
])
FOUND_DDL = ("doc_id bigint, n_words bigint, phrases array<struct<label: string, word: bigint>>, blocks array<struct<template: int, "
             "label: string, word: bigint, words: int, shared: int, containment: double>>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def block_starts(n_words: int, block: int, stride: int) -> range:
    """First words of the blocks: every ``stride`` words, up to the first
    block that reaches the end."""
    return range(0, max(n_words - block, 0) + stride, stride) if n_words else range(0)


class TemplateIndex:
    """The templates as lists of word ranks with their prefix index."""

    def __init__(self, templates: tuple[tuple[str, str], ...], counts: dict[bytes, int], threshold: float) -> None:
        sets = [set(words_of(text.encode())) for _, text in templates]
        vocabulary = sorted(set().union(*sets), key=lambda w: (counts.get(w, 0), w))
        self.labels, self.rank = [label for label, _ in templates], {w: r for r, w in enumerate(vocabulary)}
        self.sets = [frozenset(self.rank[w] for w in s) for s in sets]
        # a share of no words cannot be met
        self.least = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
        self.shortest = min(self.least, default=0)
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, s in enumerate(self.sets):
            for i, r in enumerate(sorted(s)[:len(s) - self.least[t] + 1]):
                self.prefix.setdefault(r, []).append((t, i))

    def candidates(self, block: list[int]) -> list[int]:
        """Templates that the filters leave for a block (ranks, ascending)."""
        met: dict[int, int] = {}
        for j, r in enumerate(block):
            for t, i in self.prefix.get(r, ()):
                least = self.least[t]
                if j > len(block) - least or met.get(t, 0) < 0:
                    continue
                so_far = met.get(t, 0)
                room = min(len(self.sets[t]) - i, len(block) - j)
                met[t] = so_far + 1 if so_far + room >= least else -1
        return sorted(t for t, m in met.items() if m > 0)

    def matches(self, block: set[int]) -> list[tuple[int, int]]:
        """(template, shared words) of every template the block meets."""
        if len(block) < self.shortest:
            return []
        shared = [(t, len(self.sets[t] & block)) for t in self.candidates(sorted(block))]
        return [(t, n) for t, n in shared if n >= self.least[t]]


def template_word_counts(docs: DataFrame, templates: tuple[tuple[str, str], ...], text: str = "text") -> DataFrame:
    """``(word, n)``: how often each word of the templates occurs in all texts;
    no more rows than the templates have words."""
    wanted = set().union(*(words_of(t.encode()) for _, t in templates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        total: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                total.update(w for w in words_of(t.as_py() or b"") if w in wanted)
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())})

    rows = docs.select(F.col(col_ref(text)).cast("string").cast("binary").alias("text")).mapInArrow(count, "word binary, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES,
                 threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK,
                 stride: int = STRIDE) -> DataFrame:
    """``(doc_id, n_words, phrases, blocks)``: every place of a phrase
    (label, first word) and every block that meets a template (template,
    label, first word, words, shared words, containment). ``templates`` and
    ``phrases`` are (label, text) pairs. Counting the templates' words is a
    job of its own, run when the scan is built."""
    sizes = [len(words_of(t.encode())) for _, t in templates]
    if not 0 < threshold <= 1 or not 0 < stride <= block or not all(sizes):
        raise ValueError("threshold in (0, 1], stride in 1 .. block, templates with words")
    if sum(sizes) > MAX_TEMPLATE_WORDS or max(sizes, default=0) > block - stride:
        raise ValueError(f"templates of at most {block - stride} words, {MAX_TEMPLATE_WORDS} in all")
    # one row a word of the templates
    counts = {bytes(r.word): r.n for r in template_word_counts(docs, templates, text).collect()} if templates else {}
    index = TemplateIndex(templates, counts, threshold)
    spaced = [(b" " + b" ".join(words_of(p.encode())) + b" ", label) for label, p in phrases]
    shared = docs.sparkSession.sparkContext.broadcast((index, spaced))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, spaced = shared.value
        rank = index.rank.get
        for b in batches:
            rows = []
            for i, t in zip(b.column(0), b.column(1), strict=True):
                words = words_of(t.as_py() or b"")
                line = b" " + b" ".join(words) + b" "
                places = []
                for phrase, label in spaced:
                    at = line.find(phrase)
                    while at >= 0:
                        places.append({"label": label, "word": line.count(b" ", 0, at)})
                        at = line.find(phrase, at + 1)
                hits = [(k, r) for k, w in enumerate(words) if (r := rank(w)) is not None]
                blocks, low, high = [], 0, 0
                for start in block_starts(len(words), block, stride):
                    while low < len(hits) and hits[low][0] < start:
                        low += 1
                    high = max(high, low)
                    while high < len(hits) and hits[high][0] < start + block:
                        high += 1
                    if high - low < index.shortest:
                        continue
                    blocks += [{"template": t, "label": index.labels[t], "word": start, "words": min(block, len(words) - start),
                                "shared": n, "containment": n / len(index.sets[t])}
                               for t, n in index.matches({r for _, r in hits[low:high]})]
                rows.append({"doc_id": i.as_py(), "n_words": len(words), "phrases": places, "blocks": blocks})
            yield pa.RecordBatch.from_pylist(rows, FOUND)

    source = docs.select(F.col(col_ref(doc_id)).cast("bigint").alias("doc_id"), F.col(col_ref(text)).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(scan, FOUND_DDL)


def license_report(found: DataFrame) -> DataFrame:
    """A scan's documents in a row each: how often and where phrases stand,
    their labels, all labels, and as score the largest share found (1 for a
    phrase, which is found whole)."""
    def names(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select("doc_id", "n_words", F.size("phrases").cast("bigint").alias("n_base"),
                        F.array_min("phrases.word").alias("first_word"), F.array_max("phrases.word").alias("last_word"),
                        names(F.col("phrases.label")).alias("base_labels"),
                        names(F.concat("phrases.label", "blocks.label")).alias("labels"),
                        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document scanned for license phrases and notices."""
    return license_report(license_scan(read_table(spark, sf_dir, "documents")))


def _values(pairs: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(pairs))


OP12_SQL = rf"""
WITH plain AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
lists(k, label, body) AS (VALUES {_values(TEMPLATES)}),
wanted AS (SELECT DISTINCT k, label, unnest(regexp_extract_all(lower(body), '[0-9a-z]+')) AS word FROM lists),
sizes AS (SELECT k, label, count(*) AS size, ceil({THRESHOLD} * count(*) - 1e-9) AS least FROM wanted GROUP BY k, label),
flat AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM plain),
hits AS (SELECT r, word, i, n FROM flat SEMI JOIN wanted USING (word)),
held AS (SELECT DISTINCT r, word, unnest(range(greatest(0, (i - {BLOCK}) // {STRIDE} + CASE WHEN i >= {BLOCK} THEN 1 ELSE 0 END),
                                               least(i // {STRIDE}, (greatest(n - {BLOCK}, 0) + {STRIDE} - 1) // {STRIDE}) + 1)) AS b FROM hits),
met AS (SELECT r, k, b, count(*) AS shared FROM held JOIN wanted USING (word) GROUP BY r, k, b),
blocks AS (SELECT r, list(DISTINCT label) AS labels, max(shared / size) AS best FROM met JOIN sizes USING (k) WHERE shared >= least GROUP BY r),
phrases(k, label, body) AS (VALUES {_values(PHRASES)}),
parts AS (SELECT k, label, string_split(body, ' ') AS part FROM phrases),
places AS (SELECT r, label, i FROM plain, parts, unnest(range(len(words))) AS x(i) WHERE words[i + 1] = part[1] AND words[i + 1:i + len(part)] = part),
base AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(base.lo AS BIGINT) AS first_word,
       CAST(base.hi AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(blocks.labels, [])))), ',') AS labels,
       CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(blocks.best, 0.0) END::DOUBLE AS score
FROM plain LEFT JOIN base USING (r) LEFT JOIN blocks USING (r)
"""
QUERIES = {"op12_license_scan": op12_license_scan}
SQL = {"op12_license_scan": OP12_SQL}

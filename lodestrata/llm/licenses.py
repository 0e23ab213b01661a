"""License scans by diagonal voting.

Hashes of all runs of K words of all documents are joined by Spark to those of the templates (a table
of a few hundred rows, so the broadcast is bounded). A match at document word d and template word t
votes for the diagonal d - t; votes are summed by (document, template, diagonal); diagonals that
lie within GAP of the next one merge where their words, too, touch, overlap or lie within GAP, which follows
passages with words put in or left out. A merged line counts each of the template's places once and needs
half of SHARE of them. What remains is checked word by word in its document: the longest common
subsequence of the template's words and of a window of the span half as long again as the template, as a
share of the template; the best window counts.

Phrases are templates too: theirs need all votes on one diagonal and all words equal.

Null text is empty text. Equal doc_ids with different texts are scanned apart, and repeated rows give
repeated results. Empty texts have no words and null positions; an empty table gives no rows. Other
columns are ignored. A long text is walked in blocks: some 10 bytes of memory for each of its bytes, and only the words
of spans become text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import arrow_rows, grams, pieces, text_bytes, word_hashes, words

K, GAP, SHARE = 2, 8, 0.75
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Wordings of public licenses.
TEMPLATES = (
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "mit",
    ),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "gpl",
    ),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Released under the MIT License", "mit"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("All rights reserved", "all-rights-reserved"),
)


def word_list(text: str) -> list[str]:
    return WORD.findall(text.translate(UPPER))


def _templates() -> list[tuple[int, bool, str, list[str]]]:
    """(number, is it a phrase, label, words)"""
    return [(i, i < len(PHRASES), label, word_list(text)) for i, (text, label) in enumerate(PHRASES + TEMPLATES)]


#: Rows of one batch of grams.
GRAM_ROWS = 1 << 16


def text_grams(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, at, gram): all runs of K words of every text; text_key tells texts of one doc_id apart."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            raw, offsets = text_bytes(batch.column(2))
            for a, b in pieces(offsets):
                h, rows = word_hashes(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                g, places = grams(h, rows, K)
                for lo in range(0, len(g), GRAM_ROWS):
                    at = places[lo : lo + GRAM_ROWS]
                    of = np.searchsorted(rows, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(of + a)), keys.take(pa.array(of + a)), pa.array((at - rows[of]).astype(np.int32)), pa.array(g[lo : lo + GRAM_ROWS].view(np.int64))],
                        ["doc_id", "text_key", "at", "gram"],
                    )

    return docs.mapInArrow(run, "doc_id long, text_key long, at int, gram long")


def template_grams(docs: DataFrame) -> DataFrame:
    """(template, place, gram, phrase, most): one row per run of K words of the fixed templates."""
    rows = []
    for number, phrase, _, ws in _templates():
        raw = np.frombuffer(" ".join(ws).encode(), np.uint8)
        h, _, _, cuts = words(raw, np.array([0, len(raw)]))
        g, at = grams(h, cuts, K)
        rows += [(number, int(t), int(x), phrase, len(ws) - K + 1) for t, x in zip(at, g.view(np.int64), strict=True)]
    return docs.sparkSession.createDataFrame(rows, "template int, place int, gram long, phrase boolean, most int")


def candidate_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans array<struct<template,first,last>>) of rows (doc_id, text_key, text), before they are checked."""
    hits = text_grams(docs).join(F.broadcast(template_grams(docs)), "gram")
    key = ["doc_id", "text_key", "template"]
    lines = hits.groupBy(*key, (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last"), F.first("phrase").alias("phrase"), F.first("most").alias("most")
    )  # a diagonal has no more places than its template
    lines = lines.filter(~F.col("phrase") | (F.size("places") >= F.col("most")))
    # bundles of neighbouring diagonals, and in each bundle islands by first word, where a later line joins if it starts within GAP of what came before
    across = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(across) > GAP)
    lines = lines.withColumn("bundle", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(across.rowsBetween(Window.unboundedPreceding, 0)))
    along = Window.partitionBy(*key, "bundle").orderBy("first", "diagonal")
    reach = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    starts = reach.isNull() | (F.col("first") > reach + GAP)
    lines = lines.withColumn("island", F.sum(starts.cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = lines.groupBy(*key, "bundle", "island").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.first("most").alias("most")
    )
    merged = merged.filter(F.size("places") >= F.col("most") * (SHARE / 2))
    span = F.struct("template", F.greatest(F.least("first", "low"), F.lit(0)).alias("first"), (F.greatest(F.col("last"), F.col("high") + F.col("most") - 1) + K - 1).alias("last"))
    return merged.groupBy("doc_id", "text_key").agg(F.collect_list(span).alias("spans"))


def common(here: list[str], wanted: list[str]) -> int:
    """Length of the longest common subsequence of two word lists, a row of the table at a time as the bits of one integer."""
    places: dict[str, int] = {}
    for i, w in enumerate(wanted):
        places[w] = places.get(w, 0) | 1 << i
    every = left = (1 << len(wanted)) - 1
    for w in here:
        hit = left & places.get(w, 0)
        left = (left + hit | left - hit) & every
    return len(wanted) - left.bit_count()


def share_of(here: list[str], wanted: list[str]) -> float:
    """The share of ``wanted`` that the best window of ``here`` holds in order."""
    wide, step = len(wanted) * 3 // 2, max(1, len(wanted) // 2)
    return max(common(here[at : at + wide], wanted) for at in range(0, max(1, len(here) - wide + step), step)) / len(wanted)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: words, checked spans of phrases and templates, labels and score."""
    docs = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    found = candidate_spans(docs)
    one = docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]) & (docs["text_key"] == found["text_key"]), "left")
    one = one.select(docs["doc_id"], docs["text"], "spans.template", "spans.first", "spans.last")
    arrow_rows(docs.sparkSession)
    known = _templates()
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base_at", pa.list_(pa.int64())), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def check(n: int, part: Callable[[int, int], list[str]], spans: list[tuple[int, int, int]]) -> tuple:
        base, labels, base_labels, score = set(), set(), set(), 0.0
        for number, first, last in spans:
            _, phrase, label, wanted = known[number]
            if phrase:
                if part(first, first + len(wanted)) == wanted:
                    base.add((first, label))
                    base_labels.add(label)
                    score = 1.0
                continue
            share = share_of(part(first, last + 1), wanted)
            score = max(score, share)
            if share >= SHARE:
                labels.add(label)
        return n, [x for x, _ in sorted(base)], ",".join(sorted(base_labels)), ",".join(sorted(labels | base_labels)), score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            rows = []
            for a, b in pieces(offsets):
                own = raw[offsets[a] : offsets[b]]
                _, starts, ends, cuts = words(own, offsets[a : b + 1] - offsets[a])
                for i in range(a, b):
                    n, base = int(cuts[i - a + 1] - cuts[i - a]), int(cuts[i - a])
                    if not batch.column(2)[i].is_valid:
                        rows.append((n, [], "", "", 0.0))
                        continue

                    def part(first: int, stop: int, n=n, base=base, own=own, starts=starts, ends=ends) -> list[str]:
                        """Words first to stop of the row: only they become text."""
                        first, stop = max(first, 0), min(stop, n)
                        return word_list(bytes(own[starts[base + first] : ends[base + stop - 1]]).decode()) if first < stop else []

                    rows.append(check(n, part, list(zip(*(batch.column(j)[i].as_py() for j in (2, 3, 4)), strict=True))))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    return one.mapInArrow(run, "doc_id long, n_words long, base_at array<long>, base_labels string, labels string, score double")


def licenses_digest(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).select(
        "doc_id",
        "n_words",
        F.size("base_at").cast("long").alias("n_base"),
        F.array_min("base_at").alias("first_word"),
        F.array_max("base_at").alias("last_word"),
        "base_labels",
        "labels",
        F.round("score", 6).alias("score"),
    )

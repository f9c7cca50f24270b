"""License scans by diagonal voting.

All rolling word k-grams of every document are hashed and joined to the (fixed, small) table of template positions. A hit at
document word p and template word q votes for the diagonal p - q; votes are summed by document, template and diagonal, close
diagonals are merged into one region (an inserted or dropped word shifts the diagonal), regions that follow each other in text and
template are chained into one span (a page header or a holder's line inside a notice parts two regions), and each span is verified
on the words themselves. Phrases use k = 2, license texts k = 5; both go through the same join.

Texts are read once: the pass that hashes them also counts their words and keeps the texts that have any template gram, so later
steps move only those.

Defined results: a null text is empty: no words, no places, empty label strings, score 0; a very long text is hashed whole, its
words and hashes in memory at a time; where a template fits several ways the first is reported, places of a phrase are all
counted; repeated rows are reported one by one; keys of any type, null or repeated, are kept as they are; an empty table gives an
empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, gram_hashes, lower_ascii, slices, table

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASE_K, TEXT_K = 2, 5
#: Stands for "the document itself" among the grams, and for its template.
DOCUMENT = 0


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return WORDS.findall(lower_ascii(self.text))


#: The contract's phrases and labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
#: Notices from the public license texts.
NOTICES = (
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("apache-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    Template("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    Template("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    Template("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    Template("cc-by-notice", "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
#: Two-word names found in the same way, besides the contract's.
NAMES = (Template("bsd", "bsd license", True), Template("mpl", "mozilla public license", True), Template("lgpl", "lesser general public license", True), Template("cc0", "cc0 1 0", True))
TEMPLATES = PHRASES + NAMES + NOTICES


def template_grams(spark, templates: Sequence[Template]) -> DataFrame:
    """(gram, template, place) for every k-gram of every template; a few thousand rows for any list of notices."""
    hashes = WordHashes()
    rows = []
    for i, t in enumerate(templates):
        w = t.words
        for q, h in enumerate(gram_hashes(hashes(w), PHRASE_K if t.phrase else TEXT_K).view(np.int64).tolist()):
            rows.append((h, i, q))
    return spark.createDataFrame(rows, "gram long, template int, place int")


def _gram_rows(wanted: np.ndarray):
    """Rows (key, r1, r2, pos, gram, text): every rolling k-gram of a document, and the document itself (gram DOCUMENT, its key,
    its number of words as pos, its text if it has one of the wanted grams)."""
    wanted = np.sort(wanted)
    # a first look at 20 bits spares most grams the search
    quick = np.zeros(1 << 20, bool)
    quick[wanted & np.uint64(0xFFFFF)] = True
    names = ["key", "r1", "r2", "pos", "gram", "text"]

    def has_any(g: np.ndarray) -> bool:
        g = g[quick[g & np.uint64(0xFFFFF)]]
        return bool(len(g)) and bool((wanted[np.minimum(np.searchsorted(wanted, g), len(wanted) - 1)] == g).any())

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch, "text"):
                r1, r2 = (part.column(c).to_numpy() for c in ("r1", "r2"))
                counts, texts, outs = [], [], []
                for i, t in enumerate(part.column("text").to_pylist()):
                    w = hashes(WORDS.findall(lower_ascii(t or "")))
                    grams = [gram_hashes(w, k) for k in (PHRASE_K, TEXT_K)]
                    counts.append(len(w))
                    texts.append(t if any(map(has_any, grams)) else None)
                    outs += [(np.full(len(g), i), np.arange(len(g), dtype=np.int32), g.view(np.int64)) for g in grams if len(g)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("r1"), part.column("r2"), pa.array(counts, pa.int32()), pa.array(np.full(len(counts), DOCUMENT)), pa.array(texts, pa.string())], names)
                if outs:
                    i, pos, gram = (np.concatenate(c) for c in zip(*outs))
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(i), part.column("key").type), pa.array(r1[i]), pa.array(r2[i]), pa.array(pos), pa.array(gram), pa.nulls(len(i), pa.string())], names)

    return run


def _verify(templates, min_score):
    words = [t.words for t in templates]

    def check(doc: list[str], spans: list[dict]) -> list[tuple[int, int, int, float]]:
        found = []
        for s in spans:
            t = words[s["template"]]
            if templates[s["template"]].phrase:
                at = s["diagonal"]
                if at >= 0 and doc[at : at + len(t)] == t:
                    found.append((s["template"], at, at + len(t) - 1, 1.0))
                continue
            a, b = max(0, s["first"] - 2), min(len(doc), s["last"] + TEXT_K + 2)
            m = SequenceMatcher(None, t, doc[a:b], autojunk=False)
            blocks = [x for x in m.get_matching_blocks() if x.size]
            score = sum(x.size for x in blocks) / len(t)
            if score >= min_score:
                found.append((s["template"], a + blocks[0].b, a + blocks[-1].b + blocks[-1].size - 1, score))
        return found

    return check


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, key: str = "doc_id", text: str = "text", near: int = 3, min_score: float = 0.5, longest_bridge: int = 200) -> DataFrame:
    """One row per document: key, n_words and the verified spans (template, first, last, score)."""
    spark = docs.sparkSession
    grams = template_grams(spark, templates)
    hashes = WordHashes()
    wanted = np.concatenate([gram_hashes(hashes(t.words), PHRASE_K if t.phrase else TEXT_K) for t in templates])
    # 128 bits name a row by its key and text; rows alike in both pool their votes, and have the same spans
    named = F.xxhash64(key, text).alias("r1"), F.xxhash64(F.lit("second"), F.col(key), F.col(text)).alias("r2")
    key_type = docs.schema[key].dataType.simpleString()
    stream = docs.select(F.col(key).alias("key"), *named, F.col(text).alias("text")).mapInArrow(_gram_rows(wanted), f"key {key_type}, r1 long, r2 long, pos int, gram long, text string")
    # the template table is fixed by its list: a few thousand rows, whatever the corpus; documents pass through the same join
    grams = grams.unionByName(spark.createDataFrame([(DOCUMENT, -1, 0)], grams.schema))
    found = table(stream.join(F.broadcast(grams), "gram").select("key", "r1", "r2", "template", "place", "pos", "text"))
    here = ["r1", "r2", "template"]
    hits = found.filter("template >= 0").withColumn("diagonal", F.col("pos") - F.col("place"))
    votes = hits.groupBy(*here, "diagonal").agg(F.count("*").alias("votes"), *[f("pos").alias(n) for f, n in ((F.min, "first"), (F.max, "last"))], F.min("place").alias("from"), F.max("place").alias("to"))
    phrase = F.array(*[F.lit(t.phrase) for t in templates])[F.col("template")]
    length = F.array(*[F.lit(len(t.words)) for t in templates])[F.col("template")]
    places = votes.filter(phrase & (F.col("votes") >= length - (PHRASE_K - 1))).select(*here, "diagonal", "first", "last")
    by_diagonal = Window.partitionBy(*here).orderBy("diagonal", "first")
    apart = (F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > near) | (F.col("first") - F.max("last").over(by_diagonal.rowsBetween(Window.unboundedPreceding, -1)) > longest_bridge)
    ends = F.sum("votes").alias("votes"), F.min("diagonal").alias("diagonal"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("from").alias("from"), F.max("to").alias("to")
    regions = votes.filter(~phrase).withColumn("region", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(by_diagonal)).groupBy(*here, "region").agg(*ends)
    # a region that goes on where the one before it stopped, in text and template, belongs to the same span
    by_place = Window.partitionBy(*here).orderBy("first", "diagonal")
    follows = (F.col("first") - F.lag("last").over(by_place)).between(1 - TEXT_K, longest_bridge) & (F.col("from") - F.lag("to").over(by_place)).between(1 - TEXT_K, longest_bridge)
    chained = regions.filter("votes > 1").withColumn("chain", F.sum((~F.coalesce(follows, F.lit(False))).cast("int")).over(by_place)).groupBy(*here, "chain").agg(*ends)
    merged = chained.filter(F.col("votes") >= F.greatest(F.lit(2), (length - TEXT_K + 1) * (min_score / 4))).select(*here, "diagonal", "first", "last")
    spans = places.unionByName(merged).groupBy("r1", "r2").agg(F.sort_array(F.collect_list(F.struct("template", "diagonal", "first", "last"))).alias("spans"))  # as many as the document has
    check = _verify(tuple(templates), min_score)
    item = pa.struct([("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])

    def verify(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                got = []
                for t, s in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    got.append([dict(zip(("template", "first", "last", "score"), x)) for x in check(WORDS.findall(lower_ascii(t)), s)] if s else [])
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("pos"), pa.array(got, pa.list_(item))], [key, "n_words", "spans"])

    schema = f"`{key}` {key_type}, n_words int, spans array<struct<template:int,first:long,last:long,score:double>>"
    rows = found.filter("template < 0")
    # the hint keeps the plan the same at every size
    checked = rows.filter("text IS NOT NULL").join(spans.hint("merge"), ["r1", "r2"], "left").select("key", "pos", "text", "spans").mapInArrow(verify, schema)
    others = rows.filter("text IS NULL").select(F.col("key").alias(key), F.col("pos").alias("n_words"), F.from_json(F.lit("[]"), schema.split("spans ")[1]).alias("spans"))
    return checked.unionByName(others).withColumn("n_words", F.col("n_words").cast("long"))


def license_scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_words, places of the contract's phrases, labels and the best score, one row per document."""
    found = license_spans(docs, templates, key, text)
    base = F.filter("spans", lambda s: s["template"] < len(PHRASES))
    label = F.array(*[F.lit(t.label) for t in templates])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda s: label[s["template"]]))), ",")
    return found.select(
        key, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"), F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: F.least(s["score"], F.lit(1.0)))), F.lit(0.0)).alias("score"),
    )


#: DuckDB, for the base columns of license_scan: every phrase at every word.
BASE_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (SELECT unnest([{'phrase': ['gnu', 'general', 'public', 'license'], 'label': 'gpl'}, {'phrase': ['apache', 'license'], 'label': 'apache'}, {'phrase': ['cc', 'by'], 'label': 'cc-by'}, {'phrase': ['mit', 'license'], 'label': 'mit'}], recursive := true)),
f AS (SELECT doc_id, label, list_filter(range(len(words) - len(phrase) + 1), lambda i: words[i + 1 : i + len(phrase)] = phrase) AS places FROM w, p),
g AS (SELECT doc_id, CAST(sum(len(places)) AS BIGINT) AS n_base, min(list_min(places)) AS first_word, max(list_max(places)) AS last_word, coalesce(string_agg(label, ',' ORDER BY label) FILTER (len(places) > 0), '') AS base_labels FROM f GROUP BY 1)
SELECT doc_id, len(words) AS n_words, n_base, first_word, last_word, base_labels FROM w JOIN g USING (doc_id)
"""

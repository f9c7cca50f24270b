"""How five filters interact: what each order of them removes where, by a Walsh-Hadamard transform of failure masks.

A document fails some of the filters A to E: a mask of 5 bits. For each part and each kind of document (all, good, toxic) the table
is summed into 32 signed sums, sum s adding each document with the sign of its mask's parity on s. The transform's inverse gives
the number of documents with each mask exactly (integers, divided by 32 without a rest), and everything that any order removes,
keeps or repeats follows from these 32 numbers. A filter's Shapley sum over all 120 orders has a closed form: a document that fails
m filters is removed first by each of them in 120 / m orders.

Filters: A, fewer words than ``least_words``; B, fewer distinct words than half; C, capitals over 3 % of characters; D, any of
``#$%&*|``; E, the text of a smaller id. Identical texts meet by digest: their rows are counted by id, part and labels first and
then reduced to the least id and its count, so a text that a third of all rows share is a few rows.

Defined results: a null text is empty (and an empty text fails A alone, and E where it comes again); a very long text is read
whole, its distinct words being in memory once; rows that share the least id of a text all stay, a null id neither has nor is a
smaller one; a null part is the empty string; an id with several labels has each of them that any of its rows gives; a document
without labels counts among all alone; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_slices

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
KINDS = ("every", "good", "toxic")
_CAPITALS = re.compile("[A-Z]+")
_MARKS = re.compile(r"[#$%&*|]")
#: Characters of a text whose words are listed at once; longer ones are walked through.
_AT_ONCE = 1 << 20


def own_failures(text: str, least_words: int = 200) -> int:
    """Bits of A to D."""
    if len(text) <= _AT_ONCE:
        words = WORD.findall(text)
        n, distinct = len(words), len(set(words))
    else:
        n, met = 0, set()
        for m in WORD.finditer(text):
            n += 1
            met.add(m[0])
        distinct = len(met)
    capitals = sum(map(len, _CAPITALS.findall(text)))
    return (n < least_words) + 2 * (100 * distinct < 50 * n) + 4 * (100 * capitals > 3 * len(text)) + 8 * (_MARKS.search(text) is not None)


def failure_masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", least_words: int = 200) -> DataFrame:
    """(part, good, toxic, mask, n): how many documents have each mask of failures."""

    def make():
        def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            masks = [own_failures(t, least_words) for t in texts]
            digests = [hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["id", "part", "own", "digest"])

        return rows

    kind = docs.schema[key].dataType.simpleString()
    d = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text"))
    # rows are divided before their texts are read: those without an id have no label and stay out of the join
    counted = lambda rows: map_slices(rows, make, f"id {kind}, part string, own int, digest binary").groupBy("id", "part", "own", "digest").agg(F.count("*").alias("n"))
    named, nameless = counted(d.filter("id IS NOT NULL")), counted(d.filter("id IS NULL"))
    told = labels.select(F.col("doc_id").alias("id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    told = told.filter("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # the hint keeps the plan the same at every size
    d = named.join(told.hint("merge"), "id", "left").unionByName(nameless.select("*", F.lit(None).cast("boolean").alias("good"), F.lit(None).cast("boolean").alias("toxic")))
    d = d.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # ids are distinct by now within a group, but for ids of several parts or texts, which are groups of their own
    with_id = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    groups = d.groupBy("digest", "own", "part", "good", "toxic").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"), F.min(with_id).alias("first"))
    least = groups.groupBy("digest").agg(F.min("first.id").alias("least"))
    groups = groups.join(least.hint("merge"), "digest")
    alone = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    cells = F.array(F.struct(F.col("own").alias("mask"), alone.alias("n")), F.struct((F.col("own") + 16).alias("mask"), (F.col("n") - alone).alias("n")))
    return groups.select("part", "good", "toxic", F.explode(cells).alias("cell")).groupBy("part", "good", "toxic", "cell.mask").agg(F.sum("cell.n").alias("n"))


def parity_sums(masks: DataFrame) -> DataFrame:
    """One row a part: for each kind of document the 32 signed sums, kind_0 to kind_31."""
    sums = []
    for kind in KINDS:
        n = F.col("n") if kind == "every" else F.when(F.col(kind), F.col("n")).otherwise(0)
        for s in range(32):
            sign = F.when(F.bit_count(F.col("mask").bitwiseAND(s)) % 2 == 1, -1).otherwise(1)
            sums.append(F.sum(sign * n).alias(f"{kind}_{s}"))
    return masks.groupBy("part").agg(*sums)


def cells(sums: np.ndarray) -> np.ndarray:
    """The transform's inverse: how many documents have each mask. A butterfly of 5 rounds over integers."""
    x = sums.astype(object)
    for bit in (1, 2, 4, 8, 16):
        low = np.array([s for s in range(32) if not s & bit])
        a, b = x[..., low].copy(), x[..., low | bit].copy()
        x[..., low], x[..., low | bit] = a + b, a - b
    assert not np.any(x % 32), "signed sums of whole numbers of documents"
    return x // 32


def order_rows(part: str, n: np.ndarray) -> pd.DataFrame:
    """All orders and steps of one part; n: cells by kind and mask."""
    every, good, toxic = n
    shapley = [sum(120 // m.bit_count() * int(every[m]) for m in range(32) if m >> f & 1) for f in range(5)]
    unique = [int(every[1 << f]) for f in range(5)]
    rows = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            f = FILTERS.index(letter)
            fresh = [m for m in range(32) if m >> f & 1 and not m & before]
            again = [m for m in range(32) if m >> f & 1 and m & before]
            before |= 1 << f
            left = [m for m in range(32) if not m & before]
            count = lambda x, at: int(sum(x[m] for m in at))
            rows.append((part, order, step, count(every, left), count(every, fresh), count(every, again), unique[f], count(good, fresh), count(toxic, fresh), shapley[f]))
    return pd.DataFrame(rows, columns=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", least_words: int = 200) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows for each part."""

    def evaluate(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                sums = np.array([[getattr(row, f"{kind}_{s}") for s in range(32)] for kind in KINDS])
                yield order_rows(row.part, cells(sums))

    sums = parity_sums(failure_masks(docs, labels, key, text, part, least_words))
    return sums.mapInPandas(evaluate, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


#: DuckDB, for filter_audit with its defaults: every document in every order.
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
l AS (SELECT doc_id, max(coalesce(CAST(quality = 1 AS INT), 0)) AS good, max(coalesce(CAST(toxic = 1 AS INT), 0)) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN coalesce(w.doc_id > least, false) THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, k AS step, substr(o, k, 1) AS letter, substr(o, 1, k - 1) AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS k)),
j AS (
  SELECT part, o, step, letter, fails, n, good, toxic, contains(fails, letter) AS bad,
         earlier <> '' AND regexp_matches(fails, '[' || CASE WHEN earlier = '' THEN '0' ELSE earlier END || ']') AS gone FROM c, s),
r AS (
  SELECT part, o AS filter_order, CAST(step AS INT) AS step, letter,
    coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (bad AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (bad AND NOT gone), 0) AS toxic_lost
  FROM j GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""

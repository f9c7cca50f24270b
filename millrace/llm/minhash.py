"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A hash scatters shingles over 2^32 points, 2^12 on each of 2^20 places of a circle: the first permutation. A second one is a
permutation of the circle's places; shifted along the circle by 0, 1, 2, ... places it gives all signature coordinates:
coordinate j is the least pair (second permutation at place + j, point on the place), so each coordinate orders all points in
its own way and names the shingle that it takes. Bands of coordinates make buckets. Texts with equal shingle sets are one
representative first, named by the set's 128-bit digest, so copies cost one row each and rows that share an id may differ in text.

Links, whole and without a quadratic step in a bucket's size: every member of a bucket is compared to the bucket's least digest
(its pivot; pairs of a crowded pivot are dealt to lots); components are taken; only buckets that still hold several components go
on, and there only members outside the largest component are compared to the others, in blocks of bounded members and shingles,
in the first bucket that a pair shares, and only where signatures don't rule a link out. A link is always confirmed on full
shingle sets. What can be missed: a pair at exactly the threshold shares no band with probability under ``miss``, has a
signature 5 standard deviations below its similarity, or (about 1e-8) equal low halves of unequal band keys. Shingles that fall on
one of the 2^32 points together count as one in signatures (in a set of a million, one in 4,000), never in the sets compared.

Defined results: a null or wordless text has no shingles and links with nothing; fewer words than a shingle make one shingle of
all; a very long text is one set in memory at a time in signing, and in a block of its own or with one lot in verifying; rows
that share an id are one node, linked by any of their texts; a row with a null id has a null component and is kept; of equal
digests in a bucket any is the same set; an empty table gives an empty table; extra columns don't matter.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, WordHashes, gram_hashes, lower_ascii, map_slices, may_contain, mix64, slices, table
from .components import components

CIRCLE = 1 << 20
#: Members and shingles of a lot; a block is two lots.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Pairs of one pivot in a task.
PIVOT_LOT = 5000


def bands_for(percent: int, miss: float = 1e-6, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold is missed with a probability of at most `miss`."""
    t = percent / 100
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-(t**rows))) if t < 1 else 1
        if bands * rows <= most:
            return bands, rows
    return most, 1


@lru_cache(1)
def second_permutation(coordinates: int) -> np.ndarray:
    """The circle's places permuted, in the upper 20 bits, its first few again at the end, as overlapping windows: row p holds what
    place p and those behind it give."""
    p = np.random.default_rng(20_240_229).permutation(CIRCLE).astype(np.uint32) << np.uint32(12)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([p, p[: coordinates - 1]]), coordinates)


def shingles(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Distinct shingle hashes in ascending order; fewer than k words are one shingle."""
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(hashes(words), min(k, len(words))))


def digest(s: np.ndarray) -> bytes:
    """128 bits that name a set, whatever its order."""
    with np.errstate(over="ignore"):
        return np.array([mix64(s + np.uint64(1)).sum(), mix64(s ^ np.uint64(0x9E3779B97F4A7C15)).sum()], ">u8").tobytes()


def signature(s: np.ndarray, coordinates: int) -> np.ndarray:
    at = mix64(s ^ np.uint64(0xA5A5A5A5DEADBEEF))
    places, points = (at % np.uint64(CIRCLE)).astype(np.int64), ((at >> np.uint64(32)) & np.uint64(0xFFF)).astype(np.uint32)
    windows = second_permutation(coordinates)
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(places), 1024):
        values = windows[places[i : i + 1024]]
        values |= points[i : i + 1024, None]
        np.minimum(least, values.min(axis=0), out=least)
    return least


def signatures(docs: DataFrame, k: int, bands: int, rows: int, key: str, text: str) -> DataFrame:
    """id, a hash of the text, n_shingles, the set's digest (node), band keys, the keys' low 32 bits and the signature's low 16
    bits, one row per document."""

    def make():
        hashes = WordHashes()
        lead = mix64(np.arange(1, bands + 1, dtype=np.uint64))

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, nodes, keys, lows, sigs = [], [], [], [], []
            for t in batch.column(2).to_pylist():
                s = shingles(t, k, hashes)
                n.append(len(s))
                if not len(s):
                    nodes.append(None), keys.append(None), lows.append(None), sigs.append(None)
                    continue
                nodes.append(digest(s))
                sig = signature(s, bands * rows)
                h = lead
                for j in range(rows):
                    h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + sig[j::rows].astype(np.uint64))
                keys.append(h.view(np.int64))
                lows.append(h.astype(np.uint32).tobytes())
                sigs.append(sig.astype(np.uint16).tobytes())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(lows, pa.binary()), pa.array(sigs, pa.binary())], ["id", "h", "n_shingles", "node", "bands", "lows", "sig"])

        return part

    return map_slices(docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text")), make, f"id {docs.schema[key].dataType.simpleString()}, h long, n_shingles long, node binary, bands array<long>, lows binary, sig binary")


def least_agreement(percent: int, coordinates: int) -> int:
    """Equal coordinates below which a pair is ruled out: 5 standard deviations under the threshold."""
    t = percent / 100
    return math.floor(coordinates * (t - 5 * math.sqrt(t * (1 - t) / coordinates)))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _as_pivots(side: DataFrame, lots: DataFrame) -> DataFrame:
    """The rows of pivots, once for each of their lots."""
    return side.join(lots, "b").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")


def _promising(pairs: DataFrame, lots: DataFrame, reps: DataFrame, percent: int, coordinates: int) -> DataFrame:
    """Pairs that sizes and signatures don't rule out."""
    least = least_agreement(percent, coordinates)
    a = reps.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    b = _as_pivots(reps.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b")), lots)
    sized = pairs.join(a, "a").join(b, ["b", "lot"]).filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, coordinates) for c in (3, 4))
                keep = pa.array((x == y).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in range(3)], ["a", "b", "lot"])

    return sized.select("a", "b", "lot", "sig_a", "sig_b").mapInArrow(compare, "a binary, b binary, lot long")


def _verified(pairs: DataFrame, lots: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full sets pass; texts meet their pairs by node, those of a pivot's lot come one after another."""
    x = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    y = _as_pivots(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), lots)

    def verify(batches):
        hashes, last = WordHashes(), (None, None)
        for whole in batches:
            for batch in slices(whole, "text_a"):
                keep = []
                for ta, tb in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                    if last[0] != tb:
                        last = (tb, shingles(tb, k, hashes))
                    keep.append(linked(shingles(ta, k, hashes), last[1], percent))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return pairs.join(x, "a").join(y, ["b", "lot"]).select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary")


def _unsettled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of buckets of three or more that hold several components, dealt to blocks: (key, band, i, j, node, component, odd).

    odd: outside the bucket's largest component. A block (i, j) holds the i-th lot of odd members and the j-th lot of all; lots
    have about BLOCK members and BLOCK_SHINGLES shingles, so each odd member meets every member of its bucket in some block."""
    m = members.join(comps.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    by = m.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    by = by.groupBy("key").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("parts"), F.max(F.struct("n", "component", "size")).alias("top"))
    count = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_SHINGLES)).cast("int")
    by = by.filter("parts > 1 AND n > 2").select("key", F.col("top.component").alias("top"), count(F.col("n") - F.col("top.n"), F.col("size") - F.col("top.size")).alias("lots_odd"), count(F.col("n"), F.col("size")).alias("lots_all"))
    m = m.join(table(by), "key").withColumn("odd", F.col("component") != F.col("top"))
    lot = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    spread = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    as_any = F.transform(spread("lots_odd"), lambda i: F.struct(i.alias("i"), lot("lots_all", 2).alias("j")))
    as_odd = F.transform(spread("lots_all"), lambda j: F.struct(lot("lots_odd", 1).alias("i"), j.alias("j")))
    return m.select("key", "band", "node", "component", F.explode(F.when(F.col("odd"), F.array_distinct(F.concat(as_any, as_odd))).otherwise(as_any)).alias("at"), (F.col("odd") & (lot("lots_odd", 1) == F.col("at.i"))).alias("odd"))


def _residual_links(members: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame, k: int, percent: int, coordinates: int) -> DataFrame:
    least = least_agreement(percent, coordinates)
    dealt = _unsettled(members, comps).join(reps.select("node", "n_shingles", "sig", "lows"), "node")

    def flag(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(-1, coordinates)
        band = int(pdf["band"].iloc[0])
        before = np.frombuffer(b"".join(pdf["lows"]), np.uint32).reshape(len(pdf), -1)[:, :band]
        n, comp, odd = pdf["n_shingles"].to_numpy(), pd.factorize(pdf["component"])[0], np.flatnonzero(pdf["odd"])
        hit = np.zeros(len(pdf), bool)
        for x in odd:
            other = np.flatnonzero((comp != comp[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])))
            other = other[(sig[other] == sig[x]).sum(axis=1) >= least]
            # an earlier bucket that both are in compares them, or has compared them
            other = other[~(before[other] == before[x]).any(axis=1)]
            if len(other):
                hit[x] = hit[other] = True
        return pdf.loc[hit, ["key", "band", "i", "j", "node", "component", "odd"]]

    flagged = dealt.select("key", "band", "at.i", "at.j", "node", "component", "odd", "n_shingles", "sig", "lows").groupBy("key", "i", "j").applyInPandas(flag, "key long, band int, i int, j int, node binary, component binary, odd boolean")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        sets = [shingles(t, k, hashes) for t in pdf["text"]]
        nodes, root = pdf["node"].to_numpy(), pd.factorize(pdf["component"])[0]
        out = []
        for x in np.flatnonzero(pdf["odd"]):
            for y in range(len(sets)):
                if root[x] != root[y] and linked(sets[x], sets[y], percent):
                    out.append((nodes[x], nodes[y]))
                    root[root == root[y]] = root[x]
        return pd.DataFrame(out, columns=["a", "b"])

    flagged = table(flagged)
    return flagged.join(texts, "node").groupBy("key", "i", "j").applyInPandas(links, "a binary, b binary")


def _links_of_ids(some: DataFrame) -> DataFrame:
    """Links between the sets of rows that share an id."""
    several = some.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("z")).filter("b <> z").select("id", "b")
    return some.join(several, "id").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", miss: float = 1e-6) -> DataFrame:
    """key, n_shingles, component_id, kept: one row for every row of docs."""
    bands, rows = bands_for(percent, miss)
    coordinates = bands * rows
    sets = table(signatures(docs, k, bands, rows, key, text))
    some = sets.filter("id IS NOT NULL AND n_shingles > 0")
    # one row stands for all rows with its set; equal sets have equal signatures
    reps = table(some.groupBy("node").agg(F.min(F.struct("id", "h")).alias("row"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "lows", "sig")]))
    members = reps.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    pivots = table(members.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1"))
    lots = table(pivots.groupBy("b").agg(F.ceil(F.max("n") / PIVOT_LOT).alias("lots")))
    shared = table(members.join(pivots.join(lots, "b"), "key").select("key", "band", "node", "n_shingles", "b", "n", F.pmod(F.xxhash64("node"), F.col("lots")).alias("lot")))
    pairs = shared.filter("node <> b").select(F.col("node").alias("a"), "b", "lot").distinct()
    promising = table(_promising(pairs, lots, reps, percent, coordinates))
    # texts with a candidate move once and are read by later steps. The hint keeps the plan the same at every size
    crowded = shared.filter("n > 2")
    wanted = promising.select(F.col("a").alias("node")).unionByName(promising.select(F.col("b").alias("node"))).unionByName(crowded.select("node")).distinct()
    wanted = table(wanted.join(reps, "node").select("node", "row.id", "row.h"))
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    texts = texts.filter(may_contain(wanted.select(F.xxhash64("id").alias("high"), F.col("h").alias("low")), F.xxhash64("id"), F.col("h")))
    texts = table(texts.join(wanted.hint("merge"), ["id", "h"]).groupBy("id", "h").agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text"))
    links = table(_verified(promising, lots, texts, k, percent).unionByName(_links_of_ids(some)))
    comps = table(components(links))
    more = table(_residual_links(crowded.select("key", "band", "node", "n_shingles"), comps, reps, texts, k, percent, coordinates))
    if more.take(1):
        comps = table(components(links.unionByName(more)))
    return _answers(sets, reps, comps, key)


def _answers(sets: DataFrame, reps: DataFrame, comps: DataFrame, key: str) -> DataFrame:
    """Each row's component. Only sets with copies or links need an answer from elsewhere; a row without a set has that of its id."""
    named = reps.select("node", "copies", F.col("row.id").alias("id"))
    grouped = comps.withColumnRenamed("id", "node").join(named, "node")
    least = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    linked_sets = grouped.join(least, "component").select("node", "component_id")
    copied = named.filter("copies > 1").join(comps.select(F.col("id").alias("node")), "node", "left_anti").select("node", F.col("id").alias("component_id"))
    answer = table(linked_sets.unionByName(copied))
    has_id, has_set = F.col("id").isNotNull(), F.col("n_shingles") > 0
    rows = sets.select("id", "n_shingles", "node")
    full = rows.filter(has_id & has_set).join(answer, "node", "left")
    bare = rows.filter(has_id & ~has_set).select("id", "n_shingles")
    others = full.join(bare.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min(F.coalesce("component_id", "id")).alias("component_id"))
    nameless = rows.filter(~has_id).select("id", "n_shingles", F.col("id").alias("component_id"))
    out = full.select("id", "n_shingles", "component_id").unionByName(bare.join(others, "id", "left")).withColumn("component_id", F.coalesce("component_id", "id")).unionByName(nameless)
    return out.select(F.col("id").alias(key), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: without the rows whose group has a smaller id, and of rows alike in id and text only one, any of
    them. Rows that share an id and differ in text all stay, as do rows with a null id. The input's columns."""
    near = table(near_duplicates(docs, k, percent, key, text))
    gone = table(near.filter("NOT kept").select(key).distinct())
    two = lambda c: (F.xxhash64(c), F.xxhash64(c, F.lit("low")))
    high, low = two(F.col(key))
    may_go = may_contain(gone.select(high.alias("high"), low.alias("low")), *two(docs[key]))
    # most rows stay where they are; those that the filter points to meet the exact list
    left = docs.filter(~may_go).unionByName(docs.filter(may_go).join(gone.hint("merge"), key, "left_anti"))
    again = table(near.filter(F.col("kept") & F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key))
    if not again.take(1):
        return left.select(*docs.columns)
    once = left.join(again, key, "left_anti").select(*docs.columns)
    one = left.join(again, key, "left_semi").groupBy(F.col(key).alias("__key"), F.sha2(text, 256).alias("__text")).agg(F.first(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return once.unionByName(one)


#: DuckDB, for near_duplicates(k=3, percent=85) on small tables: all pairs that share a shingle.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingle FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents AS d JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) AS c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

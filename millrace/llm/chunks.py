"""Document fingerprints by content-defined chunking.

A gear hash rolls over a text's bytes; a place is a boundary when the hash's masked bits are zero. Boundaries are normalised: the
mask is stricter before the wanted size and laxer after it, between a least and a greatest size. A fingerprint is the set of
chunk digests with their lengths; the containment of one fingerprint in another is the share of its bytes in common chunks. An
edit moves only the boundaries next to it.

Defined results: a null text counts as empty, with an empty fingerprint; two empty fingerprints are alike (1), an empty and
another are not (0); a very long text is chunked whole, its hashes taking some ten times its bytes; rows that share an id follow
each other in the order of their texts' hashes, equal rows in any order, null ids come first; the id is a column of whole numbers
(anything else is a TypeError); an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices, slices, whole_number_key

LEAST, WANTED, MOST = 16, 64, 256
#: The hash looks at 32 bytes; these bits of it are spread over its upper half.
STRICT, LAX = np.uint32(0x92492000), np.uint32(0x90440000)
GEAR = np.random.default_rng(1_977).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """Sum of GEAR[byte at i - j] << j over j < 32, for every i, by doubling the window."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            wider = h.copy()
            wider[step:] += h[:-step] << np.uint32(step)
            h = wider
    return h


def chunk_lengths(data: bytes) -> list[int]:
    if not data:
        return []
    h = gear_hashes(data)
    lax = np.flatnonzero((h & LAX) == 0)
    strict_at = ((h[lax] & STRICT) == 0).tolist()
    lax = lax.tolist()
    out, start, n, i, many = [], 0, len(data), 0, len(lax)
    while start < n:
        end = min(start + MOST, n)
        while i < many and lax[i] < start + LEAST - 1:
            i += 1
        j = i
        while j < many and lax[j] < end - 1:
            if lax[j] >= start + WANTED - 1 or strict_at[j]:
                end = lax[j] + 1
                break
            j += 1
        out.append(end - start)
        start = end
    return out


def fingerprint(text: str | None) -> dict[str, int]:
    """Digest to length of each distinct chunk."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out, at = {}, 0
    for n in chunk_lengths(data):
        out[xxhash.xxh3_64_hexdigest(data[at : at + n])[:12]] = n
        at += n
    return out


def as_text(f: dict[str, int]) -> str:
    """A fingerprint in writing: digest and hexadecimal length of each chunk, in the order of the digests."""
    return " ".join([f"{d}{n:03x}" for d, n in sorted(f.items())])


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of a's bytes that lie in chunks of b too."""
    if not a or not b:
        return float(not a and not b)
    return sum([n for d, n in a.items() if d in b]) / sum(a.values())


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, fingerprint for every row: one pass without a shuffle."""

    def make():
        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([as_text(fingerprint(t)) for t in texts], pa.string())], [key, "n_chars", "fingerprint"])

        return part

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, n_chars long, fingerprint string", text)


def neighbour_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", rows_per_range: int = 400) -> DataFrame:
    """Fingerprints of every text, of its edited text (see `edited`, with the next row in the order of key, the first after the
    last), and their containment.

    Rows go to ranges of (key, hash of the text), cut at the quantiles of a bounded sample, so that a range is a small part
    whatever the keys look like and however often one comes; each range also gets the first row of the next range that has one.
    Texts are moved once."""
    spark = docs.sparkSession
    whole_number_key(docs, key)
    d = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("at"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    n = d.count()
    ranges = max(1, min(20_000, -(-n // rows_per_range)))
    cuts = spark.sparkContext.broadcast(_cuts(d, n, ranges))  # two numbers for each range

    @F.pandas_udf("int")
    def range_of(at, h):
        import pandas as pd

        return pd.Series(_place(cuts.value, at.to_numpy(), h.to_numpy()))

    firsts = d.select("at", "h", range_of("at", "h").alias("range")).groupBy("range").agg(F.min(F.struct("at", "h")).alias("x")).select("range", "x.*").orderBy("range").collect()  # a row for each range
    # the first row of a range goes to the range before it too, that of the first range to the last one
    senders = [(r["at"], r["h"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    senders = spark.createDataFrame(senders or [(0, 0, 0)], "at long, h long, also int")
    ranged = d.withColumn("range", range_of("at", "h")).join(F.broadcast(senders), ["at", "h"], "left")
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("extra"))
    also = F.struct(F.col("also").alias("range"), F.lit(1).alias("extra"))
    sent = ranged.select("at", "h", "key", "text", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, also))).alias("to")).select("to.range", "to.extra", "at", "h", "key", "text")
    dealt = sent.repartition(ranges, "range").sortWithinPartitions("range", "extra", "at", "h", "text")
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        rows, held, skip = [], None, None
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for rng, extra, k, t in zip(batch.column("range").to_pylist(), batch.column("extra").to_pylist(), batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if extra and skip == rng:
                    continue
                f = fingerprint(t)
                if held and held[0] == rng:
                    rows.append(_compare(held, t, f))
                held = None if extra else (rng, k, t, f)
                skip = rng if extra else None
                if len(rows) >= 500:
                    yield _batch(rows, key)
                    rows = []
        if rows:
            yield _batch(rows, key)

    return dealt.mapInArrow(run, f"{key} {key_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _cuts(d: DataFrame, n: int, ranges: int, a_range: int = 20) -> np.ndarray:
    """Where ranges begin: quantiles of about `a_range` rows a range, chosen by a hash; pairs (at, h) in ascending order."""
    if ranges < 2:
        return np.empty((0, 2), np.int64)
    share = max(1, n // (a_range * ranges))
    some = d.select("at", "h").filter(F.pmod(F.xxhash64("at", "h", F.lit("sample")), F.lit(share)) == 0)
    some = some.groupBy("at", "h").agg(F.count("*").alias("n")).toPandas().sort_values(["at", "h"])
    if some.empty:
        return np.empty((0, 2), np.int64)
    upto = some["n"].to_numpy().cumsum()
    at = np.unique(np.searchsorted(upto, np.arange(1, ranges) * (upto[-1] / ranges)))
    return some[["at", "h"]].to_numpy(np.int64)[at]


def _place(cuts: np.ndarray, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How many cuts are at most (at, h)."""
    out, upto = np.searchsorted(cuts[:, 0], at, side="left"), np.searchsorted(cuts[:, 0], at, side="right")
    unsure = np.flatnonzero(upto > out)
    for a in np.unique(at[unsure]):  # values that are cuts: their rows are told apart by h
        rows = unsure[at[unsure] == a]
        lo, hi = out[rows[0]], upto[rows[0]]
        out[rows] = lo + np.searchsorted(cuts[lo:hi, 1], h[rows], side="right")
    return out.astype(np.int32)


def _compare(held: tuple, following: str, its: dict[str, int]) -> tuple:
    _, k, t, f = held
    e = edited(t, following)
    g = fingerprint(e)
    return k, len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), as_text(f), as_text(g), containment(f, g), containment(f, its)


def _batch(rows: list[tuple], key: str) -> pa.RecordBatch:
    types = (None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


#: DuckDB, for the texts and edited texts of neighbour_fingerprints where ids are distinct.
EDITED_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n_chars, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM t)
SELECT doc_id, n_chars, sha256(left(text, n_chars - n_chars // 2) || left(following, n_chars // 2)) AS edited_sha256 FROM n
"""

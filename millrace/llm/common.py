"""Helpers shared by the operators: words, and Arrow stages in bounded slices."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.operators.ordering import before, in_ranges  # noqa: F401
from millrace.sources.tables import shared_dir, table  # noqa: F401

#: Words of the contracts: runs of anything but a space and the controls 9 to 13.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The same class for Java's and RE2's expressions.
WORD_SQL = r"[^\x20\x09-\x0D]+"
_LOWER = {c: c + 32 for c in range(65, 91)}
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def lower_ascii(text: str) -> str:
    """Lower-case A-Z alone; every other character stays, so positions stay too."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (the splitmix64 mixer)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembered up to a bound and then forgotten; only speed depends on the memory."""

    def __init__(self, bound: int = 400_000):
        self.bound, self.known = bound, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words, from the words' hashes; order counts."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(k), np.uint64)
    for j in range(k):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n])
    return h


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20, most_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice's texts stay near most_bytes; a longer text makes a slice of its own."""
    sizes = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.float64))
    start = total = 0
    for i, s in enumerate(sizes):
        if i > start and (total + s > most_bytes or i - start >= most_rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += s
    if start < batch.num_rows:
        yield batch.slice(start)


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "text", most_bytes: int = 4 << 20) -> DataFrame:
    """mapInArrow over bounded slices; make() runs once per task and returns the function of a slice."""

    def run(batches):
        f = make()
        for batch in batches:
            for part in slices(batch, column, most_bytes):
                yield f(part)
        del f
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers for later tasks and stages, and what one freed would stay
    with it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def whole_number_key(docs: DataFrame, key: str) -> None:
    """A TypeError where the operator orders rows by a key that isn't a whole number."""
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} is {docs.schema[key].dataType.simpleString()}, not a whole number")


class Bloom:
    """Which digests may be in a set, as two bits each in 2^k bits: of fixed size, so it may be sent to all tasks. A full one lets
    everything pass."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, digests: DataFrame, most_bits: int = 1 << 27) -> Bloom:
        """digests: (high, low), two longs. Bits are united by word of 64 before they are collected: at most most_bits / 64 rows, whatever the number of digests."""
        size = min(most_bits, 1 << max(14, int(digests.count() * 16).bit_length()))
        bit = F.explode(F.array(*[F.shiftrightunsigned(c, 8).bitwiseAND(size - 1) for c in ("high", "low")]))
        words = digests.select(bit.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
        bits = np.zeros(size >> 6, np.int64)
        bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        return cls(bits.view(np.uint64))

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        """digests: rows (high, low) of 64-bit integers."""
        at = (digests >> np.uint64(8)) & np.uint64(len(self.bits) * 64 - 1)
        return ((self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def may_contain(digests: DataFrame, high: Column, low: Column, most_bits: int = 1 << 27) -> Column:
    """Whether a row's digest may be among digests(high, low): a filter before a join that keeps rows with large texts from
    moving for nothing. Only the digests go to Python."""
    bloom = digests.sparkSession.sparkContext.broadcast(Bloom.of(digests, most_bits))

    @F.pandas_udf("boolean")
    def f(h: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(bloom.value(np.stack([h.to_numpy(np.int64), n.to_numpy(np.int64)], axis=1).view(np.uint64)))

    return f(high, low)

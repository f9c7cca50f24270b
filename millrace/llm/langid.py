"""Language identification with interpolated Kneser-Ney character models.

Training: a bounded sample of labelled rows (``train_docs`` rows a language, drawn by a hash; the bound is this parameter) gives
character n-gram counts up to ``order``. Spark counts the n-grams of the sample and fits each language; the discounted, interpolated
probabilities are laid out over hash arrays sorted for binary search, with an entry for each language that has the n-gram. A text gets the language
with the lowest cross-entropy a character. The score is the calibrated posterior: a temperature is fitted on labelled sample rows
that training didn't use, and ``rejected`` marks texts whose best cross-entropy is above what nearly all (``accept``) of those
rows have.

Defined results: a null text, and one without a letter, is ``und`` with score 0; ties go to the language first in code-point
order; a very long text is read whole, its symbols and their scores in memory at a time; without any labelled row every text is
``und``; repeated rows get equal results; an empty table gives an empty table; columns of other names don't matter, and results
replace those with theirs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_slices, mix64

ORDER = 4
UNKNOWN = "und"
FLOOR = 1e-6  # probability of a symbol that a language has never had


def _fold_table() -> np.ndarray:
    """Symbol of each code point of the basic plane: its lower-case letter, or a blank for all else."""
    table = np.full(0x10000, 32, np.uint32)
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalpha():
            table[c] = ord(x.lower()) if len(x.lower()) == 1 else c
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """A text's symbols with a blank at both ends; runs of blanks are one."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    s = np.where(code < 0x10000, table[np.minimum(code, 0xFFFF)], code)
    s = np.concatenate(([32], s, [32])).astype(np.uint64)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 32) | (s[:-1] != 32)
    return s[keep]


def grams(s: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n symbols ending at each place from n - 1 on."""
    h = np.full(max(0, len(s) - n + 1), np.uint64(n), np.uint64)
    for j in range(n):
        h = h * np.uint64(0x100000001B3) + s[j : j + len(h)]
    return mix64(h)


@dataclass
class Model:
    """For each n: sorted hashes of n-grams, where each one's entries start, and the entries: a language that has the n-gram, its
    log-probability, and (below the highest n) the log-weight with which it backs off as a context. What a language lacks takes
    no room, so the model is as large as its languages' n-grams together."""

    langs: list[str]
    order: int
    keys: list[np.ndarray]
    starts: list[np.ndarray]
    lang: list[np.ndarray]
    logp: list[np.ndarray]
    back: list[np.ndarray]
    floor: np.ndarray
    temperature: float = 1.0
    most_entropy: float = math.inf

    @staticmethod
    def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
        return i, (keys[i] == h if len(keys) else np.zeros(len(h), bool))

    def _spread(self, n: int, values: np.ndarray, i: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """The entries of n-grams as a row each with a column a language; NaN where there is none."""
        out = np.full((len(i), len(self.langs)), np.nan, np.float32)
        at = np.flatnonzero(hit)
        first = self.starts[n - 1][i[at]]
        many = self.starts[n - 1][i[at] + 1] - first
        entry = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
        out[np.repeat(at, many), self.lang[n - 1][entry]] = values[entry]
        return out

    def _logp(self, s: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
        """log p of the symbol at each of the ends after its n - 1 predecessors."""
        if n == 0:
            return np.broadcast_to(self.floor, (len(ends), len(self.langs)))
        i, hit = self._find(self.keys[n - 1], self._hash(s, ends, n))
        out = self._spread(n, self.logp[n - 1], i, hit)
        miss = np.isnan(out).any(axis=1)
        if miss.any():
            at = ends[miss]
            low = self._logp(s, at, n - 1)
            if n > 1:
                j, seen = self._find(self.keys[n - 2], self._hash(s, at - 1, n - 1))
                low = low + np.nan_to_num(self._spread(n - 1, self.back[n - 2], j, seen))
            out[miss] = np.where(np.isnan(out[miss]), low, out[miss])
        return out

    @staticmethod
    def _hash(s: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
        h = np.full(len(ends), np.uint64(n), np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + s[ends - (n - 1 - j)]
        return mix64(h)

    def entropies(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        """Mean -log p a symbol, by text and language; the first symbols of a text have shorter contexts."""
        parts = [symbols(t, table) for t in texts]
        lengths = np.array([len(p) for p in parts])
        s = np.concatenate(parts)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(len(s)) - np.repeat(starts, lengths)
        total = np.zeros((len(s), len(self.langs)), np.float32)
        full = np.flatnonzero(place >= self.order - 1)
        # n-grams come again and again: each is looked up once in a slice
        once, first, back = np.unique(self._hash(s, full, self.order), return_index=True, return_inverse=True)
        total[full] = self._logp(s, full[first], self.order)[back]
        for n in range(2, self.order):
            at = np.flatnonzero(place == n - 1)
            total[at] = self._logp(s, at, n)
        sums = np.add.reduceat(total.astype(np.float64), starts, axis=0)
        return -sums / np.maximum(1, lengths - 1)[:, None]


def _gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, n, gram, context, suffix, count) over the training rows; the hashes of the gram without its last and first symbol
    tie the orders together."""

    def make():
        table = _fold_table()

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            outs = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                s = symbols(text, table)
                for n in range(1, order + 1):
                    g = grams(s, n)
                    if not len(g):
                        continue
                    once, first, count = np.unique(g, return_index=True, return_counts=True)
                    context = grams(s, n - 1)[first] if n > 1 else np.zeros(len(first), np.uint64)
                    suffix = grams(s, n - 1)[first + 1] if n > 1 else np.zeros(len(first), np.uint64)
                    outs.append((np.full(len(once), lang, object), np.full(len(once), n, np.int32), once.view(np.int64), context.view(np.int64), suffix.view(np.int64), count.astype(np.int64)))
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            cols = [np.concatenate(c) for c in zip(*outs)] if outs else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["lang", "n", "gram", "context", "suffix", "count"])

        return part

    return map_slices(sample, make, "lang string, n int, gram long, context long, suffix long, count long").groupBy("lang", "n", "gram", "context", "suffix").agg(F.sum("count").alias("count"))


def _probabilities(counts: DataFrame, order: int) -> DataFrame:
    """(lang, n, gram, logp, back): interpolated Kneser-Ney. One task fits one language; what it holds is bounded by the training
    sample's own bound."""

    def fit(c: pd.DataFrame) -> pd.DataFrame:
        by_n = {n: c[c["n"] == n] for n in range(1, order + 1)}
        lower, out = None, []
        backs = {}
        for n in range(1, order + 1):
            g = by_n[n]
            gram, context, suffix = (g[x].to_numpy(np.int64) for x in ("gram", "context", "suffix"))
            if n == order:
                count = g["count"].to_numpy(np.float64)
            else:  # below the highest order a gram counts as often as it has different symbols before it
                before, times = np.unique(by_n[n + 1]["suffix"].to_numpy(np.int64), return_counts=True)
                i = np.minimum(np.searchsorted(before, gram), max(0, len(before) - 1))
                count = np.where(before[i] == gram, times[i], 1).astype(np.float64) if len(before) else np.ones(len(gram))
            n1, n2 = (count == 1).sum(), (count == 2).sum()
            discount = (n1 + 1) / (n1 + 2 * n2 + 2)
            contexts, inverse, types = np.unique(context, return_inverse=True, return_counts=True)
            total = np.bincount(inverse, count, len(contexts))
            weight = discount * types / np.maximum(total, 1)
            if n == 1:
                low = np.full(len(gram), 1.0 / (len(gram) + 1))
            else:
                i = np.minimum(np.searchsorted(lower[0], suffix), len(lower[0]) - 1)
                low = np.where(lower[0][i] == suffix, lower[1][i], FLOOR)
                backs[n - 1] = (contexts, weight)
            p = np.maximum(count - discount, 0) / total[inverse] + weight[inverse] * low
            at = np.argsort(gram)
            lower = (gram[at], p[at])
            out.append((n, *lower))
        frames = []
        for n, gram, p in out:
            back = np.full(len(gram), np.nan)
            if n in backs and len(gram):
                contexts, weight = backs[n]
                i = np.minimum(np.searchsorted(contexts, gram), len(contexts) - 1)
                back = np.where(contexts[i] == gram, np.log(weight[i]), np.nan)
            frames.append(pd.DataFrame({"lang": c["lang"].iloc[0], "n": np.int32(n), "gram": gram, "logp": np.log(p), "back": back}))
        return pd.concat(frames)

    return counts.groupBy("lang").applyInPandas(fit, "lang string, n int, gram long, logp double, back double")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, train_docs: int = 300, longest_doc: int = 20_000, accept: float = 0.995) -> Model | None:
    """Fit on a bounded sample: for each language about train_docs rows for the counts and a third as many for the calibration.
    longest_doc bounds what one training row adds, in characters; texts to identify are always read whole."""
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    want = train_docs + max(1, train_docs // 3)
    # the draw keeps about `want` rows of each language before any row is sent on
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, 1.3 * want / n + 20 / n)))])
    unit = F.pmod(F.col("h"), F.lit(1_000_003)) / 1_000_003
    drawn = rows.filter(unit < share[F.col("lang")]).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).filter(F.col("rank") <= want)
    drawn = drawn.select("lang", F.substring("text", 1, longest_doc).alias("text"), (F.col("rank") % 4 == 0).alias("held"))
    drawn = drawn.persist()
    try:
        got = _probabilities(_gram_counts(drawn.filter("NOT held"), order), order).toPandas()
        held = drawn.filter("held").select("lang", "text").toPandas()
    finally:
        drawn.unpersist()
    langs = sorted(sizes, key=lambda x: x.encode())
    column = {x: i for i, x in enumerate(langs)}
    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    for n in range(1, order + 1):
        g = got[got["n"] == n]
        gram, lang_of = g["gram"].to_numpy(np.int64).view(np.uint64), g["lang"].map(column).to_numpy(np.int64)
        by = np.lexsort((lang_of, gram))
        k, first = np.unique(gram[by], return_index=True)
        for out, x in zip(parts, (k, np.append(first, len(by)), lang_of[by].astype(np.int32), *(g[c].to_numpy(np.float64)[by].astype(np.float32) for c in ("logp", "back")))):
            out.append(x)
    model = Model(langs, order, *parts, np.full(len(langs), math.log(FLOOR), np.float32))
    table = _fold_table()
    held = held[[any(x.isalpha() for x in t) for t in held["text"]]]
    if len(held) and len(langs) > 1:
        e = np.concatenate([model.entropies(list(held["text"][i : i + 50]), table) for i in range(0, len(held), 50)])
        truth = held["lang"].map(column).to_numpy(np.int64)

        def loss(t: float) -> float:
            z = -e * t
            z = z - z.max(axis=1, keepdims=True)
            return float(-(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))).mean())

        model.temperature = min((2.0**x for x in range(-2, 8)), key=loss)
        model.most_entropy = float(np.quantile(e.min(axis=1), accept))
    return model


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, lang_pred, score, rejected for every row. The model is sent to the tasks: it has at most `order` entries for each
    character of the training sample, so at most order * languages * train_docs * longest_doc."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        table, m = _fold_table(), shared.value

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            some = [i for i, t in enumerate(texts) if t and m and any(map(str.isalpha, t))]
            if some:
                e = m.entropies([texts[i] for i in some], table)
                z = -e * m.temperature
                z = np.exp(z - z.max(axis=1, keepdims=True))
                best = e.argmin(axis=1)
                p = z[np.arange(len(z)), best] / z.sum(axis=1)
                for j, i in enumerate(some):
                    lang[i], score[i], rejected[i] = m.langs[best[j]], float(p[j]), bool(e[j, best[j]] > m.most_entropy)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [key, "lang_pred", "score", "rejected"])

        return part

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, lang_pred string, score double, rejected boolean", text, most_bytes=1 << 20)


def language_id(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **training) -> DataFrame:
    """Train on the labelled rows whose crc32(key) mod 4 is not 2 and identify every row; held_out tells the others."""
    held = F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
    model = train(docs.filter(~held), text, lang, **training)
    out = identify(docs.select(F.struct(F.col(key), held.alias("held")).alias(key), F.col(text)), model, key, text)
    return out.select(F.col(f"{key}.{key}").alias(key), F.col(f"{key}.held").alias("held_out"), "lang_pred", "score", "rejected")

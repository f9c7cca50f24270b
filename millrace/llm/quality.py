"""Quality rules as a short-circuit cascade.

Every rule looks at one document and may reject it. Rules share features (a text's words, its lines, counts of them), and a
feature is computed once, when a rule first asks for it. On a bounded sample each feature and rule is timed and each rule's
rejections are noted document by document. The order is then chosen greedily: next comes the rule with most rejections among the
sample's documents that are still left, over what it costs there beyond the features already paid for. A document leaves the
cascade at the first rule that rejects it. The verdict is a conjunction, so the order changes the work, never the result.

Defined results: a null text counts as empty; a text without words has all counts 0 and fails ``few_words``; a very long text is
judged whole, its words and 3-word windows in memory at a time; rules of equal rate keep their given order; equal rows get equal
results; an empty table gives an empty table and the given order; columns of the input with the names of results are replaced.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_slices

SYMBOLS = "#*$%&|<>"
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]+")
_DIGITS = re.compile("[0-9]+")


class Document:
    """A text's features, each computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        return sum(map(len, _UPPER.findall(self.text)))

    @cached_property
    def n_digits(self) -> int:
        return sum(map(len, _DIGITS.findall(self.text)))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if WORD.search(x)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        often = Counter(windows)
        covered = end = 0
        for i, x in enumerate(windows):
            if often[x] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered


#: What each feature is computed from.
FEATURES = {"words": (), "n_words": ("words",), "word_chars": ("words",), "n_symbols": (), "n_upper": (), "n_digits": (), "lines": (), "n_dup_lines": ("lines",), "n_repeat_words": ("words",)}


@dataclass(frozen=True)
class Rule:
    """needs: the features that `rejects` reads."""

    name: str
    rejects: Callable[[Document], bool]
    needs: tuple[str, ...] = ()


#: Rules of the contract.
BASE_RULES = (
    Rule("few_words", lambda d: d.n_words < 50, ("n_words",)),
    Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 50 * d.n_words, ("n_repeat_words", "n_words")),
)
#: The library's own: symbols over 8 % of word characters, capitals or digits over half of them, over half of the lines
#: repeated, and words of unlikely mean length. All are integer comparisons.
OWN_RULES = (
    Rule("symbols", lambda d: 100 * d.n_symbols > 8 * d.word_chars, ("n_symbols", "word_chars")),
    Rule("capitals", lambda d: 2 * d.n_upper > d.word_chars, ("n_upper", "word_chars")),
    Rule("digits", lambda d: 2 * d.n_digits > d.word_chars, ("n_digits", "word_chars")),
    Rule("repeated_lines", lambda d: 2 * d.n_dup_lines > len(d.lines), ("n_dup_lines", "lines")),
    Rule("word_length", lambda d: d.word_chars < 2 * d.n_words or d.word_chars > 15 * d.n_words, ("word_chars", "n_words")),
)
RULES = BASE_RULES + OWN_RULES


def _closure(features: Iterable[str]) -> list[str]:
    """The features and what they are computed from, that first."""
    out: list[str] = []
    for f in features:
        out += [x for x in (*_closure(FEATURES[f]), f) if x not in out]
    return out


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 400) -> list[dict]:
    """For each rule over about sample_rows rows, drawn by a hash of the text: seconds of its own, rejected, seen, the sample's
    documents that it rejects, and the seconds of each feature that it needs."""
    n = docs.count()
    few = docs.select(F.col(text).alias("text"))
    if n > sample_rows:
        few = few.filter(F.abs(F.xxhash64("text") % 1_000_000) < max(1, round(1_000_000 * sample_rows / n)))
    features = _closure(f for r in rules for f in r.needs)

    def measure(batches):
        for batch in batches:
            rejected, spent = [], []
            for value in batch.column(0).to_pylist():
                d, times = Document(value), []
                for f in features:  # each after what it is computed from
                    t = time.perf_counter()
                    getattr(d, f)
                    times.append(time.perf_counter() - t)
                hits = []
                for r in rules:
                    t = time.perf_counter()
                    hits.append(bool(r.rejects(d)))
                    times.append(time.perf_counter() - t)
                rejected.append(hits)
                spent.append(times)
            yield pa.RecordBatch.from_arrays([pa.array(rejected, pa.list_(pa.bool_())), pa.array(spent, pa.list_(pa.float64()))], ["rejected", "spent"])

    got = few.limit(2 * sample_rows).mapInArrow(measure, "rejected array<boolean>, spent array<double>").collect()  # the sample's rows
    total = [sum(r["spent"][i] for r in got) for i in range(len(features) + len(rules))]
    cost = dict(zip(features, total))
    out = []
    for i, r in enumerate(rules):
        hits = frozenset(k for k, row in enumerate(got) if row["rejected"][i])
        out.append({"rule": r.name, "seconds": total[len(features) + i], "rejected": len(hits), "seen": len(got), "documents": hits, "features": {f: cost[f] for f in _closure(r.needs)}})
    return out


def cascade_order(estimates: list[dict], rules: tuple[Rule, ...] = RULES, paid: Iterable[str] = ()) -> tuple[Rule, ...]:
    """Rules by rejections per second among the documents left, most first; features in `paid` cost nothing. Rules that weren't
    measured come last, in their given order."""
    known = {e["rule"]: e for e in estimates if e["seen"]}
    waiting, out = [r for r in rules if r.name in known], []
    seen = max((e["seen"] for e in known.values()), default=0)
    gone, ready = set(), set(_closure(paid))

    def rate(r: Rule) -> float:
        e = known[r.name]
        hits = len(e["documents"] - gone) if "documents" in e else e["rejected"]
        seconds = e["seconds"] + sum(s for f, s in e.get("features", {}).items() if f not in ready)
        return (hits + 0.5) / (seconds * max(1, seen - len(gone)) / seen + 1e-9)

    while waiting:
        best = max(waiting, key=rate)
        waiting.remove(best)
        out.append(best)
        gone |= known[best.name].get("documents", frozenset())
        ready |= set(known[best.name].get("features", ()))
    return (*out, *(r for r in rules if r.name not in known))


def first_rejection(d: Document, ordered: tuple[Rule, ...]) -> str | None:
    return next((r.name for r in ordered if r.rejects(d)), None)


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 400) -> DataFrame:
    """The rows that no rule rejects, with the input's columns."""
    ordered = cascade_order(estimate(docs, rules, text, sample_rows), rules)

    def make():
        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = [first_rejection(Document(t), ordered) is None for t in batch.column(text).to_pylist()]
            return batch.filter(pa.array(keep, pa.bool_()))

        return part

    return map_slices(docs, make, docs.schema, text)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_report(docs: DataFrame, rules: tuple[Rule, ...] = OWN_RULES, key: str = "doc_id", text: str = "text", sample_rows: int = 400) -> DataFrame:
    """Key, the five counts, base_failed and kept for every row; the cascade decides what passes the base rules. The counts are
    results, so the order takes them as paid for."""
    ordered = cascade_order(estimate(docs, rules, text, sample_rows), rules, _COUNTS)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean"

    def make():
        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for t in batch.column(1).to_pylist():
                d = Document(t)
                failed = any(r.rejects(d) for r in BASE_RULES)
                rows.append((*(getattr(d, c) for c in _COUNTS), failed, not failed and first_rejection(d, ordered) is None))
            cols = list(zip(*rows)) or [[]] * 7
            return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.bool_()) for c in cols[5:])], [key, *_COUNTS, "base_failed", "kept"])

        return part

    return map_slices(docs.select(key, text), make, schema, text)


#: DuckDB, for quality_report with its own rules.
ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 8 * word_chars OR 2 * n_upper > word_chars OR 2 * n_digits > word_chars
         OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b
"""

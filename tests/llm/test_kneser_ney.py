"""Interpolated Kneser-Ney probabilities against a plain count over strings."""

import math
from collections import Counter

import numpy as np

from millrace.llm import langid


def hashed(gram):
    return int(langid.grams(np.array([ord(c) for c in gram], np.uint64), len(gram))[0].view(np.int64))


def plain(texts, order):
    """(n, gram) to (log p, log weight of its context), from the definition."""
    raw = {n: Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1)) for n in range(1, order + 1)}
    p, back = {}, {}
    for n in range(1, order + 1):
        if n == order:
            count = dict(raw[n])
        else:
            before = Counter(g[1:] for g in raw[n + 1])
            count = {g: before.get(g, 1) for g in raw[n]}
        ones, twos = (sum(c == k for c in count.values()) for k in (1, 2))
        d = (ones + 1) / (ones + 2 * twos + 2)
        total, types = Counter(), Counter()
        for g, c in count.items():
            total[g[:-1]] += c
            types[g[:-1]] += 1
        for g, c in count.items():
            low = 1 / (len(count) + 1) if n == 1 else math.exp(p[n - 1, g[1:]])
            p[n, g] = math.log(max(c - d, 0) / total[g[:-1]] + d * types[g[:-1]] / total[g[:-1]] * low)
        if n > 1:
            back |= {(n - 1, g): math.log(d * types[g] / total[g]) for g in total}
    return p, back


def test_probabilities(spark):
    by_lang = {"aa": ["banana band", "bandana and bananas", "an ab ba"], "bb": ["cab dab", "abba cadabra bad"]}
    rows = [(lang, t) for lang, ts in by_lang.items() for t in ts]
    got = langid._probabilities(langid._gram_counts(spark.createDataFrame(rows, "lang string, text string"), 4), 4).collect()
    for lang, texts in by_lang.items():
        p, back = plain([f" {t} " for t in texts], 4)
        mine = {(r.n, r.gram): r for r in got if r.lang == lang}
        assert len(mine) == len(p)
        for (n, g), want in p.items():
            r = mine[n, hashed(g)]
            assert abs(r.logp - want) < 1e-9, g
            if (n, g) in back:
                assert abs(r.back - back[n, g]) < 1e-9, g


def test_a_context_sums_to_one_with_what_it_backs_off_to(spark):
    """Seen symbols after a context, and the back-off weight over the symbols that the lower order has beyond them."""
    texts = [" banana band ", " bandana and bananas ", " an ab ba "]
    p, back = plain(texts, 4)
    symbols = {g for n, g in p if n == 1}

    def prob(context, c):
        if not context:
            return math.exp(p[1, c])
        n = len(context) + 1
        if (n, context + c) in p:
            return math.exp(p[n, context + c])
        return math.exp(back.get((n - 1, context), 0.0)) * prob(context[1:], c)

    unseen = 1 - sum(prob("", c) for c in symbols)
    assert 0 < unseen < 0.1
    for context in ("ana", "ban", " b", "n", "a"):
        assert abs(sum(prob(context, c) for c in symbols) - 1) < 0.05

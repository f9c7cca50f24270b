"""The audit of filters against a plain run of every order."""

import random
import re
from itertools import permutations

import numpy as np

from millrace.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute_force(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic). Applies every order document by document."""
    cases = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            fails.add("C")
        if set("#$%&*|") & set(t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        mine = [x for x in labels if i is not None and x[0] == i]
        cases.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, credit = {}, {}
    for part in {c[0] for c in cases}:
        own = [c for c in cases if c[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [c for c in left if f in c[1]]
                failing = sum(f in c[1] for c in own)
                left = [c for c in left if f not in c[1]]
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(c[1] == {f} for c in own), sum(c[2] for c in gone), sum(c[3] for c in gone)]
                credit[part, f] = credit.get((part, f), 0) + len(gone)
    return {(p, o, s, *v, credit[p, o[s - 1]]) for (p, o, s), v in out.items()}


def check(spark, docs, labels):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, lang string, part string, n int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in fa.filter_audit(d, lab).select(COLUMNS).collect()]
    assert len(set(got)) == len(got) and set(got) == brute_force(docs, labels)


def test_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(300))
    docs = [
        (1, None, "en"), (2, "", "en"), (3, long, "en"), (4, long, "fr"), (4, long, "fr"), (3, long, None), (None, long, "en"), (None, None, None), (5, long + " #", ""), (6, "A" * 40, "de"),
        (7, "a " * 400, "de"), (7, long, "de"), (8, " \t\n", "de"), (9, long.upper(), "x"), (10, "é" * 99 + "AAA", "x"), (11, "é" * 97 + "AAA", "x"), (None, "q", "x"), (0, "q", "x"), (-5, "q", "y"),
    ]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (4, 1, None), (7, 0, 1), (None, 1, 1), (99, 1, 1), (10, 2, 2)]
    check(spark, docs, labels)


def test_random_rows(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(250)] + ["B", "C"]
    texts = [" ".join(rng.choice(words[: rng.choice([3, 250])]) for _ in range(rng.choice([50, 199, 200, 400]))) + rng.choice(["", "", " $", " CAPS" * 60]) for _ in range(40)]
    docs = [(i, rng.choice(texts), rng.choice(["en", "fr", None])) for i in range(300)]
    check(spark, docs, [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 300, 3)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(docs, labels).collect() == []
    check(spark, [(1, "a", "en")], [])


def test_transform_is_inverted():
    rng = np.random.default_rng(1)
    n = rng.integers(0, 10**9, (3, 32))
    signs = np.array([[(-1) ** (m & s).bit_count() for m in range(32)] for s in range(32)])
    assert (fa.cells(n @ signs.T) == n).all()


def test_long_texts_are_walked_through():
    text = "ab cd " * 300_000
    assert len(text) > fa._AT_ONCE and fa.own_failures(text) == 2

"""Rows of one key that may still be kept: tuples against the pandas rule, ties and missing texts included, and its time."""

import random
import time

import pandas as pd

from millrace.streaming.ingest import _could_win, _winners


def rows_of(rng, n):
    return [(f"p{i}", rng.choice([None, "2024-01", "2024-02", "2024-03"]), rng.randrange(6)) for i in range(n)]


def test_winners_are_those_of_the_rule():
    rng = random.Random(1)
    for _ in range(300):
        rows = rows_of(rng, rng.randrange(1, 9))
        want = _could_win(pd.DataFrame([("k", *r) for r in rows], columns=["k", "p", "u", "o"]), ["k"], "u", "o")
        assert _winners(rows) == [(p, None if pd.isna(u) else u, o) for _, p, u, o in want.itertuples(index=False, name=None)]


def test_a_key_costs_little():
    """Twenty thousand keys of three rows: with a table for each key this took half a minute."""
    rng = random.Random(2)
    keys = [rows_of(rng, 3) for _ in range(20000)]
    start = time.process_time()
    assert all(_winners(rows) for rows in keys)
    assert time.process_time() - start < 3

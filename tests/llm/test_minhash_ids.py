"""Near-dedup where rows share an id, and on very long texts."""

import random

import numpy as np
import pytest

from millrace.llm import minhash

from .test_operators import brute_components, docs, frame, rows_of, texts  # noqa: F401


def near(words, rng, n):
    out = words[:]
    for _ in range(n):
        out[rng.randrange(len(out))] = f"n{rng.random()}"
    return out


def test_rows_that_share_an_id_keep_all_their_links(spark):
    rng = random.Random(3)
    a, b = ([f"{c}{rng.random()}" for _ in range(200)] for c in "ab")
    rows = [(1, a), (1, b), (2, near(a, rng, 2)), (3, near(b, rng, 2)), (4, a), (9, b), (9, [])]
    rows = [(i, " ".join(w), None, None) for i, w in rows] + [(5, "x y z", None, None), (5, None, None, None), (6, "", None, None), (None, " ".join(a), None, None), (None, None, None, None)]
    for _ in range(3):
        rng.shuffle(rows)
        got = minhash.near_duplicates(frame(spark, rows), 3, 85)
        assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows, 3, 85)


def test_keep_one_leaves_one_of_equal_rows_and_all_texts_of_an_id(spark):
    rows = [(1, "one two three four five six", "en", "a")] * 3 + [(1, "a very different text of its own", "en", "a"), (2, "one two three four five six", "en", "a"), (None, "one two three four five six", None, None), (None, "one two three four five six", None, None)]
    got = minhash.keep_one(frame(spark, rows))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, rows[0][1]), (1, rows[3][1]), (None, rows[0][1]), (None, rows[0][1])], key=repr)
    assert got.columns == frame(spark, rows).columns


@pytest.mark.parametrize("block, shingles, lot", [(2, 1 << 20, 2), (256, 300, 3)])
def test_small_blocks_and_lots_change_nothing(spark, monkeypatch, block, shingles, lot):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    monkeypatch.setattr(minhash, "PIVOT_LOT", lot)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        base = near(base, rng, 2) if i % 3 == 0 else base
        rows.append((i, " ".join(near(base, rng, i % 5)), None, None))
    assert rows_of(minhash.near_duplicates(frame(spark, rows), 3, 85), "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows, 3, 85)


def test_unlike_long_sets_share_no_coordinates():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 2**63, 400_000).astype(np.uint64)) for _ in range(4)]
    signs = [minhash.signature(s, 128) for s in sets]
    assert all((a == b).sum() <= 2 for n, a in enumerate(signs) for b in signs[:n])


def test_texts_of_a_million_words(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**9)}" for _ in range(1_000_000)]
    other = [f"v{rng.randrange(10**9)}" for _ in range(1_000_000)]
    rows = [(1, " ".join(words), None, None), (2, " ".join(near(words, rng, 30_000)), None, None), (3, " ".join(other), None, None), (4, " ".join(near(words, rng, 120_000)), None, None)]
    got = minhash.near_duplicates(frame(spark, rows), 3, 85)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows, 3, 85)

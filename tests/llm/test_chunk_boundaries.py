"""Chunk boundaries, fingerprints and containment against a walk byte by byte."""

import random

import xxhash

from millrace.llm import chunks


def plain_lengths(data):
    out, start = [], 0
    while start < len(data):
        end = min(start + chunks.MOST, len(data))
        for at in range(start + chunks.LEAST - 1, end - 1):
            h = sum(int(chunks.GEAR[data[at - j]]) << j for j in range(min(at + 1, 32))) % 2**32
            if h & int(chunks.STRICT if at < start + chunks.WANTED - 1 else chunks.LAX) == 0 and h & int(chunks.LAX) == 0:
                end = at + 1
                break
        out.append(end - start)
        start = end
    return out


def test_boundaries_and_containment():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh é\n") for _ in range(n)) for n in (0, 1, 15, 16, 17, 300, 4000)] + ["a" * 2000, "日本" * 400]
    prints = []
    for t in texts:
        data, at, parts = t.encode(), 0, {}
        assert chunks.chunk_lengths(data) == plain_lengths(data)
        for n in plain_lengths(data):
            parts[xxhash.xxh3_64_hexdigest(data[at : at + n])[:12]] = n
            at += n
        assert chunks.fingerprint(t) == parts
        prints.append(parts)
    for a in prints:
        for b in prints:
            want = float(not a and not b) if not a or not b else sum(n for d, n in a.items() if d in b) / sum(a.values())
            assert chunks.containment(a, b) == want


def test_rows_that_share_an_id(spark):
    from .test_operators import frame

    rng = random.Random(6)
    rows = [(7, f"text {rng.random()} " * 9, None, None) for _ in range(120)] + [(None, f"none {i} " * 5, None, None) for i in range(60)] + [(i, "x" * i, None, None) for i in range(100, 130)]
    d = frame(spark, rows)
    small, whole = (sorted(map(tuple, chunks.neighbour_fingerprints(d, rows_per_range=per).collect()), key=repr) for per in (10, 10_000))
    assert small == whole and len(whole) == len(rows)
    texts = sorted(t for _, t, *_ in rows)
    assert sorted(r[1] for r in whole) == sorted(map(len, texts))


def test_a_key_that_is_not_a_whole_number(spark):
    import pytest

    with pytest.raises(TypeError, match="not a whole number"):
        chunks.neighbour_fingerprints(spark.createDataFrame([("a", "b")], "doc_id string, text string"))

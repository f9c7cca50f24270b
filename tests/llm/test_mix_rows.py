"""The mix takes rows as its report says, with null and repeated keys and any extra columns."""

import random
from collections import Counter

from millrace.llm import mixing

SCHEMA = "doc_id long, text string, source string, k int, times int, place long, at string, row long"


def rows_for(rng, n=120):
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 5, 30]))) for _ in range(12)] + ["", None]
    return [(rng.choice([None, None, 1, 2, *range(100, 140)]), rng.choice(texts), rng.choice(["a", "a", "b", None]), i, 2 * i, -i, f"x{i}", i) for i in range(n)]


def test_copies_are_those_of_the_report(spark):
    for seed in range(3):
        rows = rows_for(random.Random(seed))
        docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
        # as (key, size, source size): how many rows of it were taken how often
        want = Counter()
        for r in mixing.mix_report(docs, rows_per_bin=7).collect():
            if r["taken"]:
                want[r["doc_id"], r["size"], r["source_size"]] += r["taken"] // r["size"]
        mixed = mixing.mix(docs, rows_per_bin=7)
        assert mixed.columns == docs.columns
        sizes = Counter()
        for _, t, s, *_ in rows:
            sizes[s] += len((t or "").split())
        got = Counter((r["doc_id"], len(r["text"].split()), sizes[r["source"]]) for r in mixed.collect())
        assert got == want
        assert max(Counter(r["row"] for r in mixed.collect()).values()) <= mixing.MOST_EPOCHS
        assert {tuple(r) for r in mixed.collect()} <= set(rows)


def test_a_source_of_equal_rows(spark):
    rows = [(None, "one two three", "a", i, i, i, "x", i) for i in range(50)] + [(i, "four five", "b", i, i, i, "x", i) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = sum(r["taken"] for r in mixing.mix_report(docs).collect() if r["doc_id"] is None)
    mixed = mixing.mix(docs, rows_per_bin=8).filter("source = 'a'").collect()
    assert 3 * len(mixed) == taken
    per = Counter(r["row"] for r in mixed)
    assert max(per.values()) - min(per.get(i, 0) for i in range(50)) <= 1

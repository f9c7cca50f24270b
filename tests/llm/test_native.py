"""Mixing and sharding against plain Python, on hot ids, low weights and small ranges."""

import hashlib
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import mixing, sharding

from .test_operators import empty, frame, rows_of  # noqa: F401


def uniform(*parts):
    return (int(hashlib.md5("|".join("~" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def plain_shard(i, tree):
    def least(names):
        return min((-math.log(uniform(i, n)) / w, k) for k, (n, w) in enumerate(names) if w > 0)[1]

    r = least([(f"root.{r}", sum(map(sum, x))) for r, x in enumerate(tree)])
    k = least([(f"{r}.{k}", sum(x)) for k, x in enumerate(tree[r])])
    s = least([(f"{r}.{k}.{j}", w) for j, w in enumerate(tree[r][k])])
    return sum(len(x) for y in tree[:r] for x in y) + sum(len(x) for x in tree[r][:k]) + s


def test_shards_are_those_of_a_plain_descent(spark):
    ids = [*range(600), None]
    rows = [(i, f"text {i}", None, None) for i in ids]
    odd = [[[1.0, 0.0, 2.5], [0.5]], [[1.0]], [[3.0, 1.0], [1.0, 1.0]]]
    for tree in (sharding.tree_of(24), odd):
        got = {r.doc_id: r for r in sharding.shard_report(frame(spark, rows), tree).collect()}
        assert all(got[i].shard == plain_shard(i, tree) and got[i].grown_shard == plain_shard(i, sharding.grown(tree)) for i in ids)
        direct = spark.createDataFrame([(i,) for i in ids], "id long").select("id", sharding.shard_of(F.col("id"), tree).alias("s")).collect()
        assert all(r.s == got[r.id].shard for r in direct)


def test_slots_of_repeated_and_missing_ids(spark):
    rows = [(7, f"t{i % 40}", None, None) for i in range(300)] + [(None, None, None, None)] * 200 + [(i, "x", None, None) for i in range(100)]
    got = sharding.shard_report(frame(spark, rows), rows_per_run=20).collect()
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 600 and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert rows_of(sharding.shard_report(frame(spark, rows[::-1])), "doc_id", "text_crc32", "shard", "slot") == sorted(((r.doc_id, r.text_crc32, r.shard, r.slot) for r in got), key=repr)


def plain_mix(rows):
    """(id, size, taken) from sorted draws, one source after the other."""
    def weight(t, n):
        return max(0.05, 1.0 - sum(c in "#*$%&|<>" for c in t) / (n + 1))

    size = Counter()
    for _, t, _, s in rows:
        size[s] += len((t or "").split())
    names = sorted((x for x in size if x is not None)) + ([None] if None in size else [])
    w = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        level = (sum(size.values()) - sum(target.values())) / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 3 * size[s]}
        target |= {s: 3 * size[s] for s in over} if over else {s: level * w[s] for s in free}
        free -= over or free
    out = []
    for s in names:
        mine = sorted((-math.log(uniform("mix", i)) / weight(t or "", len((t or "").split())), i, len((t or "").split())) for i, t, _, x in rows if x == s)
        epochs = int(target[s] // size[s]) if size[s] else 0
        budget, before = target[s] - epochs * size[s], 0
        for _, i, n in mine:
            out.append((i, n, n * (epochs + (before < budget and (budget - before) * 2 >= n))))
            before += n
    return sorted(out)


def test_mixing_equals_a_plain_sort(spark):
    """Low weights: most draws lie far out, and the budgets end there."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["word", "####", "$$$$ ####"]) for _ in range(rng.randint(0, 30))) or None, None, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(700)]
    for per in (7, 20_000):
        assert rows_of(mixing.mix_report(frame(spark, rows), rows_per_bin=per), "doc_id", "size", "taken") == sorted(plain_mix(rows), key=repr)


def test_many_sources(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 9), None, f"s{rng.randrange(150)}") for i in range(600)]
    assert rows_of(mixing.mix_report(frame(spark, rows), rows_per_bin=50), "doc_id", "size", "taken") == sorted(plain_mix(rows), key=repr)


def test_rows_that_share_an_id_in_a_mix(spark):
    rows = [(7, "one two " * (i % 9), None, "a") for i in range(400)] + [(i, "three four", None, "b") for i in range(50)]
    got = mixing.mix_report(frame(spark, rows), rows_per_bin=30).collect()
    assert len(got) == 450 and sorted(r["size"] for r in got) == sorted(len(t.split()) for _, t, *_ in rows)
    taken, target = sum(r.taken for r in got if r.doc_id == 7 and r.source_size > 100), {r.target for r in got if r.source_size > 100}
    assert abs(taken - min(target)) <= 20
    again = mixing.mix_report(frame(spark, rows[::-1]), rows_per_bin=20_000)
    assert sorted((r["size"], r.taken) for r in got) == sorted((r["size"], r.taken) for r in again.collect())

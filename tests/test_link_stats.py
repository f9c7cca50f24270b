"""Counts of offers and skills by level, against plain Python."""

import random

from millrace.operators import package


def plain(rows, level):
    rows = [r for r in rows if level is all or r[2] == level]
    pairs = {(i, g, s) for i, skills, g in rows for s in skills or [] if s is not None}
    return len({i for i, *_ in rows if i is not None}), len({i for i, _, s in pairs if i is not None}), len(pairs), len({s for *_, s in pairs})


def test_each_level_and_all(spark):
    rng = random.Random(3)
    skills = lambda: rng.choice([None, [], [rng.randrange(9), None], [rng.randrange(9) for _ in range(rng.randrange(6))]])
    rows = [(i if i % 11 else None, skills(), rng.choice(["a", "b", None])) for i in range(60)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "id int, skills array<int>, g string")
    want = sorted([("", *plain(rows, all))] + [(g or "", *plain(rows, g)) for g in {g for *_, g in rows}])
    assert sorted((r.g or "", *r[1:]) for r in package.skill_stats(df, group="g").collect()) == want
    assert [tuple(r) for r in package.skill_stats(df).collect()] == [plain(rows, all)]
    assert [tuple(r) for r in package.skill_stats(df.limit(0)).collect()] == [(0, 0, 0, 0)]


def test_tasks_are_sized_by_rows(spark):
    """Before, tasks were as many as bytes called for, and their memory grew with the ids that these held."""
    links = spark.range(4000).selectExpr("id DIV 4 AS k", "id % 7 AS s", "CAST(id DIV 4 % 3 AS STRING) AS g")
    stats = package.link_stats(links, "k", "s", "g", rows_per_task=100)
    assert "hashpartitioning(__key#" in (plan := stats._jdf.queryExecution().executedPlan().toString()) and ", 40)" in plan
    assert {(r.g, r.offers, r.links) for r in stats.collect()} == {(None, 1000, 4000), ("0", 334, 1336), ("1", 333, 1332), ("2", 333, 1332)}

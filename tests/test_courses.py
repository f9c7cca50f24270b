"""Courses of an offer's occupations, left out where they are linked, without moving a pair."""

import random

from pyspark.sql import functions as F

from millrace.operators import pairs, training


def sides(spark):
    rng = random.Random(3)
    courses = spark.createDataFrame([(i, f"t{rng.randrange(4)}") for i in range(60)] + [(60, None)], "course int, kind string")
    links = spark.createDataFrame([(rng.randrange(12), rng.randrange(66)) for _ in range(150)], "offer int, course int")
    own = links.filter("offer < 10").join(courses, "course").select("offer", "kind").distinct()
    return links, own, courses


def test_same_rows_as_all_pairs(spark):
    links, own, courses = sides(spark)
    want = training.courses_for_offer(links, own.join(courses, "kind"))
    rows = lambda df: sorted(map(tuple, df.select("offer", "course", "via").collect()))
    assert rows(training.courses_of_occupations(links, own, courses, "kind")) == rows(want)


def test_pairs_are_not_moved(spark):
    """Before, pairs were shuffled to meet the links by offer and course."""
    plan = training.courses_of_occupations(*sides(spark), "kind").filter(F.col("via") == "occupation")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "Aggregate" not in plan.split("Join")[0], plan


def test_a_cell_gets_its_own_links(spark):
    """Before, an offer brought all its links of a hot occupation to each cell, so what was shuffled grew with the square."""
    a = spark.range(3).selectExpr("id AS offer", "'hot' AS kind").withColumn("linked", F.sequence(F.lit(0), F.lit(39)))
    b = spark.range(50).selectExpr("id AS course", "'hot' AS kind")
    met = pairs.meet(a, b, "kind", "offer", "course", side=5, pairs=10, partners="linked")
    got = met.withColumn("is_linked", F.array_contains(F.col("linked").cast("array<bigint>"), F.col("course"))).collect()
    assert sorted((r.offer, r.course, r.is_linked) for r in got) == [(i, j, j < 40) for i in range(3) for j in range(50)]
    assert max(len(r.linked) for r in got) < 20 and {len(r.linked) for r in pairs.meet(a, b, "kind", "offer", "course", side=5, pairs=10).collect()} == {40}

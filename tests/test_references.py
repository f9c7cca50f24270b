"""Offers matched by their title, without making the pairs of a title."""

from pyspark.sql import functions as F

from millrace.plans import queries  # noqa: F401  (registers the others)
from millrace.plans.class_queries import _decisions


def test_a_frequent_title_makes_no_pairs(spark):
    """Before, each incoming offer met every known one with its title."""
    side = lambda name, n: spark.range(n).select(F.concat(F.lit(name), "id").alias("id"), F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"), F.concat(F.lit("m"), F.col("id") % 5).alias("code"))
    a, b = side("a", 40), side("b", 60)
    x, y = a.collect(), b.collect()
    first = {r.id: min((k.id, k.code) for k in y if k.title == r.title) for r in x if r.title and any(k.title == r.title for k in y)}
    got = _decisions(a, b)
    assert {(r.id, r.best_id, r.best_code) for r in got.collect()} == {(i, *v) for i, v in first.items()} and len(first) == 26
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [title" in plan.split("Join")[-1]

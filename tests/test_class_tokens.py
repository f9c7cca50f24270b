"""Tokens of offers and profiles meet without comparing each of an offer's tokens with all of its others."""

from millrace.operators import occupation
from millrace.plans import queries
from tests.test_operators import offer_tables  # noqa: F401

OFFER = "id string, title string, title_tokens array<string>, skill_tokens array<string>, description_tokens array<string>"
PROFILE = "code string, title_tokens array<string>, skill_tokens array<string>, description_tokens array<string>, exact_titles array<string>"


def test_tokens_are_distinct_before_they_are_tagged(spark):
    """Before, the tagged tokens of all fields were compared each with each, which is quadratic in the words of a text."""
    offers = spark.createDataFrame([("1", "x y", ["x", "y"], ["x", "x"], ["x", "z", "z"])], OFFER)
    profile = spark.createDataFrame([("c", ["x", "x"], ["x"], ["z", "z"], ["x y"])], PROFILE)
    scores = occupation.class_scores(offers, profile)
    assert [(r.title_score, r.skill_score, round(r.description_score, 4), r.exact) for r in scores.collect()] == [(50.0, 50.0, 33.3333, 1)]
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct(concat" not in plan and "array_distinct(" in plan


def test_classifier_makes_no_keys_of_matching(spark, offer_tables):  # noqa: F811
    """Before, all of an offer's matching keys and both its texts were made and written for it."""
    for side in queries._scored_sides(spark, offer_tables[0]):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert "sha2(" not in plan and "normalize" not in plan and plan.count("ArrowEvalPython") == 1, plan


def test_profile_values_are_made_once(spark, monkeypatch):
    """Before, each configuration counted the words of all known offers anew."""
    known = spark.createDataFrame([(str(i), f"c{i % 3}", f"t{i % 5}", [f"t{i % 5}"], ["s"], [f"w{i % 4}", "w"]) for i in range(30)], "id string, code string, title string, title_tokens array<string>, skill_tokens array<string>, description_tokens array<string>")
    labels = known.select("code").distinct().selectExpr("code", "array('w') AS tokens", "array(code) AS exact")
    refs = spark.createDataFrame([(f"{i}", f"c{i % 3}", None) for i in range(9)], "id string, code string, known_id string")
    made, real = [], occupation.profile_values
    monkeypatch.setattr(occupation, "profile_values", lambda *a: made.append(1) or real(*a))
    summary, _ = occupation.benchmark(known, known, labels, refs, "seed")
    assert {r.config: r.n for r in summary.collect()} == {"BASELINE": 9, "V1_A": 9, "V1_B": 9} and len(made) == 1

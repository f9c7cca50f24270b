"""The cascade's order: shared features, rejections among what is left."""

import time

from millrace.llm import quality
from millrace.llm.quality import Rule, cascade_order

from .test_operators import docs, empty, frame, rows_of, texts  # noqa: F401


def entry(rule, seconds, documents, features):
    return {"rule": rule, "seconds": seconds, "rejected": len(documents), "seen": 10, "documents": frozenset(documents), "features": features}


def rules(*names):
    return tuple(Rule(n, lambda d: False) for n in names)


def test_a_paid_feature_makes_a_rule_cheap():
    a, b = entry("a", 0.01, range(4), {"words": 1.0}), entry("b", 0.01, range(4, 7), {"words": 1.0, "n_words": 0.01})
    c = entry("c", 0.3, range(7, 9), {})
    assert [r.name for r in cascade_order([a, b, c], rules("a", "b", "c"))] == ["c", "a", "b"]
    assert [r.name for r in cascade_order([a, b, c], rules("a", "b", "c"), paid=("words",))] == ["a", "b", "c"]


def test_a_rule_counts_what_the_others_left():
    a, b, c = entry("a", 0.10, range(6), {}), entry("b", 0.11, range(5), {}), entry("c", 0.5, {8}, {})
    order = [r.name for r in cascade_order([c, b, a], rules("c", "b", "a"))]
    assert order[0] == "a" and order.index("c") < 3
    # b rejects nothing that a leaves, so a dearer rule with a rejection of its own comes before it
    b = entry("b", 0.4, range(5), {})
    assert [r.name for r in cascade_order([c, b, a], rules("c", "b", "a"))] == ["a", "c", "b"]


def test_the_sample_times_features_once(spark):
    slow = Rule("slow", lambda d: time.sleep(0.002) or False, ("n_words",))
    quick = Rule("quick", lambda d: d.n_words < 3, ("n_words",))
    d = frame(spark, [(i, "w " * (i % 6), None, None) for i in range(60)])
    got = {e["rule"]: e for e in quality.estimate(d, (slow, quick))}
    assert got["slow"]["seconds"] > 0.1 > got["quick"]["seconds"] and got["quick"]["rejected"] == 30 and len(got["quick"]["documents"]) == 30
    assert set(got["quick"]["features"]) == {"words", "n_words"}
    assert [r.name for r in cascade_order(list(got.values()), (slow, quick))] == ["quick", "slow"]


def test_every_order_gives_the_same_rows(docs, empty):  # noqa: F811
    want = rows_of(quality.quality_filter(docs), "doc_id")
    for r in (quality.RULES[::-1], quality.RULES[3:] + quality.RULES[:3]):
        assert rows_of(quality.quality_filter(docs, r), "doc_id") == want
    assert quality.estimate(empty)[0]["seen"] == 0 and quality.cascade_order(quality.estimate(empty)) == quality.RULES

"""The chain company, geography, title, against every pair of both sides in plain Python."""

import random

from pyspark.sql import functions as F

from millrace.functions import geo, text
from millrace.operators import matching
from millrace.sources.tables import table

SCHEMA = "id string, title string, description string, company string, postal_code string, locality string, occupation string"


def sides(spark, n=50):
    rng = random.Random(21)
    words, out = ["java", "data", "boulanger", "chef", "cloud", "xyz"], []
    for side in "ab":
        rows = [(f"{side}{i}", " ".join(rng.sample(words, rng.randrange(0, 3))), None, rng.choice([None, "acme", "acme", "acmes data", "acme data", "acme boulangerie fine", "zeta groupe", "zeta groupes"]), rng.choice([None, "75001", "75002", "69001", "97100", "97200"]), rng.choice([None, "Paris", "Lyon"]), None) for i in range(n)]
        out.append(table(matching.prepare(spark.createDataFrame(rows, SCHEMA), occupation="occupation")))
    return out


def test_stages_are_those_of_all_pairs(spark):
    a, b = sides(spark)
    x, y = (d.select(*[F.col(c).alias(f"{c}_{s}") for c in ("id", "company", "company_tokens", "title", "title_tokens", "postal_code", "locality")]) for d, s in ((a, "a"), (b, "b")))
    every = x.crossJoin(y).withColumn("place", geo.match_type(F.col("postal_code_a"), F.col("locality_a"), F.col("postal_code_b"), F.col("locality_b"))["type"])
    every = every.withColumn("fits", matching.company_match(F.col("company_a"), F.col("company_b"), text.sequence_ratio(F.col("company_a"), F.col("company_b")))["type"]).collect()
    want = {r.id: [0] * 4 for r in a.collect()}
    pairs = set()
    for r in every:
        if not r.company_a or not r.company_b or not (r.company_a == r.company_b or {*r.company_tokens_a} & {*r.company_tokens_b}):
            continue
        company = r.fits in matching.COMPATIBLE_COMPANIES
        place = company and r.place != "DIFFERENT"
        title = place and bool({*r.title_tokens_a} & {*r.title_tokens_b} or text.ratio(r.title_a, r.title_b) >= 0.30)
        want[r.id_a] = [n + k for n, k in zip(want[r.id_a], (1, company, place, title))]
        pairs |= {(r.id_a, r.id_b)} if title else set()
    chain, outcomes = matching.hybrid_outcomes(a, b)
    assert sorted((r.a, r.b) for r in chain.collect()) == sorted(pairs)
    assert {r.id: [r.before_company, r.after_company, r.after_place, r.after_title] for r in outcomes.collect()} == want
    assert all(any(w[k] > w[k + 1] for w in want.values()) for k in range(3))


def test_offers_found_without_pairs(spark):
    a, b = sides(spark, 30)
    only = tuple(x for x in matching.BLOCKS if x != "OCCUPATION_TITLE")
    for some in (only, ("EXACT_POSTAL_CODE",), ("RARE_TITLE_TOKENS", "COMPANY_MATCH")):
        want = matching.blocks(a, b, occupation_block=False).filter(F.col("block").isin(*some)).select("a").distinct()
        assert sorted(r.a for r in matching.found(a, b, some, "X").collect()) == sorted(r.a for r in want.collect())


def test_hybrid_pairs_are_not_moved(spark):
    """Before, every pair of the fallback was shuffled to unite its blocks."""
    a, b = sides(spark, 30)
    got = matching.hybrid_paired(a, b)
    rows = lambda df: sorted((r.a, r.b, *r.blocks) for r in df.collect())
    want = rows(matching.block_union(matching.hybrid(a, b)[0]))
    assert rows(got) == want
    assert {r[2:] for r in want} >= {("PRIMARY_CHAIN",)} and any("PRIMARY_CHAIN" in r and len(r) > 3 for r in want)
    company = {r.id: r.company for d in (a, b) for r in d.collect()}
    assert any("PRIMARY_CHAIN" in z and company[x] == "acme" and company[y] == "acme boulangerie fine" for x, y, *z in want)  # one name holds the other
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Join")[0] and plan.count("RepartitionByExpression") == 2

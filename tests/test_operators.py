"""The library's own operators on hand-made rows: normalisers, ladders, catalog, classes, packages, sources, sinks, streams."""

import datetime
import hashlib
import math
import os
import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from millrace.functions import geo, scores, text
from millrace.operators import analysis, assertions, catalog, matching, normalize, occupation, package, training, triage
from millrace.plans import analogs
from millrace.plans.queries import QUERIES
from millrace.sources import readers, writers
from millrace.streaming import ingest


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


@pytest.mark.parametrize(
    "kind, raw, want",
    [
        ("company", "L'Oréal & Cie SAS", "l oreal cie"), ("company", "Dupont  Groupe", "dupont"), ("company", None, ""), ("company", "Müller+Söhne SARL", "muller sohne"),
        ("locality", "Ville de Saint-Étienne CEDEX", "saint etienne"), ("title", "Développeur C++ / C# (H/F)", "developpeur cpp csharp"), ("title", "Back-end - Front end", "backend frontend"),
        ("title", "Chef de projet data/IA", "chef de projet data/ia"), ("description", "<p>Bonjour</p><p>l&eacute;quipe</p><script>x()</script>", "bonjour lequipe"), ("description", "a &lt;b&gt;c&lt;/b&gt;", "a c"),
    ],
)
def test_normalisers(kind, raw, want):
    assert text.normal(kind, raw) == want


def test_clean_and_html(spark):
    rows = [(" a  b&amp;c ", "<h1>T</h1>x<br>y<style>z</style>"), ("  ", None), (None, "")]
    got = values(spark, rows, "a string, b string", text.clean_text("a"), text.html_text("b"))
    assert got == [("a b&c", "T x y"), (None, None), (None, None)]


def test_tokens_and_keys(spark):
    got = values(spark, [("les data 123 pour ia devops data", " x y ")], "a string, b string", text.tokens(F.col("a")), text.compact(F.col("b")), text.blank_to_null(F.col("b")))
    assert got == [(["data", "devops"], "xy", "x y")]
    assert values(spark, [("a" * 200, "ab")], "a string, b string", F.length(text.excerpt(F.col("a"))), text.excerpt(F.col("b"))) == [(153, "ab")]


def test_sequence_ratio_is_the_asymmetric_one(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), ("abc", None)]
    assert values(spark, pairs, "a string, b string", text.sequence_ratio("a", "b")) == [(0.25,), (0.5,), (1.0,), (0.0,)]
    assert text.ratio("a" * 240, "a" * 220) == SequenceMatcher(None, "a" * 240, "a" * 220).ratio()


def test_rounding_of_exact_binary_values(spark):
    assert values(spark, [(2.675, 2), (0.5, 0), (1.5, 0), (None, 2)], "x double, d int", text.round_even("x", "d")) == [(2.67,), (0.0,), (2.0,), (None,)]


@pytest.mark.parametrize("said, role, n", [("Notre client recherche un dev. Cabinet de recrutement.", "RECRUITMENT_INTERMEDIARY", 2), ("chez le client", "POSSIBLE_INTERMEDIARY", 1), ("nous recrutons", "DIRECT_EMPLOYER", 0), ("  ", "UNKNOWN", 0), (None, "UNKNOWN", 0)])
def test_advertiser_role(spark, said, role, n):
    r = spark.createDataFrame([(said,)], "a string").select(text.advertiser_role(F.col("a")).alias("r")).first().r
    assert (r.role, len(r.evidence)) == (role, n)


@pytest.mark.parametrize(
    "links, id_, back, want",
    [
        (["https://www.example.org/job/1"], None, None, ("RAW_ABSOLUTE_URL", "https://www.example.org/job/1")), (["/job/2"], None, None, ("RELATIVE_HREF_RESOLVED", "https://example.org/job/2")),
        (["https://other.net/x"], "/job_postings/3", None, ("LEGACY_URL_REBUILT", None)), ([None], "/job_postings/3", None, ("LEGACY_URL_REBUILT", None)), ([], None, "/fallback", ("RELATIVE_HREF_RESOLVED", "https://example.org/fallback")), ([], None, None, ("URL_UNAVAILABLE", None)),
    ],
)
def test_url_ladder(links, id_, back, want):
    raw, full, method = text.resolve_url(links, id_, back, "https://example.org/", "example.org")
    assert (method, full) == want


def test_places(spark):
    codes = [("75001", "Île-de-France"), ("97100", "Guadeloupe"), ("98800", None), ("20000", None), (None, None), ("06000", "Provence-Alpes-Côte d'Azur")]
    got = values(spark, [(c,) for c, _ in codes], "pc string", geo.department(F.col("pc")), geo.region_of_postal(F.col("pc")))
    assert [d for d, _ in got] == ["75", "971", "988", "20", "", "06"]
    assert [r for _, r in got] == ["îledefrance", "guadeloupe", "regioninconnue", "regioninconnue", "regioninconnue", "provencealpescôtedazur"]
    m = [("75001", "a", "75001", "b"), ("75001", "a", "75002", "a"), ("75001", "a", "75002", "b"), ("75001", "a", "69001", "b"), ("", "a", "69001", "a")]
    assert [r[0].type for r in values(spark, m, "a string, b string, c string, d string", geo.match_type(*map(F.col, "abcd")))] == ["EXACT_POSTAL_CODE", "SAME_LOCALITY", "SAME_DEPARTMENT", "DIFFERENT", "UNKNOWN"]


def test_scores(spark):
    got = values(spark, [(["a", "b"], ["b", "c"], {"b": 3.0}), ([], [], {})], "x array<string>, y array<string>, m map<string,double>", scores.jaccard(F.col("x"), F.col("y")), scores.weighted_coverage(F.col("x"), F.col("y"), F.col("m")), scores.overlap_percent(F.col("x"), F.col("y")))
    assert got == [(1 / 3, 0.75, 50.0), (0.0, 0.0, 0.0)]
    assert values(spark, [(39.99,), (40.0,), (84.99,), (85.0,), (None,)], "s double", scores.score_bucket(F.col("s")), scores.band(F.col("s"), 10))[:4] == [("0-39", "30-39"), ("40-59", "40-49"), ("75-84", "80-89"), ("85-100", "80-89")]
    assert values(spark, [(2024, 3), (2024, 4), (2024, 12)], "y int, m int", scores.quarter(F.col("y"), F.col("m"))) == [("2024-T1",), ("2024-T2",), ("2024-T4",)]


def test_flow_history_arguments_and_totals(spark):
    f = spark.createDataFrame([("x", 2024, 1, 5, None, 1), ("x", 2024, 5, 7, 2, None), ("y", 2024, 1, 1, 1, 1), ("y", None, 1, 9, 9, 9)], "region string, year int, month int, entries int, partial int, total int")
    o = spark.createDataFrame([("x", 3), ("z", 4)], "region string, n long")
    got = {(r.level, r.region, r.quarter): (r.entries, r.partial, r.total, r.offers) for r in training.flow_history(f, o).collect()}
    assert got[("region", "x", None)] == (12, 2, 1, 3) and got[("region", "y", None)] == (1, 1, 1, 0) and got[("all", None, None)] == (13, 3, 2, 7) and ("region", "z", None) not in got
    assert {r.level for r in training.flow_history(f, region="x", region_keys=("x", "y")).collect()} == {"quarter", "region"}
    assert training.flow_history(f, double_entries=True).filter("level = 'all'").first().entries == 26
    for bad in ({"region": "regioninconnue"}, {"quarter_": "2024-T5"}, {"quarter_": "2024-T1x"}):
        with pytest.raises(ValueError):
            training.flow_history(f, **bad)


def test_courses(spark):
    c = spark.createDataFrame([("RNCP1", 2), ("-1", 3), (None, 4), ("RNCP2", 0)], "code_rncp string, entrees_formation int")
    clean = training.clean_courses(c)
    assert sorted(r.code_rncp or "" for r in clean.collect()) == ["", "1", "2"]
    o = spark.createDataFrame([("1", "M1"), ("1", "M2"), ("1", "A1"), ("2", "M3"), (None, "M4")], "code_rncp string, code_rome string")
    assert sorted(r.code_rome for r in training.join_occupations(clean, o).collect()) == ["M1", "M2"]
    assert sorted(r.code_rome for r in training.join_occupations(clean, o, null_safe=True).collect()) == ["M1", "M2", "M4"]
    m = spark.createDataFrame([("a", "x", 2), ("a", "y", 2), ("b", "z", 1)], "g string, v string, n int")
    assert {(r.g, r.v) for r in training.dominant(m, ["g"], "v", "n").collect()} == {("a", "x"), ("b", "z")}


OFFER = "id string, title string, description string, company string, postal_code string, locality string, occupation string"


def test_matching_strategies(spark):
    a = spark.createDataFrame([("1", "Développeur Python H/F", "Nous cherchons un développeur python confirmé", "Acme SAS", "75001", None, "M1"), ("2", "Boulanger", "Pain", None, None, None, None)], OFFER)
    b = spark.createDataFrame([("x", "Developpeur python", "nous cherchons un developpeur python confirme", "ACME", "75001", None, "M1"), ("y", "Comptable", "chiffres", "Zeta", "75002", None, "M2"), ("z", "Développeur java", "java", "Acmé Conseil", "69001", None, "M1")], OFFER)
    p, q = (matching.prepare(x, occupation="occupation").cache() for x in (a, b))
    pairs = {(r.a, r.b): r.blocks for r in matching.block_union(matching.blocks(p, q)).collect()}
    assert {"EXACT_FINGERPRINT", "COMPACT_TITLE_EXACT", "EXACT_POSTAL_CODE", "COMPANY_MATCH", "OCCUPATION_TITLE", "RARE_TITLE_TOKENS", "SAME_DEPARTMENT_TITLE"} == set(pairs[("1", "x")])
    best = {(r.a, r.rank): r for r in matching.match(p, q).collect()}
    top = best[("1", 1)]
    assert top.b == "x" and top.score == 100.0 and top.coverage == 100 and top.company_match.type == "EXACT_NORMALIZED" and top.geography.type == "EXACT_POSTAL_CODE"
    chain, stops = matching.cascade(p, q)
    assert {r.id: r.stop for r in stops.collect()} == {"1": "SUCCESS", "2": "COMPANY_MISSING"} and [(r.a, r.b) for r in chain.collect()] == [("1", "x")]
    _, reasons = matching.hybrid(p, q)
    assert {r.id: r.reason for r in reasons.collect()} == {"1": None, "2": "MISSING_PRIMARY_DATA"}


BASE = {"id": "1", "title": "dev", "description": "text", "excerpt": "text", "company": "acme", "postal_code": "75001", "locality": None, "score": 80.0, "second": 10.0, "max_score": 80.0, "margin": 70.0, "blocks": ["EXACT_POSTAL_CODE"], "company_type": "EXACT_NORMALIZED", "company_similarity": 1.0, "place_type": "EXACT_POSTAL_CODE", "title_ratio": 0.9, "title_jaccard": 0.9, "title_weighted": 0.9, "title_compact": 0.9, "description_jaccard": 0.3, "description_weighted": 0.5, "generic_title": False, "role": "DIRECT_EMPLOYER", "coverage": 95, "v1_error": None, "common_skills": False, "best_company": "b"}
CASE = "id string, title string, description string, excerpt string, company string, postal_code string, locality string, score double, second double, max_score double, margin double, blocks array<string>, company_type string, company_similarity double, place_type string, title_ratio double, title_jaccard double, title_weighted double, title_compact double, description_jaccard double, description_weighted double, generic_title boolean, role string, coverage int, v1_error string, common_skills boolean, best_company string"
FP = ["EXACT_FINGERPRINT"]


def test_ladders(spark):
    v1 = [
        ({"title": " "}, "MISSING_TITLE"), ({"description": None, "company": "", "postal_code": None}, "MISSING_DESC_AND_META"), ({"score": None}, "NO_CANDIDATE"), ({"blocks": FP}, "EXACT_FINGERPRINT"), ({"blocks": ["COMPACT_TITLE_EXACT"]}, "EXACT_TITLE_COMPANY_GEOGRAPHY"),
        ({"description_jaccard": 0.6}, "STRONG_TITLE_DESCRIPTION_COMPANY"), ({"title_ratio": 1.0}, "EXACT_TITLE_COMPANY_LOCALITY"), ({"score": 29.99}, "LOW_BEST_SCORE"), ({"score": 30.0}, "INTERMEDIATE_SCORE"), ({"margin": 4.99}, "AMBIGUOUS_SCORE_MARGIN"), ({"margin": 5.0}, "INTERMEDIATE_SCORE"),
    ]
    weak = {"company_type": "NO_MATCH", "title_ratio": 0.3, "description_weighted": 0.1}
    v2 = [
        ({"v1_error": "x"}, "V1_PROCESSING_ERROR"), ({"title": ""}, "MISSING_TITLE"), ({"blocks": FP}, "EXACT_FINGERPRINT"), ({"blocks": FP, "generic_title": True, "score": 45.0, "max_score": 45.0}, "INTERMEDIATE_SCORE"), ({}, "STRONG_SCORE_CONVERGENT_SIGNALS"), ({"score": 74.99}, "CREDIBLE_CANDIDATE_NEEDS_REVIEW"),
        ({"role": "RECRUITMENT_INTERMEDIARY", "score": 60.0, "company_type": "HIGH_SIMILARITY"}, "STRONG_MATCH_VIA_RECRUITMENT_INTERMEDIARY"), ({"coverage": 79, "score": 60.0}, "INSUFFICIENT_DATA"), ({"score": None, "second": None, "max_score": None}, "NO_CANDIDATE"), ({"score": 39.99, "max_score": 39.99}, "ALL_CANDIDATES_WEAK"),
        ({"score": 45.0, **weak}, "BEST_CANDIDATE_NOT_CREDIBLE"), ({"score": 60.0, "place_type": "DIFFERENT"}, "COMPANY_MATCH_GEO_DIFFERS"), ({"score": 60.0, "second": 55.01}, "MULTIPLE_CREDIBLE_CLOSE_CANDIDATES"), ({"score": 60.0, "second": 55.0}, "CREDIBLE_CANDIDATE_NEEDS_REVIEW"),
        ({"score": 45.0, "company_type": "NO_MATCH", "title_ratio": 0.6}, "INTERMEDIATE_SCORE_WITH_WEAK_SIGNALS"), ({"score": 55.0, "company_type": "NO_MATCH", "title_ratio": 0.6, "place_type": "DIFFERENT"}, "NO_CREDIBLE_CONVERGENCE"),
    ]
    rows = [{**BASE, "id": str(i), **change} for i, (change, _) in enumerate(v1 + v2)]
    got = {int(r.id): r for r in triage.decision_record(spark.createDataFrame([tuple(r[c.split()[0]] for c in CASE.split(", ")) for r in rows], CASE)).collect()}
    for i, (change, reason) in enumerate(v1 + v2):
        found = got[i].v1.reasons if i < len(v1) else got[i].v2.reasons
        assert reason in found, (i, change, found)
    assert {r.priority for r in got.values() if r.decision != "UNCERTAIN"} == {"HORS_REVUE"}


def test_catalog(spark):
    fields = ("a", "tags")
    s1 = spark.createDataFrame([(1, "x", ["p", "q"]), (2, "y", []), (3, "z", None), (4, "w", ["r"])], "id long, a string, tags array<string>")
    empty = spark.createDataFrame([], "id long, is_active boolean, first_seen_at string, last_seen_at string, inactive_since string, content_hash string, batch string, offer struct<a:string,tags:array<string>>")
    d1 = catalog.snapshot_diff(empty, s1, "id", fields, "t1", "b1")
    assert {r.change for r in d1.collect()} == {"NEW"}
    state = catalog.state_of(d1)
    assert {r.change for r in catalog.snapshot_diff(state, s1, "id", fields, "t2", "b2").collect()} == {"UNCHANGED"}
    s2 = spark.createDataFrame([(1, "x", ["q", "p"]), (2, "Y", []), (4, "w", ["r"])], s1.schema)
    d2 = catalog.snapshot_diff(state, s2, "id", fields, "t2", "b2")
    assert {r.id: r.change for r in d2.collect()} == {1: "UNCHANGED", 2: "UPDATED", 3: "INACTIVATED", 4: "UNCHANGED"}
    assert {r.id: r.changed_fields for r in catalog.change_log(d2, "id", "t2").collect()} == {2: ["a"], 3: None}
    d3 = catalog.snapshot_diff(catalog.state_of(d2), s1, "id", fields, "t3", "b3")
    got = {r.id: r for r in d3.collect()}
    assert got[3].change == "REACTIVATED" and got[3].content_changed_on_reactivation is False and got[3].first_seen_at == "t1" and got[3].inactive_since is None
    gone = catalog.snapshot_diff(catalog.state_of(d2), s2.limit(0), "id", fields, "t3", "b3")
    assert {r.id: r.change for r in gone.collect()} == {1: "INACTIVATED", 2: "INACTIVATED", 3: None, 4: "INACTIVATED"}
    assert catalog.diff_counts(d2).first().ok and catalog.incoherent_rows(catalog.state_of(d2), "id", fields).count() == 0
    spoiled = catalog.state_of(d2).withColumn("content_hash", F.lit("0"))
    assert catalog.incoherent_rows(spoiled, "id", fields).count() == 4


def test_hash_is_that_of_canonical_json(spark):
    import hashlib
    import json

    row = (1, "é\"\\", ["b", "a", None], None, 2.5)
    df = spark.createDataFrame([row], "id long, s string, l array<string>, n string, x double")
    items = sorted((json.dumps(v, ensure_ascii=False) for v in row[2]))
    want = '{"business_projection":{"l":[' + ",".join(items) + '],"n":null,"s":' + json.dumps(row[1], ensure_ascii=False) + ',"x":2.5},"content_hash_version":"v1"}'
    assert df.select(catalog.content_hash(df, ("s", "l", "n", "x"))).first()[0] == hashlib.sha256(want.encode()).hexdigest()


@pytest.mark.parametrize("changes, why", [({}, []), ({"status": "RUNNING"}, ["status"]), ({"failed": 1}, ["pages_failed"]), ({"succeeded": 2}, ["pages"]), ({"failed_pages": None}, ["failed_pages"]), ({"next_url": "x"}, ["next_page_url"])])
def test_gate(changes, why):
    assert catalog.gate(**{"status": "COMPLETED", "failed": 0, "requested": 3, "succeeded": 3, "failed_pages": [], "next_url": None, **changes}) == why


def fold_payloads(rows):
    kept = {}
    for k, u, o, p in sorted(rows, key=lambda r: r[2]):
        if not (k in kept and kept[k][0] and u and kept[k][0] > u):
            kept[k] = (u, p)
    return {k: p for k, (_, p) in kept.items()}


def test_payloads_equal_the_fold(spark):
    import random

    rng = random.Random(1)
    rows = [(rng.randrange(8), rng.choice(["", None, "2024-01", "2024-02", "2024-03"]), i, f"p{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "k int, u string, o int, p string")
    assert {r.k: r.p for r in catalog.dedupe_payloads(df, "k", "p", "u", "o").collect()} == fold_payloads(rows)


def test_occupations(spark):
    known = spark.createDataFrame([(str(i), c, t, t.split(), [], t.split()) for i, (c, t) in enumerate([("M1", "developpeur python"), ("M1", "developpeur java"), ("M2", "comptable senior"), ("M2", "comptable paie")])], "id string, code string, title string, title_tokens array<string>, skill_tokens array<string>, description_tokens array<string>")
    labels = spark.createDataFrame([("M1", ["informatique"], ["developpeur"]), ("M2", ["compta"], []), ("M9", ["rien"], [])], "code string, tokens array<string>, exact array<string>")
    p = occupation.profiles(known, labels)
    assert {r.code: r.title_tokens for r in p.collect()} == {"M1": ["developpeur", "informatique", "java", "python"], "M2": ["compta", "comptable", "paie", "senior"]}
    offers = spark.createDataFrame([("a", "developpeur python", ["developpeur", "python"], [], []), ("b", "chef comptable", ["chef", "comptable"], [], [])], "id string, title string, title_tokens array<string>, skill_tokens array<string>, description_tokens array<string>")
    s = occupation.class_scores(offers, p, occupation.V1_A)
    assert {(r.id, r.code): r.score for r in s.collect()} == {("a", "M1"): 73.0, ("b", "M2"): 32.5}
    best = {r.id: r for r in occupation.best_class(s).collect()}
    assert best["a"].margin == 73.0 and best["a"].second == 0 and best["b"].discriminant
    cases = [("x", False, 90.0, 50.0, True, "CONFIRMED_FROM_MATCH"), (None, True, 90.0, 50.0, True, "INSUFFICIENT"), (None, False, 59.99, 50.0, True, "INSUFFICIENT"), (None, False, 60.0, 5.0, False, "INSUFFICIENT"), (None, False, 60.0, 4.99, True, "AMBIGUOUS"), (None, False, 60.0, 5.0, True, "AUTO_ASSIGNED")]
    got = values(spark, [c[:5] for c in cases], "matched_code string, generic_title boolean, score double, margin double, discriminant boolean", occupation.assignment()["status"])
    assert [g for g, in got] == [c[5] for c in cases]


@pytest.fixture(scope="module")
def offer_tables(spark, tmp_path_factory):
    """documents, lineitem and part of 80 offers with few words, so that tokens are common to many classes."""
    rng, d = random.Random(3), str(tmp_path_factory.mktemp("offers"))
    words = [f"{a}{b}" for a in ("bo", "ca", "du", "fe", "gi", "lo") for b in ("ran", "sel", "tix", "vom")] + ["avec", "les", "plus", "42"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 10))) + "\n" + " ".join(rng.choice(words[i % 6 : i % 6 + 14]) + rng.choice(["", str(i * 7 % 9 % 4)]) for _ in range(30)) for i in range(80)]
    texts[45] = texts[5] = "boran casel dutix\nlo"
    docs = [(i, x, "fr", f"s{i * 7 % 9}") for i, x in enumerate(texts)]
    parts = [(k, f"{rng.choice(words)} {rng.choice(words)}{k}") for k in range(30)]
    lines = [(rng.randrange(90), rng.randrange(30)) for _ in range(200)]
    for name, rows, ddl in [("documents", docs, "doc_id long, text string, lang string, source string"), ("part", parts, "p_partkey long, p_name string"), ("lineitem", lines, "l_orderkey long, l_partkey long")]:
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d, docs, parts, lines


def test_occupation_scores_over_all_fields(spark, offer_tables):
    d, docs, parts, lines = offer_tables
    tok = lambda kind, s: {w for w in text.normal(kind, s).split() if len(w) >= 3 and not w.isdigit() and w not in text.CLASSIFIER_STOP_WORDS}
    names, skills = dict(parts), {}
    for o, k in set(lines):
        skills.setdefault(o, []).append(tok("description", names[k]))
    offer = {i: (f"{lang}-{s}", tok("title", " ".join(x.split("\n")[0].split(" ")[:8])), skills.get(i, []), tok("description", x)) for i, x, lang, s in docs}
    known = {i: o for i, o in offer.items() if i // 20 % 2}
    top = lambda counts, k: {v for v, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]}
    profile = {}
    for code in {o[0] for o in known.values()}:
        own = [o for o in known.values() if o[0] == code]
        titles = top(Counter(" ".join(sorted(o[1])) for o in own if o[1]), 80)
        base = {"fr"} | {w for x in titles for w in x.split()}
        profile[code] = [base, base | top(Counter(w for o in own for s in o[2] for w in s), 80), base | top(Counter(w for o in own for w in o[3]), 160), titles | {code}]
    often = [{w for w, n in Counter(w for p in profile.values() for w in p[f]).items() if n > max(2, int(len(profile) * 0.35))} for f in range(3)]
    assert all(often)
    want, parts_used = {}, set()
    for i, (_, title, sk, described) in offer.items():
        if i in known:
            continue
        fields = (title, set().union(*sk), described)
        for code, p in profile.items():
            hits = [round(100.0 * len(q & (p[f] - often[f])) / len(q), 4) if q else 0.0 for f, q in enumerate(fields)]
            exact = " ".join(sorted(title)) in p[3]
            if any(hits) or exact:
                parts_used |= {f for f in range(3) if hits[f]}
                want[str(i), code] = round((hits[0] * 65 + hits[1] * 10 + hits[2] * 25) / 100 + 8 * exact, 4)
    assert parts_used == {0, 1, 2}
    got = {(r.id, r.code): r.score for r in QUERIES["occupation_scores"](spark, d).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-4) for k in want)
    best = {r.id: (r.code, r.score) for r in QUERIES["occupation_assign"](spark, d).collect()}
    for i in {i for i, _ in want}:
        assert best[i] == min(((c, s) for (j, c), s in got.items() if j == i), key=lambda x: (-x[1], x[0]))


def test_text_queries_read_whole_texts(spark, offer_tables):
    d, docs, *_ = offer_tables
    tok = {str(i): sorted({w for w in text.normal("description", x).split() if len(w) >= 3 and not w.isdigit() and w not in text.STOP_WORDS}) for i, x, *_ in docs}
    rows = lambda name: {tuple(r) for r in QUERIES[name](spark, d).collect()}
    a, b = ([i for i in tok if int(i) // 20 % 2 == s] for s in (0, 1))
    df = Counter(w for i in b for w in tok[i])
    assert rows("text_tokens_per_doc") == {(i, " ".join(w)) for i, w in tok.items()} and max(map(len, tok.values())) > 8
    assert rows("text_token_df") == set(df.items())
    assert {(w, n, round(x, 6)) for w, n, x in rows("text_token_idf")} == {(w, n, round(math.log((len(b) + 1) / (n + 1)) + 1, 6)) for w, n in df.items()}
    assert rows("text_rare_tokens") == {(i, w) for i in a for w in sorted((w for w in tok[i] if w in df), key=lambda w: (df[w], w))[:3]}
    assert rows("text_compact_key") == {(str(i), "".join(text.normal("description", x).split())) for i, x, *_ in docs}
    blocks = {(r.a, r.b): r.blocks.split(",") for r in QUERIES["text_block_union"](spark, d).collect()}
    key = {str(i): (text.normal("title", " ".join(x.split("\n")[0].split(" ")[:8])), s, str(1000 + i // 40 * 37), text.normal("description", x)) for i, x, _, s in docs}
    same = lambda x, y: x[0] == y[0] and (x[1] == y[1] or x[2] == y[2] or x[3] == y[3])
    assert {p for p, k in blocks.items() if "EXACT_FINGERPRINT" in k} == {(i, j) for i in a for j in b if same(key[i], key[j])}
    assert rows("text_block_counts") == set(Counter(k for ks in blocks.values() for k in ks).items())
    assert {(i, j): round(v, 6) for i, j, v in rows("text_jaccard")} == {(i, j): round(len({*tok[i]} & {*tok[j]}) / len({*tok[i]} | {*tok[j]}), 6) for i, j in blocks}


def test_hybrid_pairs_have_the_fallback_blocks(spark, offer_tables):
    d, docs, *_ = offer_tables
    got = {(r.a, r.b): set(r.blocks.split(",")) for r in QUERIES["hybrid_pairs"](spark, d).collect()}
    every = {(r.a, r.b): set(r.blocks.split(",")) for r in QUERIES["text_block_union"](spark, d).collect()}
    reasons = {r.id: r.reason for r in matching.hybrid(*analogs.prepared(spark, d))[1].collect()}
    side = {i: str(i) for i, *_ in docs if i // 20 % 2 == 0}
    assert set(reasons) == set(side.values()) and any(reasons.values())
    # rare tokens and the rest come by the same keys; the occupation block isn't one of the fallback's
    fallback = {(p, k) for p, ks in got.items() for k in ks if k.startswith("FALLBACK_")}
    assert fallback == {(p, f"FALLBACK_{k}") for p, ks in every.items() if reasons[p[0]] for k in ks - {"OCCUPATION_TITLE"}} and fallback
    company = {str(i): s for i, _, _, s in docs}
    chain = {p for p, ks in got.items() if "PRIMARY_CHAIN" in ks}
    assert all(ks <= {"PRIMARY_CHAIN"} or reasons[p[0]] for p, ks in got.items()) and all(company[i] == company[j] or SequenceMatcher(None, company[i], company[j]).ratio() >= 0.8 for i, j in chain)


def test_courses_come_by_all_occupations(spark, tmp_path):
    part = [(1, "x", 1), (2, "x", 5), (3, "y", 7), (4, "y", 9), (5, "z", 1)]
    spark.createDataFrame(part, "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(10, 1), (10, 3), (10, 3), (11, 4)], "l_suppkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = lambda name: {tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert rows("formations_for_offer_all") == {(10, 1, "link"), (10, 3, "link"), (11, 4, "link"), (10, 2, "occupation"), (10, 4, "occupation"), (11, 3, "occupation")}
    assert rows("formations_for_offer_by_occupation") == {(10, "x", 2, 1), (10, "y", 2, 1), (11, "y", 2, 1)}


def test_split_balances_small_classes(spark):
    refs = spark.createDataFrame([(i, "big") for i in range(10)] + [(100 + i, f"s{i}") for i in range(9)], "id long, code string")
    got = occupation.split(refs, "seed").collect()
    assert len(got) == 19 and sum(r.part == "calibration" for r in got if r.code == "big") == 7
    c, v, parts = 7, 3, []
    for _ in range(9):
        to = "calibration" if c <= 2 * v else "validation"
        c, v = c + (to == "calibration"), v + (to == "validation")
        parts.append(to)
    assert [r.part for r in sorted((r for r in got if r.code != "big"), key=lambda r: r.code)] == parts


def test_thresholds(spark):
    best = spark.createDataFrame([("a", "a", 80.0, 30.0)] * 6 + [("a", "b", 55.0, 30.0)] * 3, "code string, truth string, score double, margin double")
    grid = occupation.threshold_grid(best)
    assert grid.count() == 42 and tuple(occupation.select_threshold(grid).first()) == (60, 5)
    assert tuple(occupation.select_threshold(occupation.threshold_grid(best.limit(2))).first()) == (100, 100)


ACTIONS = [("NEW", "NOT_FOUND", "NO_MANUAL_REVIEW", "CREATE"), ("UPDATED", "UNCERTAIN", "REVIEW_NOW", "UPDATE"), ("REACTIVATED", "NOT_FOUND", "NO_MANUAL_REVIEW", "REACTIVATE"), ("NEW", "PRESENT", "NO_MANUAL_REVIEW", "ENRICH_EXISTING"), ("NEW", "UNCERTAIN", "DEFER_DATA_INCOMPLETE", "DEFER"), ("NEW", "PROCESSING_ERROR", "NO_MANUAL_REVIEW", "REJECT"), ("INACTIVATED", None, None, "DEACTIVATE"), ("UNCHANGED", None, None, "NO_ACTION")]


def test_actions(spark):
    got = values(spark, [a[:3] for a in ACTIONS], "change string, decision string, action string", package.action())
    assert [g for g, in got] == [a[3] for a in ACTIONS]
    with pytest.raises(Exception, match="no action for"):
        values(spark, [("OTHER", "NOT_FOUND", "x")], "change string, decision string, action string", package.action())


def test_assertions(spark):
    df = spark.createDataFrame([("1", "a"), ("1", " "), (None, None)], "id string, v string")
    assert assertions.missing_required(df, ["id", "v"], "id").count() == 3
    with pytest.raises(ValueError, match="twice"):
        assertions.require(assertions.duplicate_keys(df.dropna(subset=["id"]), "id"), "twice")
    assert [r.processing_error for r in assertions.capture_errors(df, {"no_id": F.col("id").isNotNull(), "no_v": F.trim("v") != ""}).collect()] == [None, "no_v", "no_id"]


def test_normalized_offers(spark):
    schema = readers.PAGE.split("array<", 1)[1].rsplit(">>, `hydra:totalItems`", 1)[0] + ">"
    skill = lambda i, n: {"id": i, "@id": None, "name": n, "slug": None, "displayed": True}
    offer = {"id": "7", "title": " Dev&nbsp;Python ", "description": "<p>a</p><p>b</p>", "company": {"name": "Acme"}, "contracts": [" cdi", "cdi", ""], "skills": [skill("2", "SQL"), skill("1", "Été"), skill("2", "sql"), skill(None, "Ete"), skill(None, "été")], "location": {"locality": "Paris"}}
    raw = spark.read.schema(f"id string, offer {schema}").json(spark.sparkContext.parallelize([__import__("json").dumps({"id": "7", "offer": offer})]))
    r = normalize.normalize_offers(raw).first()
    assert r.title == "Dev Python" and r.description == "a b" and r.contracts == ["cdi"] and r.company_name == "Acme" and len(r.raw_payload_sha256) == 64
    assert [(s.source_skill_id, s.name_normalized) for s in r.skills] == [(None, "ete"), ("1", "ete"), ("2", "sql")]


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("﻿code;n;name\n007;3;a\n08; ;b\n", encoding="utf-8")
    got = readers.read_csv(spark, str(p), "name string, code string, n int, more string", required=("code",))
    assert [tuple(r) for r in got.collect()] == [("a", "007", 3, None), ("b", "08", None, None)]
    with pytest.raises(ValueError, match="lacks"):
        readers.read_csv(spark, str(p), "code string", required=("other",))
    writers.write_jsonl(got, f"{tmp_path}/j")
    assert readers.read_jsonl(spark, f"{tmp_path}/j", got.schema, "code").count() == 2
    with pytest.raises(Exception):
        writers.write_jsonl(got, f"{tmp_path}/j")
    digest = writers.write_if_changed(got, f"{tmp_path}/k")
    assert writers.write_if_changed(got.orderBy(F.desc("code")), f"{tmp_path}/k", digest) == digest
    writers.write_split(got, f"{tmp_path}/s", "name")
    assert sorted(x for x in os.listdir(f"{tmp_path}/s") if x.startswith("name=")) == ["name=a", "name=b"]
    os.makedirs(f"{tmp_path}/b/2024_01"), os.makedirs(f"{tmp_path}/b/2024_02")
    assert readers.latest_batch(spark, f"{tmp_path}/b").endswith("2024_02") and readers.latest_batch(spark, f"{tmp_path}/none") is None
    assert "| a |" in writers.markdown(got.select("name"), "t") and len(readers.file_digests(spark, str(p)).first().sha256) == 64
    queue = spark.createDataFrame([("1", "Dev", "Acme", "UNCERTAIN", "HAUTE", "REVIEW_NOW", 60.0, ["A", "B"])], "id string, title string, company string, decision string, priority string, action string, score double, reasons array<string>")
    writers.write_review_csv(queue, f"{tmp_path}/q")
    line = "".join((tmp_path / "q" / f).read_text(encoding="utf-8") for f in sorted(os.listdir(f"{tmp_path}/q")) if f.startswith("part-"))
    assert line.startswith("﻿id;title") and "A; B" in line and "Acme" in writers.review_page(queue, "t")
    assert writers.filter_queue(queue, "acm", "HAUTE", 60).count() == 1 and writers.filter_queue(queue, least_score=61).count() == 0


def test_code_labels(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "c string, l string")
    assert readers.code_labels(df, "c", "l").count() == 2
    with pytest.raises(Exception, match="two labels for a"):
        readers.code_labels(df.unionByName(spark.createDataFrame([("a", "z")], df.schema)), "c", "l").collect()


def test_samples(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], float(i)) for i in range(30)], "id long, g string, score double")
    assert [r.id for r in analysis.round_robin(df, "g", ["id"], 5).collect()] == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in analysis.even_sample(df, "id", 7).collect()) == [0, 4, 8, 12, 16, 20, 24]
    got = analysis.stratified(df.withColumn("p", F.lit("x")), "p", ["g"], ["id"], quota=4, total=6).collect()
    assert len(got) == 6 and len({r.id for r in got}) == 6
    c = analysis.clusters(df.withColumn("coverage", F.lit(1)).withColumn("candidates", F.lit(1)).withColumn("priority", F.lit(1)), ["g"], spread=100)
    assert {r.n for r in c.collect()} == {10} and all(r.safe for r in c.collect())
    assert sorted(r.cluster_id for r in analysis.number_clusters(c, ["g"]).collect()) == [1, 2, 3]


def test_stream_equals_the_fold_in_any_batching(spark, tmp_path):
    rows = [(1, "2024-02", 1, "p1"), (2, "", 2, "p2"), (1, "2024-01", 3, "p3"), (2, "2024-01", 4, "p4"), (1, "2024-02", 5, "p5"), (2, None, 6, "p6"), (3, "x", 7, "p7")]
    for i in range(0, len(rows), 3):
        spark.createDataFrame(rows[i : i + 3], "k int, u string, o long, p string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = ingest.landing_stream(spark, f"{tmp_path}/in", "k int, u string, o long, p string", "parquet", 1)
    ingest.newest_payloads(s, "k", "p", "u", "o", f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    v = ingest.Versions(spark, f"{tmp_path}/state")
    assert len(v.whole()) == 3 and {r.k: r.p for r in v.before().collect()} == fold_payloads(rows)
    assert v.before(1).count() < v.before().count() or v.before(1) is not None


def test_first_seen_and_resume(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t), (1, t), (2, t)], "k int, ts timestamp").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("k int, ts timestamp").parquet(f"{tmp_path}/in")
    q = ingest.first_seen(s, "k", "ts").writeStream.format("memory").queryName("seen").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("seen").count() == 2
    done = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in ingest.resume(spark.createDataFrame([(1,), (2,)], "k int"), done, ["k"]).collect()] == [2]


def test_payload_fields(spark):
    from millrace.functions import payload

    links = [("/job_postings?page=2",), ("job_postings?page=3",), (" ",), ("https://www.example.org/api/job_postings?page=4",), ("http://www.example.org/api/job_postings",), ("https://www.example.org.evil.net/api/job_postings",)]
    got = values(spark, links, "u string", payload.next_link(F.col("u")), payload.is_allowed_link(F.col("u"), "www.example.org", "/api/job_postings"))
    assert [g[0] for g in got][:3] == ["/api/job_postings?page=2", "/api/job_postings?page=3", None] and [g[1] for g in got] == [False, False, False, True, False, False]
    assert values(spark, [("https://x.org/a?page=4&b=1",), ("https://x.org/a",)], "u string", payload.page_number(F.col("u"))) == [(4,), (None,)]
    assert values(spark, [(" Niveau Bac ", "12"), ("Bac", " "), (None, "x")], "l string, n string", payload.level_code(F.col("l")), payload.whole_number(F.col("n"))) == [("NIV4", 12), (None, None), (None, None)]
    assert values(spark, [('{"b":1,"a":{"@id":"/.well-known/genid/7","x":2},"elasticHighlights":[1]}',)], "p string", payload.without_context("p")) == [('{"a": {"x": 2}, "b": 1}',)]
    e = "e struct<uniteLegale:struct<denominationUniteLegale:string,nomUniteLegale:string,prenom1UniteLegale:string>,adresseEtablissement:struct<numeroVoieEtablissement:string,typeVoieEtablissement:string,libelleVoieEtablissement:string,codePostalEtablissement:string,libelleCommuneEtablissement:string,codeCommuneEtablissement:string>,periodesEtablissement:array<struct<enseigne1Etablissement:string>>>"
    r = spark.createDataFrame([(((None, "Durand", "Anne"), ("3", "RUE", None, "97100", "X", "97105"), []),)], e).select(*payload.establishment("e")).first()
    assert (r.nom_entreprise, r.adresse, r.departement, r.region, r.enseigne) == ("Durand Anne", "3 RUE", "971", "Guadeloupe", None)
    assert values(spark, [(["EXACT_FINGERPRINT"],), (["x"],)], "r array<string>", payload.explanation(F.col("r")))[1] == ("close, but not the same",)


def test_reference_files_and_manifests(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.first_matching(spark, f"{tmp_path}/reference-*.csv")
    for name in ("reference-2.csv", "reference-1.csv"):
        (tmp_path / name).write_text("code\n")
    assert readers.first_matching(spark, f"{tmp_path}/reference-*.csv").endswith("/reference-1.csv")
    candidates = f"{tmp_path}/candidates.jsonl"
    none = {"strategy": "UNKNOWN", "use_aliases": None, "manifest_found": False}
    assert readers.matching_strategy(spark, candidates) == none
    manifest = tmp_path / "matching_manifest.json"
    manifest.write_text("[]")
    assert readers.matching_strategy(spark, candidates) == none
    manifest.write_text('{"strategy": "", "use_aliases": true}')
    found = readers.matching_strategy(spark, candidates)
    assert (found["strategy"], found["use_aliases"], found["manifest_found"]) == ("UNKNOWN", True, True)
    assert found["manifest_sha256"] == hashlib.sha256(manifest.read_bytes()).hexdigest()


def test_appended_csv_and_its_rows(spark, tmp_path):
    path = f"{tmp_path}/out"
    rows = spark.createDataFrame([(1, "a\nb"), (2, 'x;"y"'), (3, None)], "id long, name string")
    writers.append_csv(rows.filter("id = 2"), path, "id")
    writers.append_csv(rows, path, "id")
    assert sorted(r.id for r in readers.read_csv(spark, path, "id long").filter("id IS NOT NULL").collect()) == [1, 2, 3]
    assert readers.csv_rows(spark, path).first().rows == 3


def test_order_of_queues(spark):
    decided = spark.createDataFrame([("a", "LOW", 90), ("b", "HIGH", 10), ("c", "HIGH", None), ("d", "MEDIUM", 50), ("e", "HIGH", 10)], "id string, audit_priority string, score int")
    assert [r.id for r in triage.audit_queue(decided).collect()] == ["b", "e", "c", "d", "a"]
    assigned = spark.createDataFrame([("a", "INSUFFICIENT", 5.0), ("b", "AMBIGUOUS", 1.0), ("c", "AMBIGUOUS", 7.0), ("d", "AMBIGUOUS", 7.0), ("e", "INSUFFICIENT", None)], "id string, status string, score double")
    assert [r.id for r in occupation.assignment_queue(assigned).collect()] == ["c", "d", "b", "a", "e"]


def test_keys_links_and_skill_tokens(spark):
    df = spark.createDataFrame([("  Ingénieur C++ / .NET ", "https://x.org/job_postings/1?a=b"), (None, None), ("ﬁn\tÉTÉ", "https://x.org/a?next=/job_postings/1"), ("", "/job_postings/7")], "t string, u string")
    rows = df.select(text.dedup_key(F.col("t")).alias("k"), text.is_legacy_url(F.col("u")).alias("l")).collect()
    assert [tuple(r) for r in rows] == [("ingenieur c net", True), ("", False), ("fin ete", False), ("", True)]
    schema = "skills array<struct<name_normalized:string,name:string,slug:string>>"
    skills = spark.createDataFrame([([("java script", "JavaScript", "java-script"), (None, "Développer avec 2024", None)],), ([],), (None,)], schema)
    assert [r[0] for r in skills.select(text.skill_tokens(F.col("skills"))).collect()] == [["developper", "java", "javascript", "script"], [], []]

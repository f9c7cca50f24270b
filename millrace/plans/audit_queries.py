"""Registered queries of the reports on decided offers, of assertions, packages and replays."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import analysis, assertions, audits, catalog, package, training, triage
from millrace.sources.tables import table
from millrace.streaming import ingest

from . import analogs
from .analogs import CATALOG_CTE, CATALOG_FIELDS, t
from .queries import _BUCKET, _CHANGE, _IMPORT, DECIDED_CTE, _decided, query


def _case(column: str, limits, last: str, none: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '{none}' " + " ".join(f"WHEN {column} < {limit} THEN '{name}'" for limit, name in limits) + f" ELSE '{last}' END"


_SCORE = _case("score", audits.SCORE_BANDS, "80_PLUS", "NO_SCORE")
_MARGIN = _case("(score - second)", audits.MARGIN_BANDS, "20_PLUS", "NO_SECOND_CANDIDATE")
_COVERAGE = _case("coverage", audits.COVERAGE_BANDS, "FULL_95_PLUS", "UNKNOWN")
_GIVEN_UP = f"""{DECIDED_CTE}, g AS (SELECT *, concat_ws('+', CASE WHEN list_contains(blocks, 'EXACT_FINGERPRINT') THEN 'EXACT_FINGERPRINT_LOST' END, CASE WHEN company_type IN ('EXACT_NORMALIZED', 'ALIAS_MATCH') AND title_ratio >= 0.85 THEN 'SAME_COMPANY_STRONG_TITLE' END,
CASE WHEN score >= 75 AND NOT generic_title THEN 'HIGH_SCORE_NON_GENERIC_TITLE' END) AS regression_reasons FROM e WHERE v1_decision = 'DUPLICATE' AND decision <> 'PRESENT')"""


@query(f"""WITH {_GIVEN_UP} SELECT id, decision, regression_reasons, CASE WHEN regression_reasons <> '' THEN 'regression_v2_possible' WHEN decision = 'UNCERTAIN' THEN 'verification_humaine_necessaire' ELSE 'reclassification_probablement_justifiee' END AS verdict FROM g""")
def reclassified_duplicates(spark, d):
    return audits.reclassified(_decided(spark, d)).select("id", "decision", F.array_join("regression_reasons", "+").alias("regression_reasons"), "verdict")


@query(f"""WITH {_GIVEN_UP}, u AS (SELECT id, {_BUCKET} AS bucket FROM e WHERE decision = 'UNCERTAIN'), s AS (SELECT id, list_position(['MISSING_DATA', 'CONTRADICTION', 'CLOSE_CANDIDATES', 'INTERMEDIATE', 'OTHER'], bucket) AS turn FROM u QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY id) <= 4),
r AS (SELECT id, turn FROM s UNION ALL SELECT id, 99 FROM u WHERE id NOT IN (SELECT id FROM s)),
p AS (SELECT 'A' AS pilot_group, row_number() OVER (ORDER BY coalesce(score, 0), -coverage, id) AS place, id FROM e WHERE decision = 'NOT_FOUND' UNION ALL SELECT 'B', row_number() OVER (ORDER BY regression_reasons = '', id), id FROM g UNION ALL SELECT 'C', row_number() OVER (ORDER BY turn, id), id FROM r)
SELECT pilot_group, CAST(place AS INT) AS place, id FROM p WHERE place <= 20""")
def pilot_groups(spark, d):
    e = table(_decided(spark, d))
    return audits.pilot(e, audits.reclassified(e), triage.uncertainty_bucket())


_BANDED = f"{DECIDED_CTE}, x AS (SELECT priority, reasons AS reason, {_SCORE} AS score, {_MARGIN} AS margin, CAST(candidates AS VARCHAR) AS candidates, {_COVERAGE} AS coverage FROM e WHERE decision = 'UNCERTAIN')"


@query(f"WITH {_BANDED} " + " UNION ALL ".join(f"SELECT '{n}' AS report, {n} AS a, CAST(NULL AS VARCHAR) AS b, count(*) AS n FROM x GROUP BY {n}" for n in ("priority", "reason", "score", "margin", "candidates", "coverage")) + "".join(f" UNION ALL SELECT '{a}_by_{b}', {a}, {b}, count(*) FROM x GROUP BY {a}, {b}" for a, b in (("priority", "score"), ("priority", "reason"), ("coverage", "score"))))
def ambiguity_tables(spark, d):
    return audits.ambiguity_tables(_decided(spark, d).filter("decision = 'UNCERTAIN'"))


@query(f"WITH {DECIDED_CTE} SELECT count(*) AS analyzed_cases, count(*) FILTER (max_score < 40) AS only_weak_candidates, count(*) FILTER (score >= 50 AND second >= 50 AND score - second < 5) AS multiple_close_candidates, count(*) FILTER (against <> '') AS contradictory_evidence_cases, count(*) FILTER (reasons LIKE '%INSUFFICIENT_DATA%') AS insufficient_data_cases FROM e WHERE decision = 'UNCERTAIN'")
def ambiguity_summary(spark, d):
    return audits.ambiguity_summary(_decided(spark, d).filter("decision = 'UNCERTAIN'"))


_SIX = "title, company, postal_code, best_b, reason, score_band"
_KEYED = f"{DECIDED_CTE}, k AS (SELECT * EXCLUDE (title), 'offer ' || CAST(k % 10 AS VARCHAR) AS title, 'b' || CAST(k % 7 AS VARCHAR) AS best_b, reasons AS reason, {_SCORE} AS score_band FROM e WHERE decision = 'UNCERTAIN')"
_GROUPS = f"""{_KEYED}, g AS (SELECT {_SIX}, count(*) AS n, min(id) AS first_id, max(score) - min(score) <= 2 AND count(DISTINCT coverage) = 1 AND count(DISTINCT candidates) = 1 AND count(DISTINCT priority) = 1 AS safe FROM k WHERE NOT generic_title GROUP BY ALL HAVING count(*) >= 2),
c2 AS (SELECT row_number() OVER (ORDER BY n DESC, {_SIX}) AS cluster_id, * FROM g)"""


def _six(spark, d):
    """Uncertain cases with titles and candidates that repeat."""
    u = table(_decided(spark, d)).filter("decision = 'UNCERTAIN'")
    return u.withColumn("title", F.concat(F.lit("offer "), (F.col("k") % 10).cast("string"))).withColumn("best_b", F.concat(F.lit("b"), (F.col("k") % 7).cast("string")))


def _six_clusters(u):
    return analysis.number_clusters(analysis.clusters(audits.cluster_cases(u), audits.CLUSTER_KEYS), audits.CLUSTER_KEYS)


@query(f"WITH {_GROUPS} SELECT cluster_id, {_SIX}, n, first_id, coalesce(safe, false) AS safe FROM c2")
def ambiguity_clusters(spark, d):
    return _six_clusters(_six(spark, d)).select("cluster_id", *audits.CLUSTER_KEYS, "n", "first_id", "safe")


@query(f"""WITH {_GROUPS}, ten AS (SELECT cluster_id FROM c2 ORDER BY n DESC, cluster_id LIMIT 10)
SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS clustered, round(avg(n), 2) AS mean_size, median(n) AS median_size, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS saved_all, CAST(coalesce(sum(CASE WHEN safe THEN n - 1 ELSE 0 END), 0) AS BIGINT) AS saved_safe,
CAST((SELECT count(*) FROM k) - coalesce(sum(n), 0) AS BIGINT) AS isolated, (SELECT array_to_string(list_sort(list(cluster_id)), ',') FROM ten) AS largest FROM c2""")
def ambiguity_cluster_report(spark, d):
    u = table(_six(spark, d))
    return audits.cluster_report(table(_six_clusters(u)), u.count())


_CAL = "priority, reason, score_band, coverage_band, margin_band, grouped"


@query(f"""WITH {_KEYED}, k2 AS (SELECT *, {_COVERAGE} AS coverage_band, {_MARGIN} AS margin_band, CASE WHEN NOT generic_title AND count(*) FILTER (NOT generic_title) OVER (PARTITION BY {_SIX}) >= 2 THEN 'GROUPED' ELSE 'ISOLATED' END AS grouped FROM k),
b1 AS (SELECT *, row_number() OVER (PARTITION BY {_CAL} ORDER BY title, company, postal_code, id) AS turn, count(*) OVER (PARTITION BY {_CAL}) AS size FROM k2),
b2 AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY turn, size, {_CAL}) AS r FROM b1 WHERE turn <= 60), f1 AS (SELECT id FROM b2 WHERE r <= 60),
r1 AS (SELECT id, row_number() OVER (PARTITION BY {_CAL} ORDER BY title, id) AS turn, {_CAL} FROM k2 WHERE id NOT IN (SELECT id FROM f1)), r2 AS (SELECT id, row_number() OVER (ORDER BY turn, {_CAL}) AS r FROM r1)
SELECT id FROM f1 UNION ALL SELECT id FROM r2 WHERE r <= 180 - (SELECT count(*) FROM f1)""")
def calibration_buckets(spark, d):
    u = table(_six(spark, d))
    members = _six_clusters(u).select(*audits.CLUSTER_KEYS, F.lit("GROUPED").alias("__in"))
    keyed = audits.cluster_cases(u).join(members, audits.CLUSTER_KEYS).select("id", "__in")
    bands = {"reason": F.array_join("reasons", "+"), "score_band": audits.score_band(F.col("score")), "coverage_band": audits.coverage_band(F.col("coverage")), "margin_band": audits.margin_band(F.col("score") - F.col("second"))}
    b = u.withColumns(bands).join(keyed, "id", "left").withColumn("grouped", F.coalesce("__in", F.lit("ISOLATED"))).drop("__in")
    return analysis.stratified(b, "priority", ["reason", "score_band", "coverage_band", "margin_band", "grouped"], ["title", "company", "postal_code", "id"], fill_order=["title", "id"], priorities=("HAUTE", "MOYENNE", "FAIBLE")).select("id")


_CAUSES = (("reasons LIKE '%INSUFFICIENT_DATA%'", "meilleure_qualite_description"), ("reasons LIKE '%COMPANY_MATCH_GEO_DIFFERS%'", "meilleure_geographie"), ("regexp_matches(reasons, 'HIGH_SCORE_COMPANY_DIFFERS|STRONG_TITLE_COMPANY_DIFFERS')", "alias_entreprises"), ("bucket = 'INTERMEDIATE'", "nouvelle_regle_metier"), ("bucket = 'CLOSE_CANDIDATES'", "aucune_automatisation_sure"), ("generic_title", "meilleure_normalisation"))


@query(f"WITH {DECIDED_CTE}, x AS (SELECT *, {_BUCKET} AS bucket FROM e WHERE decision = 'UNCERTAIN') SELECT cause, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{name}' AS cause FROM x WHERE {c}" for c, name in _CAUSES) + ") GROUP BY cause")
def reducible_causes(spark, d):
    return audits.reducible_causes(_decided(spark, d), triage.uncertainty_bucket())


def _wide(column: str, width: int) -> str:
    low = f"CAST(floor(least({column}, 100 - 1e-9) / {width}) * {width} AS INT)"
    return f"CASE WHEN {column} IS NULL THEN 'NONE' ELSE CAST({low} AS VARCHAR) || '-' || CAST({low} + {width - 1} AS VARCHAR) END"


@query(f"""WITH {DECIDED_CTE}, x AS (SELECT {_wide('score', 10)} AS s, {_wide('coverage', 20)} AS c, CASE WHEN score - second IS NULL THEN 'NO_SECOND' WHEN score - second < 2 THEN '0-1' WHEN score - second < 5 THEN '2-4' WHEN score - second < 10 THEN '5-9' ELSE '10_PLUS' END AS m FROM e WHERE decision = 'UNCERTAIN')
SELECT report, band, count(*) AS n FROM (SELECT 'score' AS report, s AS band FROM x UNION ALL SELECT 'coverage', c FROM x UNION ALL SELECT 'margin', m FROM x) GROUP BY ALL""")
def uncertainty_bands(spark, d):
    return audits.uncertainty_bands(_decided(spark, d))


# --- assertions -----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus AS value FROM orders WHERE o_orderstatus <> 'F'")
def literal_violations(spark, d):
    return assertions.literal_violations(t(spark, d, "orders"), "o_orderstatus", "F", "o_orderkey")


@query("SELECT l_orderkey, l_partkey AS \"inner\" FROM lineitem WHERE l_partkey <> l_orderkey")
def id_mismatches(spark, d):
    return assertions.id_mismatches(t(spark, d, "lineitem"), F.col("l_partkey"), "l_orderkey")


_SKILLS = "SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS skills FROM lineitem {where} GROUP BY 1"


@query(f"SELECT x.l_orderkey FROM ({_SKILLS.format(where='')}) AS x JOIN ({_SKILLS.format(where=chr(10) + 'WHERE l_linenumber < 4')}) AS y USING (l_orderkey) WHERE x.skills <> y.skills")
def unequal_skills(spark, d):
    lists = lambda li: li.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("skills"))
    li = t(spark, d, "lineitem")
    return assertions.unequal_lists(lists(li), lists(li.filter("l_linenumber < 4")), "l_orderkey", "skills")


@query("SELECT value, expected, coalesce(found, 0) AS found, coalesce(found, 0) = expected AS ok FROM (VALUES ('F', CAST(10 AS BIGINT)), ('O', CAST(5 AS BIGINT)), ('X', CAST(0 AS BIGINT))) AS w(value, expected) LEFT JOIN (SELECT o_orderstatus AS value, count(*) AS found FROM orders GROUP BY 1) USING (value)")
def expected_volumes(spark, d):
    return assertions.volumes(t(spark, d, "orders"), "o_orderstatus", {"F": 10, "O": 5, "X": 0})


@query("SELECT doc_id, c AS \"column\" FROM (SELECT doc_id, 'lang' AS c, lang AS v FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents) WHERE trim(coalesce(v, '')) <> ''")
def filled_in(spark, d):
    return assertions.filled_in(t(spark, d, "documents"), ["lang", "source"], "doc_id")


@query("SELECT event_id, c AS \"column\" FROM (SELECT event_id, 'props' AS c, CASE WHEN event_id % 7 = 0 THEN ' ' ELSE props END AS v FROM events UNION ALL SELECT event_id, 'event_type', CASE WHEN event_id % 5 <> 0 THEN event_type END FROM events) WHERE trim(coalesce(v, '')) = ''")
def missing_required(spark, d):
    e = t(spark, d, "events").withColumn("props", F.when(F.col("event_id") % 7 == 0, " ").otherwise(F.col("props"))).withColumn("event_type", F.when(F.col("event_id") % 5 != 0, F.col("event_type")))
    return assertions.missing_required(e, ["props", "event_type"], "event_id")


@query("SELECT o_orderkey, CASE WHEN o_totalprice <= 1000 THEN 'price' WHEN o_orderstatus = 'P' THEN 'status' END AS processing_error FROM orders")
def captured_errors(spark, d):
    return assertions.capture_errors(t(spark, d, "orders"), {"price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus") != "P"}).select("o_orderkey", "processing_error")


@query("SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) AS whole, count(*) FILTER (o_orderstatus IN ('F', 'O')) = count(*) AS ok FROM orders")
def counters_add_up(spark, d):
    n = lambda s: F.sum((F.col("o_orderstatus") == s).cast("long"))
    one = t(spark, d, "orders").agg(F.count("*").alias("n"), n("F").alias("f"), n("O").alias("o"))
    return assertions.counters_add_up(one, ["f", "o"], F.col("n")).withColumn("n", F.col("whole"))


@query("SELECT p_partkey AS k FROM part WHERE p_partkey % 3 <> 0")
def anti_insert_hits(spark, d):
    p = t(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_name")
    return training.insert_missing(p.filter("k % 3 = 0"), p.unionByName(p), ["k"], ["p_name"]).select("k")


@query("SELECT p_partkey AS k, 'left' AS side FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 2 <> 0 UNION ALL SELECT p_partkey, 'right' FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0")
def set_diff_hits(spark, d):
    p = t(spark, d, "part").select(F.col("p_partkey").alias("k"))
    return assertions.set_difference(p.filter("k % 3 = 0"), p.filter("k % 2 = 0"), "k")


@query(f"WITH {CATALOG_CTE} SELECT o_orderkey FROM s1 WHERE o_orderkey % 6 = 1")
def coherence_hits(spark, d):
    state = analogs.catalog_state(spark, d)
    spoiled = state.withColumn("content_hash", F.when(F.col("o_orderkey") % 6 == 1, F.lit("other")).otherwise(F.col("content_hash")))
    return catalog.incoherent_rows(spoiled, "o_orderkey", CATALOG_FIELDS).select("o_orderkey")


# --- packages -------------------------------------------------------------------------------------------------------------


def _package(spark, d):
    e = table(_decided(spark, d).select("id", "k", "company", "decision", "action", "best_company"))
    offers = e.select("id", F.split("company", "c").alias("skills"))
    target = e.select("id", "decision", "action", F.when(F.col("k") % 11 != 0, F.col("best_company")).alias("best_b"), F.concat(F.lit("M"), (F.col("k") % 4).cast("string")).alias("best_code"))
    return e, package.records(e.select("id", F.expr(_CHANGE).alias("change")), offers, target)


@query(f"""WITH {DECIDED_CTE}, {_IMPORT}, x AS (SELECT *, decision = 'PRESENT' AND k % 11 <> 0 AS inherited FROM ia)
SELECT id, CASE WHEN inherited THEN 'M' || CAST(k % 4 AS VARCHAR) END AS occupation, CASE WHEN inherited THEN 'INHERITED' ELSE 'PENDING' END AS occupation_status, CASE WHEN inherited THEN 'INHERITED_FROM_MATCH' ELSE 'NOT_ASSIGNED' END AS occupation_method FROM x""")
def preimport_occupations(spark, d):
    return package.with_occupation(_package(spark, d)[1]).select("id", "occupation", "occupation_status", "occupation_method")


@query(f"WITH {DECIDED_CTE}, {_IMPORT} SELECT id, string_split(company, 'c') AS skills_candidate FROM ia WHERE import_action = 'ENRICH_EXISTING'")
def preimport_enrichments(spark, d):
    return package.enrichments(_package(spark, d)[1]).select("id", "skills_candidate")


@query(f"WITH {DECIDED_CTE}, {_IMPORT} SELECT id AS source_id, 'INACTIVATED' AS catalog_change_type, 'DEACTIVATE' AS preimport_action, 'run' AS preimport_run_id FROM ia WHERE change = 'INACTIVATED'")
def preimport_deactivations(spark, d):
    return package.deactivations(_package(spark, d)[1], "run")


@query(f"""WITH {DECIDED_CTE}, {_IMPORT}, i AS (SELECT *, change NOT IN ('INACTIVATED', 'UNCHANGED') AS process, k % 50 <> 0 AS written, k % 70 = 0 AND k % 50 <> 0 AS twice, k % 90 <> 0 AS triaged FROM ia)
SELECT count(*) FILTER (change <> 'INACTIVATED') AS active_snapshot_count, count(*) FILTER (process) AS process_count, count(*) FILTER (change = 'UNCHANGED') AS unchanged_count, count(*) FILTER (change = 'INACTIVATED') AS deactivation_count,
count(*) FILTER (process AND NOT triaged) AS missing_process_ids_in_triage, count(*) FILTER (triaged AND change = 'INACTIVATED') AS unexpected_triage_ids_outside_snapshot, count(*) FILTER (process AND NOT written) AS missing_process_ids_in_outputs,
count(*) FILTER (process AND twice) AS duplicate_process_output_ids, count(*) FILTER (change = 'INACTIVATED' AND NOT written) AS missing_deactivation_ids_in_outputs, count(*) FILTER (change = 'INACTIVATED' AND twice) AS duplicate_deactivation_output_ids,
CAST(0 AS BIGINT) AS unexpected_process_ids_in_outputs, true AS active_partition_valid, true AS active_equation_valid, false AS integrity_valid FROM i""")
def preimport_report(spark, d):
    """A package with faults: ids that weren't written, written twice, or not triaged."""
    e, recs = _package(spark, d)
    changes, n = recs.select("id", "change"), F.col("id").cast("long")
    outputs = recs.select("id", "import_action").filter(n % 50 != 0)
    outputs = outputs.unionByName(outputs.filter(n % 70 == 0))
    got = package.integrity_report(changes, changes.filter("change <> 'INACTIVATED'"), e.select("id").filter(n % 90 != 0), outputs)
    return got.drop("process_unchanged_overlap", "process_deactivation_overlap", "unchanged_deactivation_overlap", "unexpected_deactivation_ids_in_outputs", "active_ids_without_change", "changed_ids_outside_snapshot")


# --- replays --------------------------------------------------------------------------------------------------------------


@query("SELECT p_name AS query, p_partkey AS place, count(l_partkey) > 0 AS reused FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R') ON l_partkey = p_partkey GROUP BY 1, 2")
def replay_queries(spark, d):
    p = t(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("query"), F.col("p_partkey").alias("place"))
    parent = t(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.when(F.col("l_returnflag") == "R", "OK").otherwise("FAILED").alias("status"))
    return ingest.replay(p, parent, "k").join(p.select("k", "query"), "k").select("query", "place", "reused")


@query("WITH t AS (SELECT l_partkey AS query, l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'), u AS (SELECT l_partkey AS query, l_orderkey AS id FROM lineitem WHERE l_returnflag = 'A' AND l_partkey NOT IN (SELECT query FROM t)) SELECT query, id, query * 2 AS place FROM (SELECT * FROM t UNION ALL SELECT * FROM u)")
def replay_results(spark, d):
    rows = lambda flag: t(spark, d, "lineitem").filter(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias("query"), F.col("l_orderkey").alias("id"))
    reference = t(spark, d, "part").select(F.col("p_partkey").alias("query"), (F.col("p_partkey") * 2).alias("place"))
    return ingest.merged_results(reference, rows("A"), rows("R"))


@query("SELECT event_id, user_id FROM events JOIN (SELECT user_id, min(event_id) AS first FROM events GROUP BY 1) USING (user_id) WHERE event_id > first")
def revisited_links(spark, d):
    return ingest.revisited(t(spark, d, "events"), "user_id", "event_id").select("event_id", "user_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0")
def resume_checked(spark, d):
    work = t(spark, d, "orders").select("o_orderkey")
    return ingest.resume_checked(work, work.filter("o_orderkey % 4 = 0"), ingest.fingerprint(work).first()["input_hash"], ["o_orderkey"])


@query(f"WITH {DECIDED_CTE} SELECT id, audit_priority, score FROM e")
def audit_queue(spark, d):
    return triage.audit_queue(_decided(spark, d)).select("id", "audit_priority", "score")

"""Reports on decided offers: duplicates that the second ruleset gave up, pilot groups, ambiguity tables, clusters, reducible doubt.

All take one row per offer as made by triage.decision_record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scores import band
from millrace.sources.tables import table

from .ordering import exact_median
from .triage import FINGERPRINT, codes, yes

#: Lower ends of the bands and their names.
SCORE_BANDS = ((30, "00_29"), (40, "30_39"), (50, "40_49"), (60, "50_59"), (70, "60_69"), (80, "70_79"))
MARGIN_BANDS = ((2, "00_01"), (5, "02_04"), (10, "05_09"), (20, "10_19"))
COVERAGE_BANDS = ((55, "LOW_LT_55"), (80, "PARTIAL_55_79"), (95, "GOOD_80_94"))
#: The order in which a pilot takes uncertain cases.
BUCKETS = ("MISSING_DATA", "CONTRADICTION", "CLOSE_CANDIDATES", "INTERMEDIATE")


def banded(x: Column, limits: tuple[tuple[float, str], ...], last: str, none: str) -> Column:
    out = F.when(x.isNull(), none)
    for limit, name in limits:
        out = out.when(x < limit, name)
    return out.otherwise(last)


def score_band(x: Column) -> Column:
    return banded(x, SCORE_BANDS, "80_PLUS", "NO_SCORE")


def margin_band(x: Column) -> Column:
    return banded(x, MARGIN_BANDS, "20_PLUS", "NO_SECOND_CANDIDATE")


def coverage_band(x: Column) -> Column:
    return banded(x, COVERAGE_BANDS, "FULL_95_PLUS", "UNKNOWN")


def regression_reasons(known_positives: tuple[str, ...] = ()) -> Column:
    """Why giving up a duplicate may be a mistake."""
    title = F.coalesce("title_ratio", F.lit(0.0)) >= 0.85
    return codes(
        (F.array_contains("blocks", FINGERPRINT), "EXACT_FINGERPRINT_LOST"), (F.col("company_type").isin("EXACT_NORMALIZED", "ALIAS_MATCH") & title, "SAME_COMPANY_STRONG_TITLE"),
        ((F.col("score") >= 75) & ~yes(F.col("generic_title")), "HIGH_SCORE_NON_GENERIC_TITLE"), (F.col("id").isin(*known_positives) if known_positives else F.lit(False), "KNOWN_POSITIVE_HISTORICAL_CASE"),
    )


def reclassified(decided: DataFrame, known_positives: tuple[str, ...] = ()) -> DataFrame:
    """(id, score, v1_reasons, v2_reasons, decision, regression_reasons, verdict) of first-ruleset duplicates that the second
    doesn't find present. An offer without a candidate has no reasons."""
    gone = decided.filter("v1_decision = 'DUPLICATE' AND decision <> 'PRESENT'")
    reasons = F.when(F.col("score").isNull(), F.array().cast("array<string>")).otherwise(regression_reasons(known_positives))
    verdict = F.when(F.size("regression_reasons") > 0, "regression_v2_possible").when(F.col("decision") == "UNCERTAIN", "verification_humaine_necessaire").otherwise("reclassification_probablement_justifiee")
    return gone.withColumn("regression_reasons", reasons).select("id", "score", F.col("v1.reasons").alias("v1_reasons"), F.col("reasons").alias("v2_reasons"), "decision", "regression_reasons", verdict.alias("verdict"))


def _first(df: DataFrame, order: list[Column], k: int, by: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def pilot(decided: DataFrame, audited: DataFrame, bucket: Column, size: int = 20, per_bucket: int = 4) -> DataFrame:
    """(pilot_group, place, id): A, offers not found, by least score and most coverage; B, reclassified duplicates, possible
    regressions first; C, uncertain ones, per_bucket of each bucket in the order of BUCKETS, then any others by id."""
    named = lambda d, g: d.select(F.lit(g).alias("pilot_group"), "place", "id")
    # the first rows of a whole table are a limit, so no window holds it
    ranked = lambda d, order: _first(d.orderBy(*order).limit(size), order, size)
    a = ranked(decided.filter("decision = 'NOT_FOUND'"), [F.coalesce("score", F.lit(0.0)), -F.coalesce("coverage", F.lit(0)), F.col("id")])
    b = ranked(audited, [F.size("regression_reasons") == 0, F.col("id")])
    u = decided.filter("decision = 'UNCERTAIN'").select("id", bucket.alias("bucket"))
    order = F.array_position(F.array(*map(F.lit, (*BUCKETS, "OTHER"))), F.col("bucket"))
    some = _first(u, [F.col("id")], per_bucket, ["bucket"]).select("id", order.alias("turn"))
    rest = u.join(some.select("id"), "id", "left_anti").orderBy("id").limit(size).select("id", F.lit(99).cast("long").alias("turn"))
    c = ranked(some.unionByName(rest), [F.col("turn"), F.col("id")])
    return named(a, "A").unionByName(named(b, "B")).unionByName(named(c, "C"))


def ambiguity_tables(cases: DataFrame) -> DataFrame:
    """(report, a, b, n): distributions of uncertain offers by priority, reason key, score, margin, number of candidates and
    coverage, and three tables by two of them, in one pass of grouping sets over the banded columns."""
    x = cases.select("priority", F.array_join("reasons", "+").alias("reason"), score_band(F.col("score")).alias("score"), margin_band(F.when(F.col("second").isNotNull(), F.col("score") - F.col("second"))).alias("margin"), F.col("candidates").cast("string").alias("candidates"), coverage_band(F.col("coverage")).alias("coverage"))
    names = ("priority", "reason", "score", "margin", "candidates", "coverage")
    tables = (("priority", "score"), ("priority", "reason"), ("coverage", "score"))
    # one row for each report that a case counts in
    entries = [F.struct(F.lit(n).alias("report"), F.col(n).alias("a"), F.lit(None).cast("string").alias("b")) for n in names] + [F.struct(F.lit(f"{a}_by_{b}").alias("report"), F.col(a).alias("a"), F.col(b).alias("b")) for a, b in tables]
    per = x.groupBy(*names).agg(F.count("*").alias("n"))
    return per.select("n", F.explode(F.array(*entries)).alias("e")).groupBy("e.report", "e.a", "e.b").agg(F.sum("n").alias("n"))


def ambiguity_summary(cases: DataFrame) -> DataFrame:
    """One row over uncertain offers: how many, with weak candidates only, close ones, contradictions, too few data."""
    n = lambda c: F.coalesce(F.sum(yes(c).cast("long")), F.lit(0))
    close = (F.col("score") >= 50) & (F.col("second") >= 50) & (F.col("score") - F.col("second") < 5)
    return cases.agg(F.count("*").alias("analyzed_cases"), n(F.col("max_score") < 40).alias("only_weak_candidates"), n(close).alias("multiple_close_candidates"), n(F.size("contradictions") > 0).alias("contradictory_evidence_cases"), n(F.array_contains("reasons", "INSUFFICIENT_DATA")).alias("insufficient_data_cases"))


CLUSTER_KEYS = ["title", "company", "postal_code", "best_b", "reason", "score_band"]


def cluster_cases(cases: DataFrame) -> DataFrame:
    """Cases with the six parts of their cluster key; without generic titles and without those that have no company, postal code
    and candidate."""
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    keyed = cases.filter(~yes(F.col("generic_title"))).select("*", F.array_join("reasons", "+").alias("reason"), score_band(F.col("score")).alias("score_band"))
    keyed = keyed.filter((e("company") != "") | (e("postal_code") != "") | (e("best_b") != ""))
    return keyed.withColumns({c: e(c) for c in ("title", "company", "postal_code", "best_b")})


def cluster_report(numbered: DataFrame, cases: int) -> DataFrame:
    """One row: clusters, clustered and isolated cases, mean and median size, reviews saved, and the ten largest clusters."""
    numbered = table(numbered)  # read by each pass of the median
    ten = numbered.orderBy(F.desc("n"), "cluster_id").limit(10).agg(F.array_join(F.transform(F.array_sort(F.collect_list("cluster_id")), lambda c: c.cast("string")), ",").alias("largest"))  # ten rows
    one = numbered.agg(
        F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("clustered"), F.round(F.avg("n"), 2).alias("mean_size"), F.lit(exact_median(numbered, "n")).cast("double").alias("median_size"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("saved_all"), F.coalesce(F.sum(F.when(F.col("safe"), F.col("n") - 1).otherwise(0)), F.lit(0)).alias("saved_safe"),
    )
    return one.withColumn("isolated", F.lit(cases) - F.col("clustered")).crossJoin(ten)  # one row each


def reducible_causes(decided: DataFrame, bucket: Column) -> DataFrame:
    """(cause, n): what would settle uncertain offers."""
    has = lambda *names: F.arrays_overlap("reasons", F.array(*map(F.lit, names)))
    # fixed values
    causes = codes(
        (has("INSUFFICIENT_DATA"), "meilleure_qualite_description"), (has("COMPANY_MATCH_GEO_DIFFERS"), "meilleure_geographie"), (has("HIGH_SCORE_COMPANY_DIFFERS", "STRONG_TITLE_COMPANY_DIFFERS"), "alias_entreprises"),
        (bucket == "INTERMEDIATE", "nouvelle_regle_metier"), (bucket == "CLOSE_CANDIDATES", "aucune_automatisation_sure"), (F.col("generic_title"), "meilleure_normalisation"),
    )
    return decided.filter("decision = 'UNCERTAIN'").select(F.explode(causes).alias("cause")).groupBy("cause").agg(F.count("*").alias("n"))


def uncertainty_bands(decided: DataFrame) -> DataFrame:
    """(report, band, n) of uncertain offers by score, by margin of the best two and by coverage."""
    margin = F.col("score") - F.col("second")
    entries = F.array(*[F.struct(F.lit(n).alias("report"), b.alias("band")) for n, b in (
        ("score", band(F.col("score"), 10)), ("coverage", band(F.col("coverage"), 20)),
        ("margin", F.when(margin.isNull(), "NO_SECOND").when(margin < 2, "0-1").when(margin < 5, "2-4").when(margin < 10, "5-9").otherwise("10_PLUS")))])
    return decided.filter("decision = 'UNCERTAIN'").select(F.explode(entries).alias("e")).groupBy("e.report", "e.band").agg(F.count("*").alias("n"))

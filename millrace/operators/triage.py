"""Triage ladders: does an incoming offer already exist in the other source, and what should a person look at.

A ladder is a list of (condition, outcome); the first condition that holds decides. All inputs are columns of one row per offer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import COMPATIBLE_COMPANIES


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the second ruleset."""

    weak: float = 40.0
    credible: float = 50.0
    strong: float = 75.0
    coverage: int = 80
    margin: float = 5.0
    title: float = 0.85
    title_medium: float = 0.55
    description: float = 0.25


COMPATIBLE_PLACES = ("EXACT_POSTAL_CODE", "SAME_LOCALITY", "SAME_DEPARTMENT")
EXACT_PLACES = COMPATIBLE_PLACES[:2]
INCOMPATIBLE_COMPANIES = ("NO_MATCH", "MISSING", "UNKNOWN")
FINGERPRINT = "EXACT_FINGERPRINT"


def no(c: Column) -> Column:
    """True for null too."""
    return ~F.coalesce(c, F.lit(False))


def yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def ladder(rungs: Sequence[tuple[Column, str, Column | str]], last: tuple[str, Column | str]) -> Column:
    """struct(decision, reasons) of the first rung that holds."""
    listed = lambda r: F.array(F.lit(r)) if isinstance(r, str) else r
    make = lambda d, r: F.struct(F.lit(d).alias("decision"), listed(r).alias("reasons"))
    out = None
    for condition, decision, reasons in rungs:
        c = yes(condition)
        out = F.when(c, make(decision, reasons)) if out is None else out.when(c, make(decision, reasons))
    return out.otherwise(make(*last))


def codes(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(yes(c), F.lit(n)) for c, n in pairs]))


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""


def triage_v1(df: DataFrame) -> Column:
    """First ruleset over title, description, company, postal_code, locality, score, margin, blocks, company_type,
    company_similarity, place_type, title_ratio, description_jaccard."""
    fingerprint, same = F.array_contains("blocks", FINGERPRINT), F.col("company_type").isin("EXACT_NORMALIZED", "ALIAS_MATCH")
    place, score = F.col("place_type"), F.col("score")
    review = codes((F.col("margin") < 5, "AMBIGUOUS_SCORE_MARGIN"), (F.col("company_type").isin(*COMPATIBLE_COMPANIES) & (place == "DIFFERENT"), "COMPANY_MATCH_GEO_DIFFERS"), ((F.col("company_type") == "NO_MATCH") & (score >= 60), "COMPANY_DIFFERS_STRONG_CONTENT"))
    return ladder(
        [
            (blank("title"), "REVIEW", "MISSING_TITLE"),
            (blank("description") & blank("company") & blank("postal_code") & blank("locality"), "REVIEW", "MISSING_DESC_AND_META"),
            (score.isNull(), "NEW", "NO_CANDIDATE"),
            (fingerprint, "DUPLICATE", "EXACT_FINGERPRINT"),
            (F.array_contains("blocks", "COMPACT_TITLE_EXACT") & same & place.isin(*COMPATIBLE_PLACES), "DUPLICATE", "EXACT_TITLE_COMPANY_GEOGRAPHY"),
            ((score >= 75) & (F.col("company_similarity") >= 0.8) & (F.col("title_ratio") >= 0.85) & (place != "DIFFERENT") & (F.col("description_jaccard") >= 0.6), "DUPLICATE", "STRONG_TITLE_DESCRIPTION_COMPANY"),
            ((F.col("title_ratio") == 1) & same & place.isin(*EXACT_PLACES), "DUPLICATE", "EXACT_TITLE_COMPANY_LOCALITY"),
            (score < 30, "NEW", "LOW_BEST_SCORE"),
            (F.size(review) > 0, "REVIEW", review),
        ],
        ("REVIEW", "INTERMEDIATE_SCORE"),
    )


def contradictions(t: Thresholds = Thresholds()) -> Column:
    company, place, title = F.col("company_type"), F.col("place_type"), F.col("title_ratio")
    fits, differs = company.isin(*COMPATIBLE_COMPANIES), company.isin(*INCOMPATIBLE_COMPANIES)
    return codes(
        (fits & (place == "DIFFERENT"), "COMPANY_MATCH_GEO_DIFFERS"), (differs & (F.col("score") >= 60), "HIGH_SCORE_COMPANY_DIFFERS"),
        (differs & (title >= t.title), "STRONG_TITLE_COMPANY_DIFFERS"), (fits & (title < t.title_medium), "COMPANY_MATCH_TITLE_WEAK"), (F.col("description_weighted").isNull(), "DESCRIPTION_UNKNOWN"),
    )


def triage_v2(df: DataFrame, t: Thresholds = Thresholds()) -> Column:
    """Second ruleset; adds to the first's columns: v1_error, excerpt, coverage, second, max_score, generic_title, role,
    description_weighted."""
    score, second, title, desc = F.col("score"), F.col("second"), F.col("title_ratio"), F.col("description_weighted")
    company, place = F.col("company_type"), F.col("place_type")
    fits, differs = company.isin(*COMPATIBLE_COMPANIES), company.isin(*INCOMPATIBLE_COMPANIES) | company.isNull()
    near, generic = place.isin(*COMPATIBLE_PLACES), yes(F.col("generic_title"))
    fingerprint, against = yes(F.array_contains("blocks", FINGERPRINT)), contradictions(t)
    has = lambda *names: F.arrays_overlap(against, F.array(*map(F.lit, names)))
    signals = sum((F.when(yes(c), 1).otherwise(0) for c in (title >= t.title, fits, near, desc >= t.description)), F.lit(0))
    weak_text = desc.isNull() | (desc < t.description)
    return ladder(
        [
            (F.col("v1_error").isNotNull(), "PROCESSING_ERROR", "V1_PROCESSING_ERROR"),
            (blank("title"), "PROCESSING_ERROR", "MISSING_TITLE"),
            (fingerprint & ~generic & ~has("COMPANY_MATCH_GEO_DIFFERS", "HIGH_SCORE_COMPANY_DIFFERS"), "PRESENT", "EXACT_FINGERPRINT"),
            ((score >= t.strong) & (signals >= 3) & (F.size(against) == 0) & ~generic, "PRESENT", "STRONG_SCORE_CONVERGENT_SIGNALS"),
            ((F.col("role") == "RECRUITMENT_INTERMEDIARY") & (score >= t.credible) & (score < t.strong) & (title >= t.title) & (desc >= t.description) & near & ~generic & ~has("COMPANY_MATCH_GEO_DIFFERS", "COMPANY_MATCH_TITLE_WEAK", "DESCRIPTION_UNKNOWN"), "PRESENT", "STRONG_MATCH_VIA_RECRUITMENT_INTERMEDIARY"),
            (blank("excerpt") | (blank("company") & blank("postal_code") & blank("locality")) | (F.coalesce("coverage", F.lit(0)) < t.coverage), "UNCERTAIN", "INSUFFICIENT_DATA"),
            (score.isNull(), "NOT_FOUND", "NO_CANDIDATE"),
            (F.col("max_score") < t.weak, "NOT_FOUND", "ALL_CANDIDATES_WEAK"),
            (score < t.weak, "NOT_FOUND", "LOW_BEST_SCORE"),
            ((score < t.credible) & differs & ~fingerprint & no(fits & near & (title >= t.title_medium)) & weak_text, "NOT_FOUND", "BEST_CANDIDATE_NOT_CREDIBLE"),
            (F.size(against) > 0, "UNCERTAIN", against),
            ((score >= t.credible) & (second >= t.credible) & (score - second < t.margin), "UNCERTAIN", "MULTIPLE_CREDIBLE_CLOSE_CANDIDATES"),
            ((score >= t.weak) & (score < t.credible) & differs, "NOT_FOUND", "INTERMEDIATE_SCORE_WITH_WEAK_SIGNALS"),
            ((score >= t.weak) & (score < t.credible), "UNCERTAIN", "INTERMEDIATE_SCORE"),
            ((score >= t.credible) & (fits | place.isin(*EXACT_PLACES)), "UNCERTAIN", "CREDIBLE_CANDIDATE_NEEDS_REVIEW"),
        ],
        ("NOT_FOUND", "NO_CREDIBLE_CONVERGENCE"),
    )


def _close(t: Thresholds) -> Column:
    return yes((F.col("score") >= t.credible) & (F.col("second") >= t.credible) & (F.col("score") - F.col("second") < t.margin))


def review_priority(t: Thresholds = Thresholds()) -> Column:
    """HAUTE, MOYENNE, FAIBLE, or HORS_REVUE for decided offers; needs decision and reasons."""
    score, company = F.col("score"), F.col("company_type")
    high = yes((score >= 60) & company.isin("NO_MATCH", "MISSING")) | yes((F.col("title_ratio") >= t.title) & F.col("place_type").isin(*EXACT_PLACES)) | yes(F.col("role").isin("RECRUITMENT_INTERMEDIARY", "POSSIBLE_INTERMEDIARY")) | _close(t) | yes(F.array_contains("reasons", "STRONG_TITLE_COMPANY_DIFFERS"))
    return F.when(F.col("decision") != "UNCERTAIN", "HORS_REVUE").when(high, "HAUTE").when(yes(score >= t.credible) | F.array_contains("reasons", "INSUFFICIENT_DATA"), "MOYENNE").otherwise("FAIBLE")


def review_action(t: Thresholds = Thresholds()) -> Column:
    """NO_MANUAL_REVIEW, REVIEW_NOW or DEFER_DATA_INCOMPLETE; needs decision, reasons, v1_decision, common_skills."""
    fits = F.col("company_type").isin(*COMPATIBLE_COMPANIES)
    promising = yes(F.col("title_ratio") >= t.title) & (yes(F.col("place_type").isin(*COMPATIBLE_PLACES)) | yes(F.col("description_weighted") >= t.description) | yes(F.col("common_skills")) | yes(fits) | yes(F.col("role") == "RECRUITMENT_INTERMEDIARY"))
    defer = F.array_contains("reasons", "INSUFFICIENT_DATA") & no(F.col("score") >= t.credible) & no(F.array_contains("blocks", FINGERPRINT)) & no(F.col("v1_decision") == "DUPLICATE") & no(F.col("role") == "RECRUITMENT_INTERMEDIARY") & no(fits) & ~_close(t) & ~promising & ~F.arrays_overlap("reasons", F.array(F.lit("HIGH_SCORE_COMPANY_DIFFERS"), F.lit("STRONG_TITLE_COMPANY_DIFFERS")))
    return F.when(F.col("decision") != "UNCERTAIN", "NO_MANUAL_REVIEW").when(defer, "DEFER_DATA_INCOMPLETE").otherwise("REVIEW_NOW")


def audit_priority() -> Column:
    score, company = F.col("score"), F.col("company_type")
    title_points = 45 * 0.25 * (F.col("title_ratio") + F.col("title_jaccard") + F.col("title_weighted") + F.col("title_compact"))
    high = (score >= 65) | ((F.col("margin") < 5) & (score >= 50)) | ((title_points >= 36) & (company == "NO_MATCH")) | (company.isin(*COMPATIBLE_COMPANIES) & (F.col("place_type") == "DIFFERENT"))
    return F.when(yes(high), "HIGH").when(yes(score >= 40), "MEDIUM").otherwise("LOW")


def company_comparison() -> Column:
    """struct(result, role, message): the company comparison in view of who advertises."""
    via = F.col("role").isin("RECRUITMENT_INTERMEDIARY", "POSSIBLE_INTERMEDIARY")
    result = F.when(F.col("company_type").isin(*COMPATIBLE_COMPANIES), "COMPATIBLE").when(F.col("company_type") == "MISSING", "UNKNOWN").when(via, "DIFFERENT_VIA_INTERMEDIARY").otherwise("DIFFERENT")
    return F.struct(result.alias("result"), F.col("role"), F.concat_ws(" / ", F.col("company"), F.col("best_company")).alias("message"))


def decision_record(df: DataFrame) -> DataFrame:
    """Adds v1, v2, contradictions, priority and action to one row per offer."""
    d = df.withColumn("v1", triage_v1(df)).withColumn("v2", triage_v2(df)).withColumn("contradictions", contradictions())
    d = d.withColumn("v1_decision", F.col("v1.decision")).withColumn("decision", F.col("v2.decision")).withColumn("reasons", F.col("v2.reasons"))
    return d.withColumn("priority", review_priority()).withColumn("action", review_action()).withColumn("audit_priority", audit_priority())


def review_queue(decided: DataFrame) -> DataFrame:
    """Uncertain offers to review now, most urgent first."""
    rank = F.when(F.col("priority") == "HAUTE", 0).when(F.col("priority") == "MOYENNE", 1).when(F.col("priority") == "FAIBLE", 2).otherwise(3)
    return decided.filter("decision = 'UNCERTAIN' AND action = 'REVIEW_NOW'").orderBy(rank, F.desc("score"), "id")


def audit_queue(decided: DataFrame) -> DataFrame:
    """Every offer by audit priority (HIGH, MEDIUM, LOW), then score, offers without a candidate as 0, then id."""
    rank = F.when(F.col("audit_priority") == "HIGH", 0).when(F.col("audit_priority") == "MEDIUM", 1).when(F.col("audit_priority") == "LOW", 2).otherwise(3)
    return decided.orderBy(rank, F.desc(F.coalesce("score", F.lit(0))), "id")


def import_candidates(decided: DataFrame) -> DataFrame:
    return decided.filter("decision = 'NOT_FOUND' AND id IS NOT NULL AND trim(title) <> ''").select("id", "title", "company", "reasons")


def transition_matrix(decided: DataFrame) -> DataFrame:
    return decided.groupBy("v1_decision", "decision").agg(F.count("*").alias("n"))


def uncertainty_bucket() -> Column:
    r = F.col("reasons")
    return F.when(F.col("decision") != "UNCERTAIN", "DECIDED").when(F.array_contains(r, "INSUFFICIENT_DATA"), "MISSING_DATA").when(F.arrays_overlap(r, F.array(F.lit("COMPANY_MATCH_GEO_DIFFERS"), F.lit("HIGH_SCORE_COMPANY_DIFFERS"), F.lit("STRONG_TITLE_COMPANY_DIFFERS"))), "CONTRADICTION").when(F.array_contains(r, "MULTIPLE_CREDIBLE_CLOSE_CANDIDATES"), "CLOSE_CANDIDATES").otherwise("INTERMEDIATE")

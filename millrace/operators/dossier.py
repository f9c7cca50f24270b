"""The dossier that a reviewer gets of an offer and its best candidate: comparisons, agreements, cautions, why it is to be reviewed,
and a sheet of thirty columns. All of it is codes of one row; what a code says is a mapping that a user may replace.

Takes rows of triage.decision_record, with occupation_match where it is known."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import COMPATIBLE_COMPANIES
from .triage import COMPATIBLE_PLACES, Thresholds, _close, codes, yes

#: What codes say. Pass another mapping for another language.
TEXTS = {
    "SAME_TITLE": "the titles are the same or nearly so", "NEAR_TITLE": "the titles agree in part", "OTHER_TITLE": "the titles differ", "NO_TITLE": "no title to compare",
    "SAME_COMPANY": "the company is the same", "ALIAS_COMPANY": "the companies are one under two names", "NEAR_COMPANY": "the companies' names are close", "VIA_INTERMEDIARY": "different companies, one of them recruits for others", "OTHER_COMPANY": "the companies differ",
    "SAME_POSTAL_CODE": "the postal code is the same", "SAME_PLACE": "the place is the same", "SAME_DEPARTMENT": "both are in one department", "OTHER_PLACE": "the places differ", "NO_PLACE": "no place to compare",
    "SAME_TEXT": "the descriptions are much alike", "NEAR_TEXT": "the descriptions agree in part", "OTHER_TEXT": "the descriptions have little in common", "NO_TEXT": "no description to compare",
    "SAME_OCCUPATION": "the occupation is the same", "OTHER_OCCUPATION": "the occupation differs or is unknown", "CLOSE_CANDIDATES": "several candidates are nearly as good",
    "FIRST_RULESET_DUPLICATE": "the first ruleset was sure of a duplicate", "CREDIBLE_SCORE": "the score is credible", "STRONG_TITLE_WITH_MORE": "a strong title with another signal", "STRONG_TITLE": "a strong title alone", "COMPANY_FITS": "the company fits", "INTERMEDIARY": "an intermediary is proven",
    "CONTRADICTION": "title and company contradict each other", "MODERATE_SIGNAL": "no strong signal either way", "DATA_INCOMPLETE": "too little is known to compare", "DECIDED": "decided without review",
    "PRESENT": "the offer is probably there already", "NOT_FOUND": "the offer is probably not there", "UNCERTAIN": "it is uncertain whether the offer is there", "PROCESSING_ERROR": "the offer could not be processed", "NO_CANDIDATE": "there is no candidate",
    "HAUTE": "review first", "MOYENNE": "review in turn", "FAIBLE": "review last", "HORS_REVUE": "nothing to do",
}


def in_words(code: Column, texts: Mapping[str, str] = TEXTS) -> Column:
    """What a code, or each of an array of codes, says."""
    said = F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])
    return F.coalesce(F.try_element_at(said, code), code)


def comparisons(t: Thresholds = Thresholds()) -> dict[str, Column]:
    """Codes for title, company, place, description and occupation of the best candidate."""
    title, text, company, place = (F.col(c) for c in ("title_ratio", "description_weighted", "company_type", "place_type"))
    return {
        "title": F.when(title.isNull(), "NO_TITLE").when(title >= t.title, "SAME_TITLE").when(title >= t.title_medium, "NEAR_TITLE").otherwise("OTHER_TITLE"),
        "company": F.when(company == "EXACT_NORMALIZED", "SAME_COMPANY").when(company == "ALIAS_MATCH", "ALIAS_COMPANY").when(company.isin(*COMPATIBLE_COMPANIES), "NEAR_COMPANY").when(F.col("role") == "RECRUITMENT_INTERMEDIARY", "VIA_INTERMEDIARY").otherwise("OTHER_COMPANY"),
        "place": F.when(place == "EXACT_POSTAL_CODE", "SAME_POSTAL_CODE").when(place == "SAME_LOCALITY", "SAME_PLACE").when(place == "SAME_DEPARTMENT", "SAME_DEPARTMENT").when(place == "DIFFERENT", "OTHER_PLACE").otherwise("NO_PLACE"),
        "text": F.when(text.isNull(), "NO_TEXT").when(text >= 2 * t.description, "SAME_TEXT").when(text >= t.description, "NEAR_TEXT").otherwise("OTHER_TEXT"),
        "occupation": F.when(yes(F.col("occupation_match")), "SAME_OCCUPATION").otherwise("OTHER_OCCUPATION"),
    }


def action_reasons(t: Thresholds = Thresholds()) -> Column:
    """Why an offer is to be reviewed now, or why not: an array of codes; needs action."""
    title = yes(F.col("title_ratio") >= t.title)
    fits, via = yes(F.col("company_type").isin(*COMPATIBLE_COMPANIES)), yes(F.col("role") == "RECRUITMENT_INTERMEDIARY")
    more = yes(F.col("place_type").isin(*COMPATIBLE_PLACES)) | yes(F.col("description_weighted") >= t.description) | yes(F.col("common_skills")) | fits | via
    contradicts = F.arrays_overlap("reasons", F.array(F.lit("HIGH_SCORE_COMPANY_DIFFERS"), F.lit("STRONG_TITLE_COMPANY_DIFFERS")))
    now = codes((F.col("v1_decision") == "DUPLICATE", "FIRST_RULESET_DUPLICATE"), (F.col("score") >= t.credible, "CREDIBLE_SCORE"), (title & more, "STRONG_TITLE_WITH_MORE"), (title & ~more, "STRONG_TITLE"), (fits, "COMPANY_FITS"), (via, "INTERMEDIARY"), (_close(t), "CLOSE_CANDIDATES"), (contradicts, "CONTRADICTION"))
    alone = lambda c: F.array(F.lit(c))
    return F.when(F.col("action") == "NO_MANUAL_REVIEW", alone("DECIDED")).when(F.col("action") == "DEFER_DATA_INCOMPLETE", alone("DATA_INCOMPLETE")).when(F.size(now) == 0, alone("MODERATE_SIGNAL")).otherwise(now)


def with_dossier(decided: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds compared (struct of codes), agreeing and cautions (arrays of codes), action_reasons and summary."""
    d = decided if "occupation_match" in decided.columns else decided.withColumn("occupation_match", F.lit(None).cast("boolean"))
    d = d.withColumn("compared", F.struct(*[c.alias(n) for n, c in comparisons(t).items()]))
    of = lambda n: F.col(f"compared.{n}")
    fits, via, near = yes(F.col("company_type").isin(*COMPATIBLE_COMPANIES)), of("company") == "VIA_INTERMEDIARY", yes(F.col("place_type").isin(*COMPATIBLE_PLACES))
    agreeing = codes((of("title").isin("SAME_TITLE", "NEAR_TITLE"), "title"), (fits | via, "company"), (near, "place"), (of("text").isin("SAME_TEXT", "NEAR_TEXT"), "text"))
    cautions = codes((~fits & ~via, "company"), (of("place") == "OTHER_PLACE", "place"), (of("text") == "OTHER_TEXT", "text"))
    named = lambda names: F.transform(names, lambda n: F.when(n == "title", of("title")).when(n == "company", of("company")).when(n == "place", of("place")).otherwise(of("text")))
    several = F.when(F.array_contains("reasons", "MULTIPLE_CREDIBLE_CLOSE_CANDIDATES"), F.array(F.lit("CLOSE_CANDIDATES"))).otherwise(F.array().cast("array<string>"))
    return d.withColumns({"agreeing": named(agreeing), "cautions": F.concat(named(cautions), several), "action_reasons": action_reasons(t), "summary": F.when(F.col("score").isNull(), "NO_CANDIDATE").otherwise(F.col("decision"))})


#: The sheet's columns; the last four are for the reviewer and stay blank.
SHEET = (
    "priority", "id", "decision", "reasons", "score", "coverage", "title", "company", "place", "skills", "soft_skills", "excerpt", "best_id", "best_title", "best_company", "best_place", "best_occupation", "title_compared", "company_compared",
    "place_compared", "text_compared", "occupation_compared", "summary", "agreeing", "cautions", "advice", "human_decision", "human_comment", "checked_by", "checked_on",
)


def review_sheet(queue: DataFrame, texts: Mapping[str, str] = TEXTS) -> DataFrame:
    """The thirty columns of SHEET, all texts, for rows of with_dossier. Columns that the queue lacks are blank; skills are arrays
    of names."""
    has = lambda c: F.col(c) if c in queue.columns else F.lit(None).cast("string")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    listed = lambda c: F.array_join(F.filter(F.col(c), lambda s: F.coalesce(s, F.lit("")) != ""), " | ") if c in queue.columns else F.lit("")
    said = lambda c: F.array_join(F.transform(c, lambda x: in_words(x, texts)), " | ")
    one_line = lambda c: F.trim(F.translate(blank(c), "\r\n", "  "))
    values = {
        "priority": F.col("priority"), "id": F.col("id"), "decision": F.col("decision"), "reasons": F.array_join("reasons", "; "), "score": F.concat(F.bround(F.coalesce("score", F.lit(0.0))).cast("int").cast("string"), F.lit("/100")),
        "coverage": F.concat(blank(F.coalesce(has("coverage"), F.lit(0))), F.lit("%")), "title": blank(has("title")), "company": blank(has("company")), "place": F.concat_ws(" ", F.nullif(blank(has("postal_code")), F.lit("")), F.nullif(blank(has("locality")), F.lit(""))),
        "skills": listed("skills"), "soft_skills": listed("soft_skills"), "excerpt": one_line(has("excerpt")), "best_id": blank(has("best_b")), "best_title": blank(has("best_title")), "best_company": blank(has("best_company")), "best_place": blank(has("best_postal_code")),
        "best_occupation": blank(has("best_code")), **{f"{n}_compared": in_words(F.col(f"compared.{n}"), texts) for n in ("title", "company", "place", "text", "occupation")}, "summary": in_words(F.col("summary"), texts), "agreeing": said("agreeing"), "cautions": said("cautions"),
        "advice": in_words(F.col("priority"), texts), **{c: F.lit("") for c in SHEET[-4:]},
    }
    return queue.select(*[F.coalesce(values[c], F.lit("")).alias(c) for c in SHEET])

"""Dossiers of cases at each limit, by hand."""

from pyspark.sql import functions as F

from millrace.operators import dossier

CASE = "id string, title string, company string, postal_code string, score double, second double, coverage int, title_ratio double, description_weighted double, company_type string, place_type string, role string, common_skills boolean, occupation_match boolean, v1_decision string, decision string, reasons array<string>, priority string, action string, skills array<string>, excerpt string"


def case(**changes):
    base = dict(id="1", title="t", company="c", postal_code="75001", score=55.5, second=None, coverage=85, title_ratio=0.5, description_weighted=0.1, company_type="NO_MATCH", place_type="UNKNOWN", role="DIRECT_EMPLOYER", common_skills=False, occupation_match=None,
                v1_decision="REVIEW", decision="UNCERTAIN", reasons=["A", "B"], priority="MOYENNE", action="REVIEW_NOW", skills=["x", "", None, "y"], excerpt=" a\r\nb ")
    return tuple((base | changes)[c.split()[0]] for c in CASE.split(", "))


def test_every_limit(spark):
    rows = [
        case(id="a"), case(id="b", title_ratio=0.85, description_weighted=0.5, company_type="ALIAS_MATCH", place_type="SAME_LOCALITY", occupation_match=True, v1_decision="DUPLICATE", second=51.0, reasons=["MULTIPLE_CREDIBLE_CLOSE_CANDIDATES"]),
        case(id="c", title_ratio=0.8499, description_weighted=0.25, company_type="HIGH_SIMILARITY", place_type="DIFFERENT", score=49.99), case(id="d", title_ratio=None, description_weighted=None, role="RECRUITMENT_INTERMEDIARY", score=None, decision="NOT_FOUND", action="NO_MANUAL_REVIEW"),
        case(id="e", title_ratio=0.9, score=10.0, reasons=["STRONG_TITLE_COMPANY_DIFFERS"]), case(id="f", score=10.0, action="DEFER_DATA_INCOMPLETE"), case(id="g", score=10.0, company_type=None, place_type=None, role=None),
    ]
    got = {r.id: (tuple(r.compared), r.agreeing, r.cautions, r.action_reasons, r.summary) for r in dossier.with_dossier(spark.createDataFrame(rows, CASE)).collect()}
    assert got["a"] == (("OTHER_TITLE", "OTHER_COMPANY", "NO_PLACE", "OTHER_TEXT", "OTHER_OCCUPATION"), [], ["OTHER_COMPANY", "OTHER_TEXT"], ["CREDIBLE_SCORE"], "UNCERTAIN")
    assert got["b"] == (("SAME_TITLE", "ALIAS_COMPANY", "SAME_PLACE", "SAME_TEXT", "SAME_OCCUPATION"), ["SAME_TITLE", "ALIAS_COMPANY", "SAME_PLACE", "SAME_TEXT"], ["CLOSE_CANDIDATES"], ["FIRST_RULESET_DUPLICATE", "CREDIBLE_SCORE", "STRONG_TITLE_WITH_MORE", "COMPANY_FITS", "CLOSE_CANDIDATES"], "UNCERTAIN")
    assert got["c"] == (("NEAR_TITLE", "NEAR_COMPANY", "OTHER_PLACE", "NEAR_TEXT", "OTHER_OCCUPATION"), ["NEAR_TITLE", "NEAR_COMPANY", "NEAR_TEXT"], ["OTHER_PLACE"], ["COMPANY_FITS"], "UNCERTAIN")
    assert got["d"] == (("NO_TITLE", "VIA_INTERMEDIARY", "NO_PLACE", "NO_TEXT", "OTHER_OCCUPATION"), ["VIA_INTERMEDIARY"], [], ["DECIDED"], "NO_CANDIDATE")
    assert got["e"][3] == ["STRONG_TITLE", "CONTRADICTION"] and got["f"][3] == ["DATA_INCOMPLETE"] and got["g"][3] == ["MODERATE_SIGNAL"] and got["g"][2] == ["OTHER_COMPANY", "OTHER_TEXT"]


def test_sheet(spark):
    texts = dossier.TEXTS | {"OTHER_TITLE": "autre titre"}
    row = dossier.review_sheet(dossier.with_dossier(spark.createDataFrame([case()], CASE)), texts).first()
    assert tuple(row.asDict()) == dossier.SHEET and len(dossier.SHEET) == 30 and None not in row
    assert (row.score, row.coverage, row.reasons, row.skills, row.excerpt, row.title_compared, row.place, row.advice) == ("56/100", "85%", "A; B", "x | y", "a  b", "autre titre", "75001", dossier.TEXTS["MOYENNE"])
    assert row.cautions == f"{dossier.TEXTS['OTHER_COMPANY']} | {dossier.TEXTS['OTHER_TEXT']}" and [row[c] for c in dossier.SHEET[-4:]] == [""] * 4


def test_every_code_has_words(spark):
    df = spark.createDataFrame([(c,) for c in [*dossier.TEXTS, "unknown"]], "c string").select("c", dossier.in_words(F.col("c")).alias("w"))
    assert {r.c: r.w for r in df.collect()} == dossier.TEXTS | {"unknown": "unknown"}

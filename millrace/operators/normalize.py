"""Raw offers to normalised ones: clean texts, flat places and salaries, unique skills, provenance, payload hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text


def unique_skills(skills: Column) -> Column:
    """Skills once each, by id or else by folded name, the first of equal ones; sorted by name, id, slug, ref."""
    e = lambda c: F.coalesce(c, F.lit(""))
    keyed = F.transform(F.coalesce(skills, F.array()), lambda s, i: F.struct(F.when(e(s["source_skill_id"]) != "", F.concat(F.lit("i:"), s["source_skill_id"])).otherwise(F.concat(F.lit("n:"), e(s["name_normalized"]))).alias("k"), i.alias("i"), s.alias("s")))
    keys = F.transform(keyed, lambda x: x["k"])
    first = F.filter(keyed, lambda x: F.array_position(keys, x["k"]) == x["i"] + 1)
    order = F.array_sort(F.transform(first, lambda x: F.struct(e(x["s"]["name_normalized"]).alias("a"), e(x["s"]["source_skill_id"]).alias("b"), e(x["s"]["slug"]).alias("c"), e(x["s"]["source_ref"]).alias("d"), x["i"].alias("i"), x["s"].alias("s"))))
    return F.transform(order, lambda x: x["s"])


def unique_texts(values: Column) -> Column:
    """Trimmed, non-blank, distinct, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.trim(v)), lambda v: v != "")))


def skill_names(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, skills): each row's raw skills cleaned; names go through the folding function as one flat column."""
    e = df.select(key, F.posexplode(column).alias("i", "s"))
    name = text.clean_text(F.col("s.name"))
    one = e.select(key, "i", F.struct(F.col("s.id").cast("string").alias("source_skill_id"), F.col("s.@id").alias("source_ref"), name.alias("name"), text.skill_key(F.col("s.name")).alias("name_normalized"), F.col("s.slug").alias("slug"), F.col("s.displayed").alias("displayed")).alias("s"))
    lists = one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("x"))
    return lists.select(key, unique_skills(F.transform("x", lambda v: v["s"])).alias(column))


def normalize_offers(raw: DataFrame, source: str = "offers") -> DataFrame:
    """raw(id, offer, queries): one normalised row for each offer. Skills come back by a join on the id."""
    o = lambda n: F.col(f"offer.{n}")
    flat = raw.select(
        F.lit(source).alias("source"), F.col("id").alias("source_id"), text.clean_text(o("title")).alias("title"), text.html_text(o("description")).alias("description"), text.html_text(o("candidateProfile")).alias("candidate_profile"),
        text.html_text(o("companyDescription")).alias("company_description"), text.clean_text(o("company.name")).alias("company_name"),
        F.struct(text.clean_text(o("location.locality")).alias("locality"), text.clean_text(o("location.postalCode")).alias("postal_code"), text.clean_text(o("location.adminLevel1")).alias("region"), text.clean_text(o("location.country")).alias("country")).alias("location"),
        unique_texts(o("contracts")).alias("contracts"), o("remoteMode").alias("remote_mode"), o("experienceLevel").alias("experience_level"),
        F.struct(o("minAnnualSalary").alias("annual_min"), o("maxAnnualSalary").alias("annual_max"), o("minDailySalary").alias("daily_min"), o("maxDailySalary").alias("daily_max"), o("currency").alias("currency")).alias("salary"),
        o("publishedAt").alias("published_at"), o("updatedAt").alias("updated_at"), o("expiredAt").alias("expires_at"), F.sha2(F.to_json("offer", {"ignoreNullFields": "false"}), 256).alias("raw_payload_sha256"),
    )
    for column in ("skills", "softSkills"):
        flat = flat.join(skill_names(raw.select("id", o(column).alias(column)), column, "id").withColumnRenamed("id", "source_id"), "source_id", "left")
    return flat.withColumnRenamed("softSkills", "soft_skills")


def merge_queries(raw: DataFrame, key: str = "id", query: str = "query") -> DataFrame:
    """(key, queries): every query that found an offer, each once, sorted."""
    return raw.groupBy(key).agg(F.array_sort(F.collect_set(query)).alias("queries"))


def known_offers(raw: DataFrame) -> DataFrame:
    """Payloads of the known source as flat rows: three texts trimmed, empty ones null; codes as they are."""
    o = lambda n: F.col(f"offer.{n}")
    tidy = lambda n: F.when(o(n) != "", F.trim(o(n)))
    return raw.select(
        o("id").alias("id"), o("intitule").alias("title"), tidy("description").alias("description"), o("lieuTravail.codePostal").alias("postal_code"),
        o("romeCode").alias("occupation"), o("romeLibelle").alias("occupation_label"), tidy("appellationlibelle").alias("appellation"), tidy("entreprise.nom").alias("company"),
    )

"""Training courses, their monthly flows, occupations and skills."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.geo import REGIONS, UNKNOWN_REGION, region_of_postal
from millrace.functions.scores import quarter
from millrace.operators.pairs import meet
from millrace.sources.tables import table


def clean_courses(df: DataFrame, code: str = "code_rncp", none: str = "-1", prefix: str = "RNCP", drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a certification code (or a null one), the prefix taken off, unneeded columns dropped."""
    return df.filter(~F.col(code).eqNullSafe(none)).withColumn(code, F.replace(F.col(code), F.lit(prefix), F.lit(""))).drop(*drop)


def join_occupations(courses: DataFrame, occupations: DataFrame, on: str = "code_rncp", entries: str = "entrees_formation", code: str = "code_rome", family: str = "M", null_safe: bool = False) -> DataFrame:
    """Courses with each occupation of one family, entries above 0. null_safe: null codes meet, as in a data frame library."""
    o = occupations.filter(F.col(code).startswith(family)).withColumnRenamed(on, "__on")
    match = courses[on].eqNullSafe(o["__on"]) if null_safe else courses[on] == o["__on"]
    return courses.join(o, match).drop("__on").filter(F.col(entries) > 0)


def dominant(df: DataFrame, group: list[str], value: str, measure: str) -> DataFrame:
    """The value with the largest sum in each group; the least value of equal ones."""
    sums = df.groupBy(*group, value).agg(F.sum(measure).alias("total"))
    return sums.groupBy(*group).agg(F.min_by(value, F.struct(-F.col("total"), F.col(value))).alias(value), F.max("total").alias("total"))


def enrich(courses: DataFrame, organisations: DataFrame, modality: DataFrame, siret: str = "siret_of_contractant", code: str = "code_rncp") -> DataFrame:
    """Courses with their organisation and their dominant modality, where known."""
    return courses.join(organisations, courses[siret] == organisations["siret"], "left").drop(organisations["siret"]).join(modality, code, "left")


def flow_history(flows: DataFrame, offers: DataFrame | None = None, region: str | None = None, quarter_: str | None = None, region_keys: tuple[str, ...] | None = None, double_entries: bool = False) -> DataFrame:
    """Entries and exits by region and quarter, with the totals of each region and of all, in one pass of grouping sets.

    flows(region, year, month, entries, partial, total); offers(region, n). Levels: 'quarter', 'region', 'all'. The total of all
    comes only without a filter. Rows without year, month or entries are left out, missing exits count as 0. double_entries
    counts entries twice, as an older system did."""
    if quarter_ is not None and not re.fullmatch(r"\d{4}-T[1-4]", quarter_):
        raise ValueError(f"not a quarter: {quarter_}")
    keys = region_keys or tuple(re.sub("[-' ]", "", r.lower()) for r in REGIONS)
    if region is not None and (region not in keys or region == UNKNOWN_REGION):
        raise ValueError(f"not a region: {region}")
    f = flows.dropna(subset=["year", "month", "entries"]).withColumn("quarter", quarter(F.col("year"), F.col("month")))
    if region is not None:
        f = f.filter(F.col("region") == region)
    if quarter_ is not None:
        f = f.filter(F.col("quarter") == quarter_)
    f = f.select("region", "quarter", (F.col("entries") * (2 if double_entries else 1)).alias("entries"), F.coalesce("partial", F.lit(0)).alias("partial"), F.coalesce("total", F.lit(0)).alias("total"))
    sums = f.groupingSets([["region", "quarter"], ["region"], []], "region", "quarter").agg(F.sum("entries").alias("entries"), F.sum("partial").alias("partial"), F.sum("total").alias("total"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, "quarter").when(F.col("gid") == 1, "region").otherwise("all")
    out = sums.select(level.alias("level"), "region", "quarter", "entries", "partial", "total")
    if region is not None or quarter_ is not None:
        out = out.filter("level <> 'all'")
    if offers is None:
        return out
    # offers of regions without flows count for all, and have no row of their own
    n = offers.groupBy("region").agg(F.sum("n").alias("n"))
    n = n.select(F.lit("region").alias("l"), F.col("region").alias("r"), "n").unionByName(n.select(F.lit("all").alias("l"), F.lit(None).cast("string").alias("r"), "n").groupBy("l", "r").agg(F.sum("n").alias("n")))
    joined = out.join(n, (out["level"] == n["l"]) & out["region"].eqNullSafe(n["r"]), "left")
    return joined.select("level", "region", "quarter", "entries", "partial", "total", F.when(F.col("level") != "quarter", F.coalesce("n", F.lit(0))).alias("offers"))


def offers_by_region(offers: DataFrame, postal: str = "postal_code") -> DataFrame:
    """Offers counted by postal code, then by the region of its prefix; offers without a code are left out."""
    by_code = offers.filter(F.col(postal).isNotNull()).groupBy(postal).agg(F.count("*").alias("n"))
    return by_code.groupBy(region_of_postal(F.col(postal)).alias("region")).agg(F.sum("n").alias("n"))


def courses_for_offer(links: DataFrame, by_occupation: DataFrame, once: bool = False) -> DataFrame:
    """Linked courses first, then the courses of the offer's occupation that aren't linked: (offer, course, via).

    once: by_occupation has each pair once already."""
    links, pairs = links.select("offer", "course").distinct(), by_occupation.select("offer", "course")
    more = (pairs if once else pairs.distinct()).join(links, ["offer", "course"], "left_anti")
    return links.withColumn("via", F.lit("link")).unionByName(more.withColumn("via", F.lit("occupation")))


def courses_of_occupations(links: DataFrame, occupations: DataFrame, courses: DataFrame, occupation: str) -> DataFrame:
    """courses_for_offer(links, occupations.join(courses, occupation)), for distinct occupations(offer, occupation) and
    courses(course, occupation).

    An offer brings its linked courses of an occupation along, so its pairs are left out where they are made: none is moved. To each
    cell of a hot occupation it brings those that are dealt there."""
    links, courses = links.select("offer", "course").distinct(), courses.select("course", occupation)
    linked = links.join(courses, "course").groupBy("offer", occupation).agg(F.collect_list("course").alias("linked"))  # as many as the offer has links
    own = occupations.select("offer", occupation).join(linked, ["offer", occupation], "left")
    more = meet(table(own), table(courses), occupation, "offer", "course", partners="linked").filter(~F.coalesce(F.array_contains("linked", F.col("course")), F.lit(False)))
    return links.withColumn("via", F.lit("link")).unionByName(more.select("offer", "course", F.lit("occupation").alias("via")))


def best_skills(offer_skills: DataFrame, label: str = "label", least: int = 2) -> DataFrame:
    """Labels that at least two links name, with their number."""
    return offer_skills.groupBy(label).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def first_by_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The columns of each key's first row in the given order; without a sort."""
    return df.groupBy(*keys).agg(*[F.min_by(F.struct(*columns), F.struct(*order)).alias("__first")]).select(*keys, "__first.*")


def insert_missing(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows to insert: the first row of each key that doesn't exist yet."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return incoming.withColumn("__n", rank).filter("__n = 1").drop("__n").join(existing.select(*keys).distinct(), keys, "left_anti")


def link_rows(existing: DataFrame, new: DataFrame, pair: tuple[str, str]) -> DataFrame:
    """Existing and new links, each once."""
    return existing.select(*pair).unionByName(new.select(*pair)).dropDuplicates(list(pair))

"""Imports into keyed tables: rows by natural key, children and links, in batches that can be repeated.

A table is a log of changes (streaming.ingest.Versions): an import writes the rows that it adds or fills in, never the table. A
batch reads what was there before it, so a batch that failed and is repeated adds the same rows under the same ids. Rows of one
key within a batch are one row: its first in the batch's order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.streaming.ingest import Versions

from .ordering import numbered
from .training import first_by_key


class Target:
    """A table to import into: its natural key, the name of its surrogate ids (none if null) and its schema."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str | Sequence[str], surrogate: str | None = "id"):
        self.log, self.key, self.surrogate = Versions(spark, root), [key] if isinstance(key, str) else list(key), surrogate
        self.empty = spark.createDataFrame([], schema)

    def rows(self, batch: int | None = None) -> DataFrame:
        """The table, or what it was before a batch."""
        found = self.log.before(batch)
        return self.empty if found is None else found.select(*self.empty.columns)

    def merge(self, incoming: DataFrame, batch: int, order: Sequence[str], fill: Sequence[str] = ()) -> dict[str, int]:
        """Insert keys that the table lacks; `fill` names columns that an existing row takes over where it has none. New rows are
        numbered on from the table's greatest surrogate id, in the order of their keys. Rows with a null in their key are left
        out. Gives the numbers of rows imported, skipped, filled and left out, as observed while they were written."""
        self.log.unite(batch)
        columns = [c for c in self.empty.columns if c not in (*self.key, self.surrogate)]
        keyed = F.lit(True)
        for k in self.key:
            keyed = keyed & F.col(k).isNotNull()
        whole = incoming.filter(keyed)
        first = first_by_key(whole, self.key, list(order), [c for c in columns if c not in fill]) if [c for c in columns if c not in fill] else whole.select(*self.key).distinct()
        for c in fill:  # the first row that has a value gives it
            given = whole.filter(F.col(c).isNotNull()).groupBy(*self.key).agg(F.min_by(c, F.struct(*order)).alias(c))
            first = first.join(given, self.key, "left")
        old = self.rows(batch)
        new = first.join(old.select(*self.key), self.key, "left_anti")
        if self.surrogate:
            start = old.agg(F.coalesce(F.max(self.surrogate), F.lit(0))).first()[0]
            new = numbered(new, self.key, "__place").withColumn(self.surrogate, (F.col("__place") + start + 1).cast(self.empty.schema[self.surrogate].dataType))
        written = new.select(*self.empty.columns).withColumn("__new", F.lit(True))
        if fill:
            held = old.join(first.select(*self.key, *[F.col(c).alias(f"__{c}") for c in fill]), self.key)
            lacks = F.lit(False)
            for c in fill:
                lacks = lacks | F.col(c).isNull() & F.col(f"__{c}").isNotNull()
            held = held.filter(lacks).withColumns({c: F.coalesce(c, f"__{c}") for c in fill})
            written = written.unionByName(held.select(*self.empty.columns).withColumn("__new", F.lit(False)))
        seen = Observation()
        self.log.write(written.observe(seen, F.count_if("__new").alias("imported"), F.count_if(~F.col("__new")).alias("filled")).drop("__new"), self.key, batch)
        counts = dict(seen.get)
        n = incoming.agg(F.count("*").alias("all"), F.count_if(keyed).alias("keyed")).first()
        return counts | {"skipped": n["keyed"] - counts["imported"], "left_out": n["all"] - n["keyed"]}


def first_code(codes: Column) -> Column:
    """The first code that isn't blank, trimmed."""
    return F.try_element_at(F.filter(F.transform(codes, lambda c: F.trim(c)), lambda c: c != ""), F.lit(1))


def skill_code(skill: Column) -> Column:
    """A skill's id as text, else its slug; null if both are blank."""
    return F.coalesce(F.nullif(F.trim(skill["id"]), F.lit("")), F.nullif(F.trim(skill["slug"]), F.lit("")))


class OfferImport:
    """Offers, occupation codes, skills and the links of offers to skills, under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.offers = Target(spark, f"{root}/offers", "offer_id long, source_id string, title string, description string, postal_code string, company string, occupation string", "source_id", "offer_id")
        self.occupations = Target(spark, f"{root}/occupations", "occupation_id long, code string", "code", "occupation_id")
        self.skills = Target(spark, f"{root}/skills", "skill_id long, code string, label string", "code", "skill_id")
        self.links = Target(spark, f"{root}/links", "offer_id long, skill_id long", ("offer_id", "skill_id"), None)

    def run(self, items: DataFrame, batch: int, order: str = "place") -> dict[str, int]:
        """Import items(source_id, title, description, postal_code, company, codes array<string>, skills array<struct<id, slug,
        name>>, order). An offer that exists is skipped but gets an occupation if it has none, and links that it lacks."""
        rows = items.withColumn("occupation", first_code(F.col("codes")))
        counts = self.offers.merge(rows.select(*self.offers.empty.drop("offer_id").columns, order), batch, [order], fill=["occupation"])
        self.occupations.merge(rows.select(F.col("occupation").alias("code"), order), batch, [order])
        skills = items.select("source_id", order, F.posexplode("skills").alias("at", "skill")).select("source_id", order, "at", skill_code(F.col("skill")).alias("code"), F.col("skill.name").alias("label"))
        counts["new_skills"] = self.skills.merge(skills, batch, [order, "at"])["imported"]
        pairs = skills.join(self.offers.rows().select("source_id", "offer_id"), "source_id").join(self.skills.rows().select("code", "skill_id"), "code")
        counts["new_links"] = self.links.merge(pairs.select("offer_id", "skill_id"), batch, ["offer_id"])["imported"]
        return counts


class CourseImport:
    """Courses by title and establishment, with their monthly flows and occupation codes, under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.courses = Target(spark, f"{root}/courses", "course_id long, title string, siret string, code_rncp string, level string, modality string, region string", ("title", "siret"), "course_id")
        self.flows = Target(spark, f"{root}/flows", "course_id long, year int, month int, entries long, partial long, total long", ("course_id", "year", "month"), None)
        self.occupations = Target(spark, f"{root}/course_occupations", "course_id long, code string", ("course_id", "code"), None)

    def run(self, rows: DataFrame, batch: int, order: str = "place") -> dict[str, int]:
        """Import rows(title, siret, code_rncp, level, modality, region, year, month, entries, partial, total, code, order), one for
        each month and occupation of a course. The first row of a course gives its columns, the first of a month its flow;
        children of courses that exist are left as they are."""
        counts = self.courses.merge(rows.select(*self.courses.empty.drop("course_id").columns, order), batch, [order])
        fresh = self.courses.rows().join(self.courses.rows(batch).select("course_id"), "course_id", "left_anti").select("title", "siret", "course_id")
        mine = rows.drop("course_id").join(fresh, ["title", "siret"])
        counts["new_flows"] = self.flows.merge(mine.select(*self.flows.empty.columns, order), batch, [order])["imported"]
        counts["new_occupations"] = self.occupations.merge(mine.select("course_id", "code", order), batch, [order])["imported"]
        return counts

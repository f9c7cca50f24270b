"""Pre-import package: the action for each offer, its record, and integrity in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("CREATE", "UPDATE", "REACTIVATE", "ENRICH_EXISTING", "DEFER", "REJECT", "DEACTIVATE", "NO_ACTION")


def action() -> Column:
    """Action over change, decision and review action; an unforeseen combination is an error."""
    write = (F.col("decision") == "NOT_FOUND") | ((F.col("decision") == "UNCERTAIN") & (F.col("action") == "REVIEW_NOW"))
    known = (
        F.when(F.col("change") == "INACTIVATED", "DEACTIVATE").when(F.col("change") == "UNCHANGED", "NO_ACTION").when(F.col("decision") == "PROCESSING_ERROR", "REJECT")
        .when((F.col("decision") == "UNCERTAIN") & (F.col("action") == "DEFER_DATA_INCOMPLETE"), "DEFER").when(F.col("decision") == "PRESENT", "ENRICH_EXISTING")
        .when(write & (F.col("change") == "NEW"), "CREATE").when(write & (F.col("change") == "UPDATED"), "UPDATE").when(write & (F.col("change") == "REACTIVATED"), "REACTIVATE")
    )
    return known.otherwise(F.raise_error(F.concat_ws(" ", F.lit("no action for"), "change", "decision", "action")).cast("string"))


def records(changes: DataFrame, offers: DataFrame, triage: DataFrame, key: str = "id") -> DataFrame:
    """One record for each change; offers and decisions that should be there and aren't show as `missing`."""
    j = changes.join(offers.withColumn("__o", F.lit(True)), key, "left").join(triage.withColumn("__t", F.lit(True)), key, "left")
    needs = ~F.col("change").isin("INACTIVATED", "UNCHANGED")
    missing = F.array_compact(F.array(F.when(needs & F.col("__o").isNull(), F.lit("offer")), F.when(needs & F.col("__t").isNull(), F.lit("triage"))))
    j = j.withColumn("missing", missing).drop("__o", "__t")
    return j.withColumn("import_action", F.when(F.size("missing") == 0, action()))


def action_counts(recs: DataFrame) -> DataFrame:
    return recs.groupBy("import_action").agg(F.count("*").alias("n"))


def integrity(recs: DataFrame, key: str = "id", target: str = "best_b", occupation: str = "occupation", skills: str = "skills") -> DataFrame:
    """One row of counts that must hold; `ok` says whether they do."""
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))
    one = recs.agg(
        F.count("*").alias("records"), F.count_distinct(key).alias("ids"), n(F.size("missing") > 0).alias("missing"), n(F.col(key).isNull()).alias("null_ids"),
        n((F.col("import_action") == "ENRICH_EXISTING") & F.col(target).isNull()).alias("enrich_without_target"), n(F.col(occupation).isNull()).alias("without_occupation"),
        n(F.size(skills) > 0).alias("with_skills"), F.sum(F.greatest(F.size(skills), F.lit(0))).alias("skill_links"), *[n(F.col("import_action") == a).alias(a.lower()) for a in ACTIONS],
    )
    total = sum((F.col(a.lower()) for a in ACTIONS), F.lit(0))
    return one.withColumn("ok", (F.col("records") == F.col("ids")) & (F.col("missing") == 0) & (F.col("null_ids") == 0) & (F.col("enrich_without_target") == 0) & (total == F.col("records")))


def skill_stats(offers: DataFrame, key: str = "id", skills: str = "skills", group: str | None = None) -> DataFrame:
    """Offers with and without skills, links and distinct skills, for all and (level by level) for each group."""
    return link_stats(offers.select(key, *([group] if group else []), F.explode_outer(F.array_distinct(skills)).alias("skill")), key, "skill", group)


def link_stats(links: DataFrame, key: str, skill: str, group: str | None = None, rows: int | None = None, rows_per_task: int = 500_000) -> DataFrame:
    """skill_stats over links, a row for each offer's skill (one with a null for an offer without); repeated links count once.

    Distinct ids and skills are grouped by themselves and then counted, in tasks of about rows_per_task of the `rows` (counted if
    not given): ids are packed so small that tasks sized by bytes would hold millions of them."""
    parts = -(-(links.count() if rows is None else rows) // rows_per_task) or 1
    kind = links.schema[group].dataType if group else "string"
    links = links.select(F.col(key).alias("__key"), F.col(skill).alias("__skill"), (F.col(group) if group else F.lit(None).cast(kind)).alias("__group"))
    at = [F.struct(F.lit(0).alias("level"), F.lit(None).cast(kind).alias("group")), F.struct(F.lit(1).alias("level"), F.col("__group").alias("group"))]
    levels = F.explode(F.array(*at[: 2 if group else 1])).alias("__at")
    ids = links.repartition(parts, "__key").distinct().groupBy("__group", "__key").agg(F.count("__skill").alias("n"))
    ids = ids.select("__key", "n", levels).groupBy("__key", "__at").agg(F.sum("n").alias("n"))
    one = ids.groupBy("__at").agg(F.count("__key").alias("offers"), F.count_if((F.col("n") > 0) & F.col("__key").isNotNull()).alias("with_skills"), F.sum("n").alias("links"))
    met = links.filter("__skill IS NOT NULL").select("__group", "__skill").repartition(parts, "__skill").distinct()
    many = met.select("__skill", levels).distinct().groupBy("__at").agg(F.count("*").alias("distinct_skills"))
    out = one.join(many.withColumnRenamed("__at", "__of"), (F.col("__at.level") == F.col("__of.level")) & F.col("__at.group").eqNullSafe(F.col("__of.group")), "left")
    counts = ("offers", "with_skills", "links", "distinct_skills")
    out = out.select(*([F.col("__at.group").alias(group)] if group else []), *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    return out if group else out.groupBy().agg(*[F.coalesce(F.first(c), F.lit(0).cast("long")).alias(c) for c in counts])


def with_occupation(recs: DataFrame, classes: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Adds occupation, occupation_status and occupation_method: those of the classifier, or (without one) the matched offer's
    where a present offer has a target with a code, and pending otherwise."""
    if classes is not None:
        mine = classes.select(F.col(key), F.col("code").alias("occupation"), F.col("status").alias("occupation_status"), F.lit("CLASSIFIED").alias("occupation_method"), "score", "margin")
        return recs.drop("occupation").join(mine, key, "left")
    inherited = (F.col("decision") == "PRESENT") & F.col("best_b").isNotNull() & F.col("best_code").isNotNull()
    pick = lambda yes, no: F.when(inherited, yes).otherwise(no)
    return recs.withColumns({"occupation": pick(F.col("best_code"), F.lit(None)), "occupation_status": pick(F.lit("INHERITED"), F.lit("PENDING")), "occupation_method": pick(F.lit("INHERITED_FROM_MATCH"), F.lit("NOT_ASSIGNED"))})


def enrichments(recs: DataFrame) -> DataFrame:
    """Records that enrich an existing offer: their skills are candidates, not its own."""
    return recs.filter("import_action = 'ENRICH_EXISTING'").withColumnsRenamed({"skills": "skills_candidate", "soft_skills": "soft_skills_candidate"})


def deactivations(changes: DataFrame, run: str, key: str = "id") -> DataFrame:
    """Compact records of offers that left the catalog."""
    return changes.filter("change = 'INACTIVATED'").select(F.col(key).alias("source_id"), F.col("change").alias("catalog_change_type"), F.lit("DEACTIVATE").alias("preimport_action"), F.lit(run).alias("preimport_run_id"))


def integrity_report(changes: DataFrame, active: DataFrame, triage: DataFrame, outputs: DataFrame, classes: DataFrame | None = None, key: str = "id") -> DataFrame:
    """One row: sizes, overlaps, missing, unexpected and repeated ids of a package, whether its parts partition what they should,
    and `integrity_valid`.

    changes(id, change): a row for each offer of the sync; active(id): the snapshot; triage(id); outputs(id, import_action[,
    occupation, best_code]): written records, NO_ACTION included. One full join of ids; each id is a row of flags."""
    flags = [("n_change", changes), ("n_active", active), ("n_triage", triage), ("n_output", outputs)] + ([("n_class", classes)] if classes is not None else [])
    every = None
    for name, df in flags:
        one = df.select(F.col(key), *[F.lit(1 if n == name else 0).alias(n) for n, _ in flags], *[(F.col(c) if name == "n_change" and c == "change" or name == "n_output" and c == "import_action" else F.lit(None).cast("string")).alias(c) for c in ("change", "import_action")])
        every = one if every is None else every.unionByName(one)
    per = every.groupBy(key).agg(*[F.sum(n).alias(n) for n, _ in flags], F.collect_set("change").alias("changes"), F.max("import_action").alias("import_action"))
    is_ = lambda c: F.array_contains("changes", c)
    process = is_("NEW") | is_("UPDATED") | is_("REACTIVATED")
    n = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))
    out = F.col("n_output") > 0
    gone, same = is_("INACTIVATED"), is_("UNCHANGED")
    deactivate, none = F.col("import_action") == "DEACTIVATE", F.col("import_action") == "NO_ACTION"
    counts = [
        n(F.col("n_active") > 0).alias("active_snapshot_count"), n(process).alias("process_count"), n(same).alias("unchanged_count"), n(gone).alias("deactivation_count"),
        n(process & (F.col("n_triage") == 0)).alias("missing_process_ids_in_triage"), n((F.col("n_triage") > 0) & (F.col("n_active") == 0)).alias("unexpected_triage_ids_outside_snapshot"),
        n(process & same).alias("process_unchanged_overlap"), n(process & gone).alias("process_deactivation_overlap"), n(same & gone).alias("unchanged_deactivation_overlap"),
        n(process & ~out).alias("missing_process_ids_in_outputs"), n(out & ~deactivate & ~none & ~process).alias("unexpected_process_ids_in_outputs"), n(process & (F.col("n_output") > 1)).alias("duplicate_process_output_ids"),
        n(gone & ~(out & deactivate)).alias("missing_deactivation_ids_in_outputs"), n(out & deactivate & ~gone).alias("unexpected_deactivation_ids_in_outputs"), n(gone & (F.col("n_output") > 1)).alias("duplicate_deactivation_output_ids"),
        n((F.col("n_active") > 0) & ~(process | same)).alias("active_ids_without_change"), n((process | same) & (F.col("n_active") == 0)).alias("changed_ids_outside_snapshot"),
    ]
    if classes is not None:
        counts += [n(process & (F.col("n_class") == 0)).alias("missing_process_ids_in_classes"), n((F.col("n_class") > 0) & (F.col("n_active") == 0)).alias("unexpected_class_ids_outside_snapshot")]
    one = per.agg(*counts)
    sizes = ("active_snapshot_count", "process_count", "unchanged_count", "deactivation_count")
    one = one.withColumn("active_partition_valid", (F.col("active_ids_without_change") == 0) & (F.col("changed_ids_outside_snapshot") == 0)).withColumn("active_equation_valid", F.col("process_count") + F.col("unchanged_count") == F.col("active_snapshot_count"))
    clean = F.lit(True)
    for c in one.columns:
        if c not in sizes and not c.endswith("_valid"):
            clean = clean & (F.col(c) == 0)
    return one.withColumn("integrity_valid", clean & F.col("active_partition_valid") & F.col("active_equation_valid"))

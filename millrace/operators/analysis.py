"""Analyses of decided offers: clusters, policies, samples and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scores import band
from millrace.sources.tables import table

from .ordering import exact_median, numbered


def clusters(cases: DataFrame, keys: list[str], key: str = "id", score: str = "score", same: tuple[str, ...] = ("coverage", "candidates", "priority"), spread: float = 2.0) -> DataFrame:
    """Groups of two or more cases with equal keys; safe ones agree on coverage, candidates and priority and lie close in score.
    Numbered by size, then by keys."""
    g = cases.groupBy(*keys).agg(F.count("*").alias("n"), F.min(key).alias("first_id"), F.min(score).alias("low"), F.max(score).alias("high"), F.avg(score).alias("mean"), F.median(score).alias("median"), *[(F.min(c) == F.max(c)).alias(f"one_{c}") for c in same]).filter("n >= 2")
    safe = F.col("high") - F.col("low") <= spread
    for c in same:
        safe = safe & F.col(f"one_{c}")
    return g.withColumn("safe", F.coalesce(safe, F.lit(False)))


def number_clusters(found: DataFrame, keys: list[str], buckets_of: str = "n") -> DataFrame:
    """cluster_id by size rank: clusters are counted per size first, then numbered inside a size, so no task orders them all.
    The clusters are written once for both steps."""
    found = table(found)
    per = found.groupBy(buckets_of).agg(F.count("*").alias("m"))
    start = per.withColumn("start", F.coalesce(F.sum("m").over(Window.orderBy(F.desc(buckets_of)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(buckets_of, "start")  # a row for each size
    within = F.row_number().over(Window.partitionBy(buckets_of).orderBy(*keys))
    return found.withColumn("__w", within).join(start, buckets_of).withColumn("cluster_id", F.col("start") + F.col("__w")).drop("__w", "start")


def cluster_summary(found: DataFrame) -> DataFrame:
    """One row over clusters, which are written once for the median's passes."""
    found = table(found)
    return found.agg(F.count("*").alias("clusters"), F.sum("n").alias("cases"), F.sum(F.col("safe").cast("long")).alias("safe"), F.avg("n").alias("mean_size"), F.lit(exact_median(found, "n")).cast("double").alias("median_size"), F.sum(F.when(F.col("safe"), F.col("n") - 1).otherwise(0)).alias("saved_reviews"))


#: Highest best score that a policy still calls new.
POLICIES = {"conservative": 35.0, "balanced": 40.0, "broad": 45.0}


def probably_new(policy: str, generic: Column | None = None) -> Column:
    """Whether a policy would call an uncertain offer new."""
    from .matching import COMPATIBLE_COMPANIES

    fits = F.coalesce(F.col("company_type").isin(*COMPATIBLE_COMPANIES), F.lit(False))
    c = (F.col("score") < POLICIES[policy]) & (F.col("coverage") >= 70) & ~F.coalesce(F.array_contains("blocks", "EXACT_FINGERPRINT"), F.lit(False)) & (F.col("title_ratio").isNull() | (F.col("title_ratio") < 0.55)) & (F.col("description_weighted").isNull() | (F.col("description_weighted") < 0.25)) & ~fits
    if policy == "conservative":
        c = c & (F.size("contradictions") == 0)
    return F.coalesce(c, F.lit(False))


def simulate(decided: DataFrame) -> DataFrame:
    """(policy, would_be_new, stay) over uncertain offers, in one pass."""
    u = decided.filter("decision = 'UNCERTAIN'")
    one = u.agg(F.count("*").alias("n"), *[F.sum(probably_new(p).cast("long")).alias(p) for p in POLICIES])
    return one.select("n", F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.coalesce(p, F.lit(0)).alias("would_be_new")) for p in POLICIES])).alias("x")).select("x.policy", "x.would_be_new", (F.col("n") - F.col("x.would_be_new")).alias("stay"))


def sample_per_bucket(df: DataFrame, bucket: Column, order: list[str], k: int = 10) -> DataFrame:
    """The first k rows of each bucket."""
    return df.withColumn("bucket", bucket).withColumn("n", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).filter(F.col("n") <= k)


def round_robin(df: DataFrame, bucket: str, order: list[str], k: int = 20) -> DataFrame:
    """k rows, one of each bucket in turn."""
    r = df.withColumn("turn", F.row_number().over(Window.partitionBy(bucket).orderBy(*order))).filter(F.col("turn") <= k)
    return r.orderBy("turn", bucket).limit(k)


def even_sample(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows 0, step, 2 step, ... in the order of key, k of them. Places come from counts by range of keys and from ranks within
    a range, never from one sorted whole."""
    n = df.count()
    if n == 0 or k <= 0:
        return df.limit(0)
    step = max(1, n // k)
    return numbered(df, [key], "__i").filter((F.col("__i") % step == 0) & (F.col("__i") < k * step)).select(*df.columns)


def stratified(cases: DataFrame, priority: str, bucket: list[str], order: list[str], quota: int = 60, total: int = 180, fill_order: list[str] | None = None, priorities: tuple[str, ...] | None = None) -> DataFrame:
    """Up to `quota` cases of each priority, one from each bucket in turn, smaller buckets first; then others up to `total`.

    Cases of a bucket come by `order`. The rest is taken in new turns over all buckets that still have cases, buckets by their
    keys, cases by `fill_order`. priorities: those that have a quota (all, if None). At most quota + total cases of a bucket can
    be meant, and only those go beyond the first step."""
    by, fill = [priority, *bucket], fill_order or order
    cases = table(cases)  # read three times
    sizes = cases.groupBy(*by).agg(F.count("*").alias("__size"))
    top = lambda d, o, k: d.withColumn("__turn", F.row_number().over(Window.partitionBy(*by).orderBy(*o))).filter(F.col("__turn") <= k)
    entitled = cases if priorities is None else cases.filter(F.col(priority).isin(*priorities))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"__s.{c}").eqNullSafe(F.col(f"__c.{c}"))
    first = top(entitled, order, quota).alias("__c").join(F.broadcast(sizes).alias("__s"), same).select("__c.*", "__s.__size")  # a row for each bucket
    first = first.withColumn("__rank", F.row_number().over(Window.partitionBy(priority).orderBy("__turn", "__size", *bucket))).filter(F.col("__rank") <= quota)
    first = table(first.drop("__turn", "__size"))
    rest = top(cases, fill, quota + total).drop("__turn").join(first.select(*dict.fromkeys(fill)), [*dict.fromkeys(fill)], "left_anti")
    rest = top(rest, fill, total).withColumn("__fill", F.lit(1))
    return first.withColumn("__fill", F.lit(0)).withColumnRenamed("__rank", "__turn").select(*cases.columns, "__fill", "__turn").unionByName(rest.select(*cases.columns, "__fill", "__turn")).orderBy("__fill", "__turn", *by).limit(total).drop("__fill", "__turn")


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def reason_counts(decided: DataFrame) -> DataFrame:
    """(action, reason, n) of uncertain offers."""
    return decided.filter("decision = 'UNCERTAIN'").select("action", F.explode("reasons").alias("reason")).groupBy("action", "reason").agg(F.count("*").alias("n"))


def examples(df: DataFrame, by: list[str], key: str = "id", k: int = 5) -> DataFrame:
    """The k least ids of each group and its size."""
    r = df.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy(key)))
    return r.groupBy(*by).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("r") <= k, F.col(key)))).alias("examples"))


#: Names and upper ends of the bands of a run's report on uncertain offers.
REPORT_SCORES = ((40, "<40"), (50, "40-50"), (60, "50-60"), (70, "60-70"))
REPORT_COVERAGES = ((80, "<80%"), (90, "80-90%"))


def _upto(x: Column, limits, last: str) -> Column:
    out = None
    for limit, name in limits:
        out = F.when(x < limit, name) if out is None else out.when(x < limit, name)
    return out.otherwise(last)


def uncertain_distributions(decided: DataFrame, credible: float = 50.0) -> DataFrame:
    """(action, report, value, n) of uncertain offers: score band, reason, coverage band, whether a candidate is credible, and
    whether the first ruleset called them duplicates; one pass."""
    score, yes_no = F.coalesce("score", F.lit(0.0)), lambda c: F.when(F.coalesce(c, F.lit(False)), "YES").otherwise("NO")
    one = lambda name, value: F.array(F.struct(F.lit(name).alias("report"), value.alias("value")))
    entries = F.concat(
        one("score", _upto(score, REPORT_SCORES, ">=70")), F.transform("reasons", lambda r: F.struct(F.lit("reason").alias("report"), r.alias("value"))),
        one("coverage", _upto(F.coalesce("coverage", F.lit(0)), REPORT_COVERAGES, ">=90%")), one("credible", yes_no(score >= credible)), one("first_duplicate", yes_no(F.col("v1_decision") == "DUPLICATE")),
    )
    return decided.filter("decision = 'UNCERTAIN'").select("action", F.explode(entries).alias("e")).groupBy("action", "e.report", "e.value").agg(F.count("*").alias("n"))


def intermediary_report(cases: DataFrame) -> DataFrame:
    """(report, value, n) of offers with a candidate whose advertiser is, or may be, an intermediary: by role, evidence (array),
    score band of ten, both rulesets' decisions, and how many score from 50 to below 75."""
    some = cases.filter(F.col("score").isNotNull() & F.col("role").isin("RECRUITMENT_INTERMEDIARY", "POSSIBLE_INTERMEDIARY"))
    one = lambda name, value: F.array(F.struct(F.lit(name).alias("report"), value.alias("value")))
    zone = F.filter(one("zone_50_75", F.lit("YES")), lambda e: (F.col("score") >= 50) & (F.col("score") < 75))
    entries = F.concat(one("role", F.col("role")), F.transform(F.coalesce("evidence", F.array().cast("array<string>")), lambda e: F.struct(F.lit("evidence").alias("report"), e.alias("value"))), one("score", band(F.col("score"), 10)), one("first", F.col("v1_decision")), one("second", F.col("decision")), zone)
    return some.select(F.explode(entries).alias("e")).groupBy("e.report", "e.value").agg(F.count("*").alias("n"))

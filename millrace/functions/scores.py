"""Scores of token sets and their bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens of two sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def weighted_coverage(query: Column, other: Column, idf: Column) -> Column:
    """Share of the query's idf weight that the other set has; idf is a map, 1 by default."""
    total = lambda ts: F.aggregate(ts, F.lit(0.0), lambda acc, t: acc + F.coalesce(F.try_element_at(idf, t), F.lit(1.0)))
    whole = total(query)
    return F.when(whole > 0, total(F.array_intersect(query, other)) / whole).otherwise(0.0)


def overlap_percent(query: Column, profile: Column, digits: int = 4) -> Column:
    """100 times the share of query tokens that a profile has; 0 for an empty query."""
    n = F.size(query)
    return F.when(n > 0, F.round(100.0 * F.size(F.array_intersect(query, profile)) / n, digits)).otherwise(0.0)


def idf(n: Column, df: Column) -> Column:
    return F.log((n + 1.0) / (df + 1.0)) + 1.0


def percent(x: Column) -> Column:
    return F.bround(x * 100).cast("int")


def similarity_level(x: Column, high: float = 0.85, low: float = 0.55) -> Column:
    return F.when(x.isNull(), "UNKNOWN").when(x >= high, "MATCH").when(x >= low, "PARTIAL_MATCH").otherwise("NO_MATCH")


def score_bucket(x: Column) -> Column:
    """The histogram's five buckets."""
    return F.when(x < 40, "0-39").when(x < 60, "40-59").when(x < 75, "60-74").when(x < 85, "75-84").otherwise("85-100")


def band(x: Column, width: int) -> Column:
    """[k * width, (k + 1) * width) by its lower end, in writing; the top belongs to the last band."""
    low = (F.floor(F.least(x, F.lit(100.0 - 1e-9)) / width) * width).cast("int")
    return F.when(x.isNull(), "NONE").otherwise(F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string")))


def data_coverage(title: Column, description: Column, place: Column, company: Column) -> Column:
    """45 for a title, 25 for a description, 15 for a place, 10 for a company."""
    e = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return sum((F.when(e(c), w).otherwise(0) for c, w in ((title, 45), (description, 25), (place, 15), (company, 10))), F.lit(0))


def quarter(year: Column, month: Column) -> Column:
    """YYYY-Tq."""
    return F.concat(year.cast("string"), F.lit("-T"), (F.floor((month - 1) / 3) + 1).cast("string"))


def eta(done: Column, total: Column, seconds: Column) -> Column:
    """struct(percent, per_second, seconds_left) of a running job."""
    speed = F.when(seconds > 0, done / seconds)
    return F.struct(F.round(100.0 * done / F.nullif(total, F.lit(0)), 2).alias("percent"), speed.alias("per_second"), F.when(speed > 0, (total - done) / speed).alias("seconds_left"))


def minutes_seconds(seconds: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(seconds / 60).cast("int"), F.floor(seconds % 60).cast("int"))


def batch_id(moment: Column) -> Column:
    """YYYYMMDD_HHMMSS of a timestamp, in the session's zone; names of batches sort by time."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def candidate_signature(ids: Column, most: int = 3) -> Column:
    """The best candidates' ids in order; offers with equal ones were confused with the same others."""
    return F.coalesce(F.slice(ids, 1, most), F.array().cast("array<string>"))

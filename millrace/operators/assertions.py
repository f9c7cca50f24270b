"""Data-quality checks: each gives the offending rows, or a one-row report; `require` turns offences into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_required(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, column) for each required value that is null or blank."""
    blank = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in columns]
    return df.select(F.col(key), F.explode(F.array_compact(F.array(*blank))).alias("column"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def overlaps(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """(a, b, n): how many keys each two of the sets share."""
    names = sorted(sets)
    tagged = None
    for n in names:
        one = sets[n].select(F.col(key)).distinct().withColumn("name", F.lit(n))
        tagged = one if tagged is None else tagged.unionByName(one)
    both = tagged.groupBy(key).agg(F.sort_array(F.collect_set("name")).alias("names"))  # as many names as sets
    pairs = F.expr("flatten(transform(names, (a, i) -> transform(slice(names, i + 2, size(names)), b -> struct(a, b))))")
    return both.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): keys of one table that the other lacks."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, key, "left_anti").withColumn("side", F.lit("right")))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing, filled_percent) of each column, from one pass."""
    one = df.agg(F.count("*").alias("n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns])
    return one.select("n", F.explode(items).alias("x")).select("x.column", "x.missing", F.round(100.0 * (F.col("n") - F.col("x.missing")) / F.col("n"), 4).alias("filled_percent"))


def counters_add_up(df: DataFrame, parts: list[str], whole: Column) -> DataFrame:
    return df.select(*parts, whole.alias("whole"), (sum((F.col(p) for p in parts), F.lit(0)) == whole).alias("ok"))


def require(offences: DataFrame, what: str) -> None:
    """Raise with up to five offending rows."""
    found = offences.limit(5).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(map(str, found)))


def capture_errors(df: DataFrame, checks: dict[str, Column], name: str = "processing_error") -> DataFrame:
    """df with the name of the first check that a row fails, null for good rows."""
    return df.withColumn(name, F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items()]))


def literal_violations(df: DataFrame, column: str, literal: str, key: str) -> DataFrame:
    """(key, value) of rows whose column isn't the one value that the source writes."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(literal))).select(key, F.col(column).alias("value"))


def id_mismatches(df: DataFrame, inner: Column, key: str) -> DataFrame:
    """(key, inner) of rows whose payload names another id."""
    return df.select(key, inner.alias("inner")).filter(~F.col("inner").eqNullSafe(F.col(key)))


def unequal_lists(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Keys of rows whose list isn't the same on both sides, nulls being equal."""
    other = b.select(F.col(key).alias("__key"), F.col(column).alias("__list"))
    return a.join(other, a[key] == F.col("__key")).filter(~F.col(column).eqNullSafe(F.col("__list"))).select(a[key])


def volumes(df: DataFrame, column: str, expected: dict[str, int]) -> DataFrame:
    """(value, expected, found, ok): rows of each value against the number that should be there."""
    want = df.sparkSession.createDataFrame(list(expected.items()), "value string, expected long")
    found = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("found"))
    return want.join(found, "value", "left").withColumn("found", F.coalesce("found", F.lit(0))).withColumn("ok", F.col("found") == F.col("expected"))


def filled_in(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, column) of values that only people may write and that aren't blank."""
    filled = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "", F.lit(c)) for c in columns]
    return df.select(key, F.explode(F.array_compact(F.array(*filled))).alias("column"))

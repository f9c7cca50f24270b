"""Ranks and prefix sums over whole tables in two steps, so that no task orders everything or holds one hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.tables import table


def in_ranges(df: DataFrame, rows: int, columns: list[str], rows_per_range: int = 20_000, most: int = 20_000) -> DataFrame:
    """df in the order of columns, cut into ranges of about rows_per_range rows: written, with the range's number as `part`.

    Columns that tell rows apart keep a hot group from filling one range."""
    n = max(1, min(most, -(-rows // rows_per_range)))
    return table(df.repartitionByRange(n, *columns).withColumn("part", F.spark_partition_id()))


def before(ranged: DataFrame, group: str, order: list, value: Column, name: str) -> DataFrame:
    """Adds the sum of `value` over the rows of a group that come earlier, for a table of in_ranges(group, *order).

    Two steps: sums by range first, of which a group has a row for each range, then rows within a range. `group` can't be null."""
    sums = ranged.groupBy(group, "part").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(group, "part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"))
    within = Window.partitionBy(group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("__in", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inside.join(starts, [group, "part"]).withColumn(name, F.col("__start") + F.col("__in")).drop("__start", "__in")


def numbered(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Adds each row's place from 0 in the order of columns."""
    ranged = in_ranges(df.withColumn("__one", F.lit(0)), df.count(), columns)
    return before(ranged, "__one", columns, F.lit(1), name).drop("__one", "part")


def at_ranks(df: DataFrame, column: str, ranks: list[int], parts: int = 512) -> list[float]:
    """The values at given places (from 0) of a number column in ascending order, nulls left out; exact.

    Each pass counts rows by equal parts of the range that still holds a place, so a pass gives `parts` rows and no task orders
    the values; it ends when a range holds one value. Ranges are cut between the least and greatest values really in them."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    found: dict[int, float] = {}
    open_ = [(0, None, None, list(dict.fromkeys(ranks)))]  # rows before the range, its least and greatest value, places in it
    while open_:
        start, low, high, wanted = open_.pop()
        inside = values if low is None else values.filter((F.col("v") >= low) & (F.col("v") <= high))
        if low is None:
            one = inside.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
            low, high = one["low"], one["high"]
            if low is None:
                raise ValueError("no values")
        part = F.least(F.floor((F.col("v") - low) / (high - low) * parts), F.lit(parts - 1)) if high > low else F.lit(0)
        for r in inside.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("part").collect():  # `parts` rows
            mine = [k for k in wanted if start <= k < start + r["n"]]
            if mine and r["low"] == r["high"]:
                found |= {k: r["low"] for k in mine}
            elif mine:
                open_.append((start, r["low"], r["high"], mine))
            start += r["n"]
    return [found[k] for k in ranks]


def exact_median(df: DataFrame, column: str) -> float | None:
    """The mean of the one or two middle values; None without values."""
    n = df.agg(F.count(column)).first()[0]
    return sum(at_ranks(df, column, [(n - 1) // 2, n // 2])) / 2 if n else None

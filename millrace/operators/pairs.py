"""Joins whose rows are many for their inputs: hot keys are cut into cells, and pairs stay in the task that makes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import table

#: Rows of a side in a cell, pairs of a task, and tasks at most.
SIDE, PAIRS, TASKS = 2000, 4_000_000, 20_000


def meet(a: DataFrame, b: DataFrame, key: str, id_a: str, id_b: str, side: int = SIDE, pairs: int = PAIRS, partners: str | None = None) -> DataFrame:
    """a.join(b, key), for keys with many rows on both sides.

    The rows of a key are dealt to cells of about `side` by `side` by their ids, each row to the cells of its row or column, so each
    pair meets once. The number of tasks goes by pairs: sizes in bytes say nothing about them, and neither do they about a side whose
    rows are repeated, so none is broadcast. partners: an array column of a with
    ids of b; a row brings to each cell those that are dealt there, as all of them for each cell would grow with the square."""
    n = table(a.groupBy(key).agg(F.count("*").alias("__a")).join(b.groupBy(key).agg(F.count("*").alias("__b")).hint("merge"), key))
    total = n.agg(F.coalesce(F.sum(F.col("__a").cast("double") * F.col("__b")), F.lit(0.0))).first()[0]
    tasks = int(min(TASKS, max(1, -(-total // pairs), n.sparkSession.sparkContext.defaultParallelism)))
    hot = n.filter((F.col("__a") > side) | (F.col("__b") > side)).select(key, *[F.ceil(F.col(c) / side).cast("int").alias(c) for c in ("__a", "__b")])
    mine = lambda c, i: F.pmod(F.xxhash64(i), F.coalesce(c, F.lit(1))).cast("int")
    all_ = lambda c: F.explode(F.sequence(F.lit(0), F.coalesce(c, F.lit(1)) - 1))
    x = a.join(hot, key, "left").withColumn("__i", mine(F.col("__a"), id_a)).withColumn("__j", all_(F.col("__b")))
    if partners:
        x = x.withColumn(partners, F.filter(partners, lambda v: mine(F.col("__b"), v.cast(b.schema[id_b].dataType)) == F.col("__j")))
    x = x.drop("__a", "__b")
    y = b.join(hot, key, "left").withColumn("__j", mine(F.col("__b"), id_b)).withColumn("__i", all_(F.col("__a"))).drop("__a", "__b")
    cell = [key, "__i", "__j"]
    return x.repartition(tasks, *cell).join(y.repartition(tasks, *cell).hint("merge"), cell).drop("__i", "__j")


def sets(flags: dict[str, Column], joined: str | None = None) -> Column:
    """The names of true flags in their order, as an array or joined to one string; without a function that is run name by name."""
    names = list(flags)
    number = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(flags.values())), F.lit(0))
    some = [[x for i, x in enumerate(names) if m >> i & 1] for m in range(1 << len(names))]
    known = [F.array(*map(F.lit, x)).cast("array<string>") if joined is None else F.lit(joined.join(x)) for x in some]
    return F.element_at(F.array(*known), number + 1)

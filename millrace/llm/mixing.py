"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

A document's key is an exponential variate divided by its quality weight; ascending keys are a weighted draw without
replacement. A source with a target of q times its size gives floor(q) complete epochs; the rest of its target is filled by its
documents in the order of their keys. Narrow rows are cut into ranges of (source, key, checksum, row), sums by range give where
each range starts, and sizes are prefix-summed within a range: no task holds a source, whatever the weights.

Defined results: a null text has size 0 and is never taken; a very long one is one document, taken whole; a null source is a
source of its own, last in order; a source of size 0 has target 0; equal keys (rows that share an id and a weight) are told apart
by the text's checksum, and rows equal in all of this are interchangeable; an empty table gives an empty table; extra columns
don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SQL, before, in_ranges, table

MOST_EPOCHS = 3


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of an MD5."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def words_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_SQL)), F.lit(0)).cast("long")


def quality_weight(text: str) -> Column:
    """From 0.05 to 1: less for texts with more markup characters a word."""
    symbols = F.coalesce(F.length(F.regexp_replace(F.col(text), "[^#*$%&|<>]", "")), F.lit(0)).cast("double")
    return F.greatest(F.lit(0.05), F.lit(1.0) - symbols / (words_of(text) + 1))


def targets(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size), a row for each source: adds its place and target.

    Sources weigh 1, 2, 3, 1, 2, 3, ... in code-point order, nulls last. A target stops at MOST_EPOCHS times its source's size;
    what is over goes to the others by weight. Places are counted by range of names. The level that sources get for each unit of
    weight rises while it stops sources; a round is one aggregate over sources, and each round but the last stops one at least."""
    s = sizes.withColumn("none", F.col("source").isNull()).withColumn("one", F.lit(0))
    s = before(in_ranges(s, s.count(), ["one", "none", "source"]), "one", ["none", "source"], F.lit(1), "place")
    s = s.select("source", "source_size", "place", (F.col("place") % 3 + 1).alias("weight"), (MOST_EPOCHS * F.col("source_size")).alias("cap"))
    s = table(s)
    total, level, stopped = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0, -1
    while True:
        over = level * F.col("weight") > F.col("cap")
        one = s.agg(F.count(F.when(over, 1)).alias("n"), F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)).alias("taken"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()  # one row
        if one["n"] == stopped or not one["weight"]:
            break
        level, stopped = float(total - one["taken"]) / float(one["weight"]), one["n"]
    return s.select("source", "source_size", "place", F.when(level * F.col("weight") > F.col("cap"), F.col("cap")).otherwise(level * F.col("weight")).cast("double").alias("target"))


def _drawn(text: str, key: str, seed: str) -> tuple[Column, Column, Column]:
    """A row's size, key of the draw and checksum."""
    return words_of(text), -F.log(uniform(F.lit(seed), F.col(key))) / quality_weight(text), F.crc32(F.coalesce(F.col(text), F.lit("")))


def _placed(docs: DataFrame, key: str, text: str, source: str, seed: str, rows_per_bin: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their source's numbers and whether the rest of its budget takes them once more, and a row for each source."""
    size, draw, crc = _drawn(text, key, seed)
    d = table(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size"), crc.alias("crc"), draw.alias("draw")))
    per = d.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(per).withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goals = goals.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "s")
    d = d.withColumn("row", F.monotonically_increasing_id()).join(goals, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    order = ["draw", "crc", "row"]
    d = before(in_ranges(d, d.count(), ["place", *order], rows_per_bin), "place", order, F.col("size"), "before")
    # whole documents: the one at the budget's end comes along if that is nearer
    return d.withColumn("more", (F.col("before") < F.col("budget")) & ((F.col("budget") - F.col("before")) * 2 >= F.col("size"))), goals


def mix_report(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", rows_per_bin: int = 20_000) -> DataFrame:
    """key, size, source_size, target, taken for every row of docs. rows_per_bin: rows of a range."""
    d, _ = _placed(docs, key, text, source, seed, rows_per_bin)
    return d.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("more").cast("int"))).cast("long").alias("taken"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", rows_per_bin: int = 20_000) -> DataFrame:
    """docs as mixed: each row as often as it was taken, so not at all or up to MOST_EPOCHS times; the columns of docs, whatever
    their names.

    Within a source the rest of the budget takes rows up to one place of the draw, so a row needs that place alone to know its
    copies: a row for each source meets the texts, not a row for each document. Rows that are equal at that place (one key and
    text) are numbered, and as many are taken as the report takes of them."""
    placed, goals = _placed(docs, key, text, source, seed, rows_per_bin)
    placed = table(placed.filter("size > 0").select("place", F.struct("draw", "crc").alias("at"), "more"))
    ends = placed.filter("more").groupBy("place").agg(F.max("at").alias("end"))
    tied = placed.join(ends, "place").filter(F.col("at") == F.col("end")).groupBy("place", "end").agg(F.count("*").alias("n"), F.sum(F.col("more").cast("long")).alias("t"))
    rules = table(goals.join(tied, "place", "left").select(F.struct("s", "place", "epochs", "end", "n", "t").alias("__rule")))
    size, draw, crc = _drawn(text, key, seed)
    d = docs.select(F.struct("*").alias("__doc"), F.col(source).alias("__source"), size.alias("__size"), F.struct(draw.alias("draw"), crc.alias("crc")).alias("__at"))
    d = d.join(rules, F.col("__source").eqNullSafe(F.col("__rule.s")))
    at, end = F.col("__at"), F.col("__rule.end")
    open_ = F.coalesce((at == end) & (F.col("__rule.t") < F.col("__rule.n")), F.lit(False))
    copies = lambda more: F.explode(F.array_repeat(F.lit(0), F.when(F.col("__size") > 0, F.col("__rule.epochs") + more.cast("int")).otherwise(0).cast("int")))
    tied_rows = rules.filter("__rule.t < __rule.n").agg(F.coalesce(F.sum("__rule.n"), F.lit(0))).first()[0]
    if not tied_rows:  # the draw alone tells all rows
        return d.select("__doc", copies(F.coalesce(at <= end, F.lit(False)))).select("__doc.*")
    sure = d.filter(~open_).select("__doc", copies(F.coalesce(at <= end, F.lit(False)))).select("__doc.*")
    # written before they are numbered, so that a row keeps its number
    ends = d.filter(open_ & (F.col("__size") > 0)).select("__doc", "__size", F.col("__rule.place").alias("place"), "__rule", F.monotonically_increasing_id().alias("row"))
    ends = before(in_ranges(ends, tied_rows, ["place", "row"], rows_per_bin), "place", ["row"], F.lit(1), "number")
    return sure.unionByName(ends.select("__doc", copies(F.col("number") < F.col("__rule.t"))).select("__doc.*"))


#: DuckDB, for mix_report with its defaults.
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
c AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS DOUBLE) AS symbols FROM t),
d AS (SELECT *, -ln((CAST('0x' || substr(md5('mix|' || doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / greatest(0.05, 1.0 - symbols / (size + 1)) AS draw FROM c),
p AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) AS place FROM d GROUP BY source),
q AS (SELECT *, place % 3 + 1 AS weight, 3 * source_size AS cap FROM p),
r AS (
  SELECT *, row_number() OVER o AS pos,
         CAST((SELECT sum(source_size) FROM q) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM q WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, place)),
f AS (SELECT min(pos) AS pos, arg_min(level, pos) AS level FROM r WHERE level * weight <= cap),
g AS (SELECT source, source_size, CASE WHEN r.pos >= f.pos THEN f.level * weight ELSE CAST(cap AS DOUBLE) END AS target FROM r, f),
h AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g),
x AS (
  SELECT d.doc_id, d.size, h.source_size, h.target, h.epochs, h.target - h.epochs * h.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
  FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN before < budget AND (budget - before) * 2 >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""

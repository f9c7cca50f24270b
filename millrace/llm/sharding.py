"""Sharding by a hierarchical weighted hash tree, in DataFrame operations alone.

The tree has regions of racks of shards. A row descends it: at each level every child gets a draw -ln(u) / weight, u being a hash
of the row's id and the child's name, and the least draw wins; a child's weight is the sum of its shards' weights. A child whose
weight grows takes rows from its siblings, all other rows stay, so movement is confined to subtrees whose weights change. A tree
grows by a region of its own for the new shard: every other draw stays as it was, and rows move into the new shard alone.

Defined results: a null text has no bytes (size 8, checksum 0); a very long one is one row as any other; a null id is an id of its
own; rows that share an id share a shard; of equal draws the first child wins; slots follow the order of hashed id and checksum,
rows equal in both being interchangeable; an empty table gives an empty table; extra columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import before, in_ranges, table
from .mixing import uniform

#: A tree: regions of racks of shard weights.
Tree = Sequence[Sequence[Sequence[float]]]


def tree_of(shards: int = 24, regions: int = 2, racks: int = 3) -> Tree:
    """`shards` shards of weight 1 in equal regions and racks; each shard beyond the equal part is a region of its own."""
    per = max(1, shards // (regions * racks))
    whole = [[[1.0] * per for _ in range(racks)] for _ in range(regions)] if shards >= regions * racks else []
    return whole + [[[1.0]] for _ in range(shards - sum(len(k) for r in whole for k in r))]


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    return [*tree, [[weight]]]


#: A node of the tree: its name, weight and number among its level's nodes.
_Node = tuple[str, float, int]


def _levels(tree: Tree) -> list[list[list[_Node]]]:
    """The children of each node, level by level: regions of the root, racks of each region, shards of each rack."""
    regions = [(f"root.{r}", float(sum(map(sum, region))), r) for r, region in enumerate(tree)]
    racks, shards, rack_no, shard_no = [], [], 0, 0
    for r, region in enumerate(tree):
        racks.append([])
        for k, rack in enumerate(region):
            racks[-1].append((f"{r}.{k}", float(sum(rack)), rack_no))
            rack_no += 1
            shards.append([(f"{r}.{k}.{i}", float(w), shard_no + i) for i, w in enumerate(rack)])
            shard_no += len(rack)
    return [[regions], racks, shards]


def _draws(id_: Column, children: Column) -> Column:
    """Of an array of nodes: struct(draw, number) of the one with the least draw, the first of equal ones."""
    each = F.transform(F.filter(children, lambda c: c["weight"] > 0), lambda c: F.struct((-F.log(uniform(id_, c["name"])) / c["weight"]).alias("draw"), c["number"].alias("number")))
    return F.array_min(each)


def _nodes(children: list[_Node]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(i).alias("number")) for n, w, i in children])


def _below(id_: Column, level: list[list[_Node]], parent: Column) -> Column:
    """The winner among the children of one node: only they are drawn."""
    return _draws(id_, F.element_at(F.array(*map(_nodes, level)), parent + 1))["number"]


def shard_of(id_: Column, tree: Tree) -> Column:
    """The shard's number, counted through the tree from 0: a descent that draws the children of the winner alone."""
    regions, racks, shards = _levels(tree)
    return _below(id_, shards, _below(id_, racks, _draws(id_, _nodes(regions[0]))["number"]))


def shard_report(docs: DataFrame, tree: Tree | None = None, key: str = "doc_id", text: str = "text", rows_per_run: int = 20_000) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    The grown tree draws once more than the tree: its new region wins where it draws less than the best of the others. Slots are
    counted in two steps: rows of each range of (shard, hashed id, checksum, row), then within a range, so that no task holds a
    shard or a repeated id. rows_per_run: rows of a range."""
    tree = tree or tree_of()
    regions, racks, shards = _levels(tree)
    new = _levels(grown(tree))[0][0][-1]
    raw, id_ = F.coalesce(F.col(text), F.lit("")), F.col("key")
    d = docs.select(F.col(key).alias("key"), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit("~"))).alias("hash"))
    d = d.withColumn("best", _draws(id_, _nodes(regions[0]))).withColumn("shard", _below(id_, shards, _below(id_, racks, F.col("best.number"))).cast("int"))
    moved = _draws(id_, _nodes([new]))["draw"] < F.col("best.draw")
    d = table(d.withColumn("grown_shard", F.when(moved, F.lit(sum(map(len, shards)))).otherwise(F.col("shard")).cast("int")).drop("best"))
    order = ["hash", "text_crc32", "row"]
    d = in_ranges(d.withColumn("row", F.monotonically_increasing_id()), d.count(), ["shard", *order], rows_per_run)
    d = before(d, "shard", order, F.lit(1), "slot")
    return d.select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


#: DuckDB, for shard_report with its defaults: CRC-32 byte by byte, and the descent by least draws.
ORACLE_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
b AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '~') AS id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (
  SELECT doc_id, id, len(h) // 2 + 8 AS size, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda a, x: xor(a >> 8, step[(xor(a, x) & 255) + 1])) AS a FROM b, crc),
d AS (SELECT doc_id, id, size, xor(a, 4294967295) AS text_crc32, DRAWS(['root.0', 'root.1', 'root.2']) AS top FROM c),
e AS (SELECT *, CASE WHEN top[2] < top[1] THEN 1 ELSE 0 END AS r FROM d),
f AS (SELECT *, DRAWS([r || '.0', r || '.1', r || '.2']) AS racks FROM e),
g AS (SELECT *, list_position(racks, list_min(racks)) - 1 AS k FROM f),
h AS (SELECT *, DRAWS([r || '.' || k || '.0', r || '.' || k || '.1', r || '.' || k || '.2', r || '.' || k || '.3']) AS leaves FROM g),
i AS (SELECT *, CAST(12 * r + 4 * k + list_position(leaves, list_min(leaves)) - 1 AS INT) AS shard FROM h)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY md5(id), text_crc32) - 1 AS slot,
       CASE WHEN 12 * top[3] < least(top[1], top[2]) THEN 24 ELSE shard END AS grown_shard
FROM i
"""
_DRAW = "list_transform({}, lambda n: -ln((CAST('0x' || substr(md5(id || '|' || n), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0))"
ORACLE_SQL = re.sub(r"DRAWS\((\[.*?\])\)", lambda m: _DRAW.format(m[1]), ORACLE_SQL)

"""The library's inputs made from the driver's tables: every row of a table takes part.

Where Spark and DuckDB read the same expression it is written once, as SQL text that both accept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import geo, text
from millrace.operators import matching
from millrace.sources.tables import table


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FLOWS_SQL = "r_name AS region, year(o_orderdate) AS year, month(o_orderdate) AS month, CAST(floor(o_totalprice / 1000) AS BIGINT) AS entries, CASE WHEN o_orderstatus = 'P' THEN CAST(1 AS BIGINT) END AS partial, CASE WHEN o_orderstatus = 'F' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS total"


def flows(spark: SparkSession, d: str) -> DataFrame:
    """Orders as monthly flows of their customers' regions."""
    o, c, n, r = (t(spark, d, x) for x in ("orders", "customer", "nation", "region"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).selectExpr(*_columns(FLOWS_SQL))


def _columns(sql: str) -> list[str]:
    """The columns of a select list, cut at commas outside parentheses."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(sql):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(sql[start:i].strip())
            start = i + 1
    return [*out, sql[start:].strip()]


def offers_per_region(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (t(spark, d, x) for x in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("n"))


#: Offers from documents: the first line's first eight words as title, the text as description, source as company; 40 neighbours share a postal code; lots of 20 alternate sides.
OFFERS_SQL = "CAST(doc_id AS STRING) AS id, CAST(floor(doc_id / 20) AS BIGINT) % 2 AS side, substring_index(split(text, '\\n')[0], ' ', 8) AS title, text, source AS company, lpad(CAST(1000 + (CAST(floor(doc_id / 40) AS BIGINT) * 37) % 95000 AS STRING), 5, '0') AS postal_code, concat(lang, '-', source) AS occupation"


def offers(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").selectExpr(*_columns(OFFERS_SQL))


def prepared(spark: SparkSession, d: str, described: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both sides, normalised. described: with the whole text as description."""
    o = offers(spark, d).withColumn("description", F.col("text") if described else F.lit(None).cast("string")).withColumn("locality", F.lit(None).cast("string"))
    # written once: every block reads the normalised sides again
    return tuple(table(matching.prepare(o.filter(F.col("side") == s), occupation="occupation")) for s in (0, 1))


def benchmark_offers(spark: SparkSession, d: str, known: int = 33_805, incoming: int = 150) -> tuple[DataFrame, DataFrame]:
    """Raw offers in the published benchmark's shape: `incoming` and `known` offers from parts of the documents.

    A document gives an offer for each of its first lots of 60 words: eight words of it are the title, all of it the description.
    Companies have 400 unlike names, postal codes are 2,400 places; one in ten incoming offers is a known one with another title."""
    words = F.split(F.coalesce("text", F.lit("")), "\\s+")
    lots = F.transform(F.sequence(F.lit(0), F.least(F.lit(39), F.floor((F.size(words) - 1) / 60).cast("int"))), lambda i: F.struct(i.alias("lot"), F.slice(words, i * 60 + 1, F.lit(60)).alias("words")))
    e = t(spark, d, "documents").select("doc_id", "lang", "source", F.explode(lots).alias("x")).select("doc_id", "lang", "source", "x.*").withColumn("h", F.xxhash64("doc_id", "lot"))
    o = e.select(
        F.concat_ws("-", "doc_id", "lot").alias("id"), F.array_join(F.slice("words", 1, 8), " ").alias("title"), F.array_join("words", " ").alias("description"), F.translate(F.left(F.md5(F.pmod("h", F.lit(400)).cast("string")), F.lit(9)), "0123456789", "ghijklmnop").alias("company"),
        F.lpad((F.pmod(F.shiftright("h", 20), F.lit(2400)) * 40).cast("string"), 5, "0").alias("postal_code"), F.lit(None).cast("string").alias("locality"), F.concat_ws("-", "lang", "source").alias("occupation"), "h",
    )
    o = table(o.orderBy("h").limit(known + incoming).withColumn("n", F.row_number().over(Window.orderBy("h"))))  # a benchmark's rows
    asked = o.filter(F.col("n") <= incoming)
    copies = o.filter((F.col("n") > incoming) & (F.col("n") <= incoming + incoming // 10)).select(F.concat(F.lit("copy-"), "id").alias("id"), F.concat("title", F.lit(" plus")).alias("title"), *o.columns[2:])
    sides = asked.filter(F.col("n") > incoming // 10).unionByName(copies), o.filter(F.col("n") > incoming)
    return tuple(map(table, sides))


def skill_tokens(spark: SparkSession, d: str) -> DataFrame:
    """(id, tokens): the classifier's tokens of each skill of an offer. Lines link the offer of their order's number to parts, as
    its skills."""
    p = t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), text.tokens(text.normalize_description(F.col("p_name")), text.CLASSIFIER_STOP_WORDS).alias("tokens"))
    return t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"), "l_partkey").distinct().join(p, "l_partkey").select("id", "tokens")


# DuckDB: folded and normalised titles with their tokens
_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
OFFERS_CTE = rf"""
o AS (SELECT CAST(doc_id AS VARCHAR) AS id, (doc_id // 20) % 2 AS side, array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:8], ' ') AS raw, text, source AS company,
        lpad(CAST(1000 + ((doc_id // 40) * 37) % 95000 AS VARCHAR), 5, '0') AS postal_code, lang || '-' || source AS occupation FROM documents),
o1 AS (SELECT *, regexp_replace(replace(strip_accents(lower(raw)), 'ß', 'ss'), '\b({text.GENDER_MARKS})\b', ' ', 'g') AS s FROM o),
o2 AS (SELECT *, regexp_replace(regexp_replace(s, '(^|[^a-z0-9_])[/-]', '\1 ', 'g'), '[/-]([^a-z0-9_]|$)', ' \1', 'g') AS s2 FROM o1),
o3 AS (SELECT * EXCLUDE (s, s2, raw), trim(regexp_replace(regexp_replace(s2, '[^a-z0-9_\s/-]', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM o2),
n AS (SELECT *, left(postal_code, 2) AS department, replace(title, ' ', '') AS compact_title,
        list_sort(list_distinct(list_filter(string_split(title, ' '), lambda w: length(w) >= 3 AND w NOT IN ({_STOP}) AND NOT regexp_matches(w, '^[0-9]+$')))) AS title_tokens FROM o3),
a AS (SELECT * FROM n WHERE side = 0), b AS (SELECT * FROM n WHERE side = 1),
bt AS (SELECT id, unnest(title_tokens) AS token FROM b), att AS (SELECT id, unnest(title_tokens) AS token FROM a),
df AS (SELECT token, count(*) AS df FROM bt GROUP BY token)"""

#: Cases for the ladders, one from each order: every input takes all its values in some combination.
CASES_SQL = """
CAST(k AS STRING) AS id, k, score, CASE WHEN k % 5 <> 0 AND score IS NOT NULL THEN greatest(0.0, score - (k % 13)) END AS second, score AS max_score,
CASE CAST(floor(k / 3) AS BIGINT) % 5 WHEN 0 THEN 'EXACT_NORMALIZED' WHEN 1 THEN 'CONTAINMENT_MATCH' WHEN 2 THEN 'HIGH_SIMILARITY' WHEN 3 THEN 'NO_MATCH' ELSE 'MISSING' END AS company_type,
(CAST(floor(k / 2) AS BIGINT) % 11) / 10.0E0 AS company_similarity,
CASE CAST(floor(k / 7) AS BIGINT) % 5 WHEN 0 THEN 'EXACT_POSTAL_CODE' WHEN 1 THEN 'SAME_LOCALITY' WHEN 2 THEN 'SAME_DEPARTMENT' WHEN 3 THEN 'DIFFERENT' ELSE 'UNKNOWN' END AS place_type,
CASE WHEN k % 29 = 0 THEN 1.0E0 ELSE ((k * 3) % 100) / 100.0E0 END AS title_ratio, ((k * 3) % 100) / 100.0E0 AS title_jaccard, ((k * 3) % 100) / 100.0E0 AS title_weighted, ((k * 3) % 100) / 100.0E0 AS title_compact,
CASE WHEN k % 4 <> 0 THEN ((k * 11) % 100) / 100.0E0 END AS description_jaccard, CASE WHEN k % 4 <> 0 THEN ((k * 13) % 100) / 100.0E0 END AS description_weighted,
CASE CAST(floor(k / 11) AS BIGINT) % 6 WHEN 0 THEN split('EXACT_FINGERPRINT,EXACT_POSTAL_CODE', ',') WHEN 1 THEN split('COMPACT_TITLE_EXACT,EXACT_POSTAL_CODE', ',') ELSE split('EXACT_POSTAL_CODE', ',') END AS blocks,
CAST(floor(k / 13) AS BIGINT) % 7 = 0 AS generic_title,
CASE CAST(floor(k / 17) AS BIGINT) % 4 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'DIRECT_EMPLOYER' WHEN 2 THEN 'POSSIBLE_INTERMEDIARY' ELSE 'RECRUITMENT_INTERMEDIARY' END AS role,
45 + 25 * (k % 2) + 15 * (CAST(floor(k / 2) AS BIGINT) % 2) + 10 * (CAST(floor(k / 4) AS BIGINT) % 2) + 5 * (CAST(floor(k / 8) AS BIGINT) % 2) AS coverage,
CASE WHEN k % 101 = 0 THEN '' ELSE concat('offer ', CAST(k AS STRING)) END AS title, CASE WHEN k % 37 <> 0 THEN 'text' END AS excerpt, CASE WHEN k % 37 <> 0 THEN 'text' END AS description,
CASE WHEN k % 3 = 0 THEN '' ELSE concat('c', CAST(k % 50 AS STRING)) END AS company, CASE WHEN k % 6 = 0 THEN '' ELSE '75001' END AS postal_code, CAST(NULL AS STRING) AS locality,
CASE WHEN k % 997 = 0 THEN 'error' END AS v1_error, CAST(floor(k / 19) AS BIGINT) % 3 = 0 AS common_skills, CAST(k % 21 AS BIGINT) AS candidates
"""
KEYED_SQL = "o_orderkey AS k, CASE WHEN o_orderkey % 17 <> 0 THEN ((o_orderkey * 7) % 1010) / 10.0E0 END AS score"


def cases(spark: SparkSession, d: str) -> DataFrame:
    k = t(spark, d, "orders").selectExpr(*_columns(KEYED_SQL))
    return k.selectExpr(*_columns(CASES_SQL)).withColumn("margin", F.col("score") - F.coalesce("second", F.lit(0.0))).withColumn("best_company", F.concat(F.lit("b"), (F.col("k") % 7).cast("string")))


CASES_CTE = f"c0 AS (SELECT {KEYED_SQL} FROM orders), c1 AS (SELECT {CASES_SQL} FROM c0), c AS (SELECT *, score - coalesce(second, 0) AS margin FROM c1)"

#: Catalog: the first snapshot lacks every tenth order and has every 23rd inactive; the second lacks every eleventh and has other
#: prices for every seventh.
CATALOG_FIELDS = ("o_orderpriority", "o_orderstatus", "price_cents")


def catalog_state(spark: SparkSession, d: str) -> DataFrame:
    from millrace.operators.catalog import content_hash

    o = t(spark, d, "orders").withColumn("price_cents", F.round(F.col("o_totalprice") * 100).cast("long")).filter("o_orderkey % 10 <> 0")
    return o.withColumn("content_hash", content_hash(o, CATALOG_FIELDS)).select("o_orderkey", (F.col("o_orderkey") % 23 != 0).alias("is_active"), F.lit("2024-01-01").alias("first_seen_at"), F.lit("2024-01-01").alias("last_seen_at"), F.when(F.col("o_orderkey") % 23 == 0, "2024-01-01").alias("inactive_since"), "content_hash", F.lit("b1").alias("batch"), F.struct(*CATALOG_FIELDS).alias("offer"))


def catalog_snapshot(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").filter("o_orderkey % 11 <> 0")
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus", (F.round(F.col("o_totalprice") * 100).cast("long") + F.when(F.col("o_orderkey") % 7 == 0, 100).otherwise(0)).alias("price_cents"))


_HASH = """sha256('{{"business_projection":{{"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '","price_cents":' || {p} || '}},"content_hash_version":"v1"}}')"""
CATALOG_CTE = f"""
oc AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS pc FROM orders),
s1 AS (SELECT o_orderkey, o_orderkey % 23 <> 0 AS act, pc AS p1, {_HASH.format(p='pc')} AS h1, o_orderpriority, o_orderstatus FROM oc WHERE o_orderkey % 10 <> 0),
s2 AS (SELECT o_orderkey, pc + CASE WHEN o_orderkey % 7 = 0 THEN 100 ELSE 0 END AS p2, {_HASH.format(p='(pc + CASE WHEN o_orderkey % 7 = 0 THEN 100 ELSE 0 END)')} AS h2 FROM oc WHERE o_orderkey % 11 <> 0),
d AS (SELECT coalesce(s1.o_orderkey, s2.o_orderkey) AS o_orderkey, h1, h2, act,
        CASE WHEN h2 IS NOT NULL AND h1 IS NULL THEN 'NEW' WHEN h2 IS NOT NULL AND NOT act THEN 'REACTIVATED' WHEN h1 = h2 THEN 'UNCHANGED' WHEN h2 IS NOT NULL THEN 'UPDATED' WHEN act THEN 'INACTIVATED' END AS change,
        CASE WHEN h1 <> h2 THEN 'price_cents' END AS changed FROM s1 FULL JOIN s2 ON s1.o_orderkey = s2.o_orderkey)"""


def department_of_orders(spark: SparkSession, d: str) -> DataFrame:
    """Customers with a postal code each: all departments' numbers and more come up."""
    c = t(spark, d, "customer")
    return c.select("c_custkey", F.lpad(((F.col("c_custkey") * 977) % 99000).cast("string"), 5, "0").alias("postal_code")).withColumn("department", geo.department(F.col("postal_code")))

"""Registered queries of field functions, and of sources and sinks: rows written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import geo, payload, scores, text
from millrace.functions.payload import LEVELS
from millrace.operators import normalize, training
from millrace.sources import readers, writers
from millrace.sources.tables import shared_dir

from .analogs import t
from .queries import query

# --- fields ---------------------------------------------------------------------------------------------------------------

_LEVEL_NAMES = list(LEVELS)


@query("SELECT p_partkey, CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{LEVELS[n]}'" for i, n in enumerate(_LEVEL_NAMES)) + " END AS level FROM part")
def level_codes(spark, d):
    label = F.try_element_at(F.array(*[F.lit(f" {n} ") for n in _LEVEL_NAMES], F.lit("autre")), (F.col("p_partkey") % 8 + 1).cast("int"))
    return t(spark, d, "part").select("p_partkey", payload.level_code(label).alias("level"))


_LINK = "CASE k % 6 WHEN 0 THEN '/job_postings?page=' || k WHEN 1 THEN 'job_postings?page=' || k WHEN 2 THEN '/api/job_postings?page=' || k WHEN 3 THEN ' ' WHEN 4 THEN 'https://example.org/api/job_postings?page=' || k ELSE 'http://example.org/api/job_postings?page=x' END"
_LINKS_CTE = f"x AS (SELECT k, {_LINK} AS url FROM (SELECT p_partkey AS k FROM part))"


def _links(spark, d):
    return t(spark, d, "part").select(F.col("p_partkey").alias("k")).selectExpr("k", f"{_LINK} AS url")


@query(f"WITH {_LINKS_CTE} SELECT k, CASE WHEN trim(url) = '' THEN NULL WHEN url LIKE '/job_postings%' THEN '/api' || url WHEN url LIKE 'job_postings%' THEN '/api/' || url ELSE url END AS next FROM x")
def next_links(spark, d):
    return _links(spark, d).select("k", payload.next_link(F.col("url")).alias("next"))


@query(f"WITH {_LINKS_CTE} SELECT k, k % 6 = 4 AS allowed, CASE WHEN k % 6 = 4 THEN CAST(k AS INT) END AS page FROM x")
def link_checks(spark, d):
    allowed = payload.is_allowed_link(F.col("url"), "example.org", "/api/job_postings")
    return _links(spark, d).select("k", allowed.alias("allowed"), F.when(allowed, payload.page_number(F.col("url"))).alias("page"))


_BLANKS = "CASE k % 5 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || CAST(k AS STRING) || ' ' WHEN 2 THEN CAST(k AS STRING) || 'x' WHEN 3 THEN NULL ELSE '007' END"


@query(f"WITH x AS (SELECT o_orderkey AS k, {_BLANKS} AS s FROM (SELECT o_orderkey, o_orderkey AS k FROM orders)) SELECT k, nullif(trim(s), '') AS clean, TRY_CAST(nullif(trim(s), '') AS INTEGER) AS number FROM x")
def blanks_and_numbers(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("k")).selectExpr("k", f"{_BLANKS} AS s")
    return o.select("k", text.blank_to_null(F.col("s")).alias("clean"), payload.whole_number(F.col("s")).alias("number"))


@query("""WITH x AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 <> 0 THEN ((o_orderkey * 7) % 101) / 100.0E0 END AS s FROM orders)
SELECT k, CASE WHEN s IS NULL THEN 'UNKNOWN' WHEN s >= 0.85 THEN 'MATCH' WHEN s >= 0.55 THEN 'PARTIAL_MATCH' ELSE 'NO_MATCH' END AS level, CAST(round_even(s * 100, 0) AS INT) AS percent FROM x""")
def similarity_levels(spark, d):
    s = F.when(F.col("k") % 13 != 0, ((F.col("k") * 7) % 101) / F.lit(100.0))
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("k")).select("k", scores.similarity_level(s).alias("level"), scores.percent(s).alias("percent"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 45 ELSE 0 END + CASE WHEN o_orderkey % 3 = 0 THEN 25 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 15 ELSE 0 END + CASE WHEN o_orderkey % 7 = 0 THEN 10 ELSE 0 END AS coverage FROM orders")
def data_coverage(spark, d):
    there = lambda n, blank: F.when(F.col("o_orderkey") % n == 0, "x").otherwise(F.lit(blank).cast("string"))
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), scores.data_coverage(there(2, None), there(3, " "), there(5, ""), there(7, None)).alias("coverage"))


@query("""SELECT o_orderkey AS k, lpad(CAST(s // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS clock, round(100.0 * done / 1000, 2) AS percent, CASE WHEN s > 0 THEN round(done / CAST(s AS DOUBLE), 6) END AS per_second, CASE WHEN s > 0 AND done > 0 THEN round((1000 - done) / (done / CAST(s AS DOUBLE)), 6) END AS seconds_left
FROM (SELECT o_orderkey, o_orderkey % 5000 AS s, o_orderkey % 1000 AS done FROM orders)""")
def progress(spark, d):
    s, done = F.col("k") % 5000, F.col("k") % 1000
    e = t(spark, d, "orders").select(F.col("o_orderkey").alias("k")).select("k", scores.minutes_seconds(s).alias("clock"), scores.eta(done, F.lit(1000), s).alias("e"))
    return e.select("k", "clock", "e.percent", F.round("e.per_second", 6).alias("per_second"), F.round("e.seconds_left", 6).alias("seconds_left"))


_COMMUNE = "CASE WHEN c_custkey % 9 = 0 THEN '97' || CAST(c_custkey % 7 AS STRING) || '05' ELSE lpad(CAST((c_custkey * 613) % 99000 AS STRING), 5, '0') END"
_REGION = " ".join(f"WHEN dep IN ({', '.join(repr(c) for c in codes)}) THEN '{name.replace(chr(39), chr(39) * 2)}'" for name, codes in geo.REGIONS.items())


@query(f"WITH x AS (SELECT c_custkey, CASE WHEN code LIKE '97%' THEN left(code, 3) ELSE left(code, 2) END AS dep FROM (SELECT c_custkey, {_COMMUNE.replace('STRING', 'VARCHAR')} AS code FROM customer)) SELECT c_custkey, CASE {_REGION} END AS region FROM x")
def commune_regions(spark, d):
    return t(spark, d, "customer").selectExpr("c_custkey", f"{_COMMUNE} AS code").select("c_custkey", geo.region_of_commune(F.col("code")).alias("region"))


@query("SELECT conv_id, turn, trim(replace(replace(text, chr(13), ' '), chr(10), ' ')) AS line FROM conversations")
def one_lines(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", text.one_line(F.col("text")).alias("line"))


@query("SELECT replace(code, 'RNCP', '') AS code_rncp, p_name FROM (SELECT CASE WHEN p_partkey % 4 = 0 THEN '-1' WHEN p_partkey % 4 <> 1 THEN 'RNCP' || CAST(p_partkey AS VARCHAR) END AS code, p_name FROM part) WHERE code IS DISTINCT FROM '-1'")
def clean_courses(spark, d):
    k = F.col("p_partkey")
    p = t(spark, d, "part").select(F.when(k % 4 == 0, "-1").when(k % 4 != 1, F.concat(F.lit("RNCP"), k.cast("string"))).alias("code_rncp"), "p_name", "p_size")
    return training.clean_courses(p, drop=("p_size",))


@query("SELECT p_partkey, CASE WHEN len(s) <= 1 THEN hits >= 1 ELSE hits >= 2 END AS named FROM (SELECT p_partkey, s, len(list_filter(s, lambda w: contains(p_name, w))) AS hits FROM (SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN ['a'] ELSE ['e', 'o', 'zz'] END AS s FROM part))")
def skills_named(spark, d):
    skills = F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("e"), F.lit("o"), F.lit("zz")))
    return t(spark, d, "part").select("p_partkey", text.skills_in_text(skills, F.col("p_name")).alias("named"))


@query("SELECT p_partkey, round(100.0 * len(list_intersect(a, b)) / CAST(len(a) AS DOUBLE), 4) AS percent FROM (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS a, list_distinct(string_split(lower(p_type), ' ')) || ['a'] || string_split(p_name, ' ')[1:1] AS b FROM part)")
def overlap_percents(spark, d):
    words = F.array_distinct(F.split("p_name", " "))
    other = F.concat(F.array_distinct(F.split(F.lower("p_type"), " ")), F.array(F.lit("a")), F.slice(F.split("p_name", " "), 1, 1))
    return t(spark, d, "part").select("p_partkey", scores.overlap_percent(words, other).alias("percent"))


# --- sources and sinks ----------------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, n_name, CAST(n_regionkey AS INT) AS n_regionkey, CAST(NULL AS VARCHAR) AS absent FROM nation")
def csv_round_trip(spark, d):
    """Declared columns by name in another order than the file's, one of them absent, identifiers as texts."""
    path = f"{shared_dir(spark)}/csv"
    writers.write_csv(t(spark, d, "nation").select("n_name", "n_regionkey", "n_nationkey"), path)
    return readers.read_csv(spark, path, "n_nationkey long, n_name string, n_regionkey int, absent string", required=("n_nationkey",))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def json_lines_round_trip(spark, d):
    path = f"{shared_dir(spark)}/jsonl"
    writers.write_jsonl(t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path)
    return readers.read_jsonl(spark, path, "o_orderkey long, o_orderstatus string", key="o_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def split_round_trip(spark, d):
    """One folder for each status, read as one table."""
    path = f"{shared_dir(spark)}/split"
    writers.write_split(t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, "o_orderstatus")
    return spark.read.schema("o_orderkey long, o_orderstatus string").json(path)


@query("SELECT doc_id, nullif(trim(lang), '') AS title, nullif(trim(text), '') AS description, nullif(trim(source), '') AS company FROM documents")
def snapshot_rows(spark, d):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("title"), F.col("text").alias("description"), F.col("source").alias("company"), F.lit(" ").alias("postal_code"), F.lit(None).cast("string").alias("occupation"))
    return readers.snapshot_rows(docs).select(F.col("id").alias("doc_id"), "title", "description", "company")


@query("SELECT r_name, count(*) AS files FROM region GROUP BY 1")
def digests_of_files(spark, d):
    """Every file's digest is that of its content: files that hold one region's name each, and their number."""
    path = f"{shared_dir(spark)}/files"
    names = [r[0] for r in t(spark, d, "region").select("r_name").collect()]  # a row for each region
    t(spark, d, "region").select("r_name", "r_regionkey").repartition(len(names), "r_name").write.partitionBy("r_name").format("json").save(path)
    found = readers.file_digests(spark, f"{path}/*/*.json").filter(F.length("sha256") == 64)
    return found.select(F.regexp_replace(F.regexp_extract("path", "r_name=([^/]+)/", 1), "%20", " ").alias("r_name")).groupBy("r_name").agg(F.count("*").alias("files"))


@query("SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1")
def latest_landing(spark, d):
    """Two landed batches; the later folder, of the first order of each priority, is read."""
    root = shared_dir(spark)
    o = t(spark, d, "orders").select("o_orderpriority", "o_orderkey")
    o.write.parquet(f"{root}/20240101_000000")
    training.first_by_key(o, ["o_orderpriority"], ["o_orderkey"], ["o_orderkey"]).write.parquet(f"{root}/20240201_000000")
    return spark.read.parquet(readers.latest_batch(spark, root))



@query()
def skill_token_sets(spark, d):
    """Tokens of two skills a part: its name with a slug, and a type alone."""
    skill = lambda n, name, slug: F.struct(n.alias("name_normalized"), name.alias("name"), slug.alias("slug"))
    none = F.lit(None).cast("string")
    skills = F.array(skill(F.lower("p_name"), F.col("p_name"), F.regexp_replace("p_brand", " ", "-")), skill(none, F.col("p_type"), none))
    return t(spark, d, "part").select("p_partkey", text.skill_tokens(skills).alias("tokens"))


@query("SELECT o_orderkey, trim(regexp_replace(regexp_replace(lower(o_orderpriority), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM orders")
def dedup_keys(spark, d):
    return t(spark, d, "orders").select("o_orderkey", text.dedup_key(F.col("o_orderpriority")).alias("key"))


_EXPOSED = "CASE k % 5 WHEN 0 THEN 'https://example.org/job_postings/' || CAST(k AS {0}) WHEN 1 THEN '/job_postings/' || CAST(k AS {0}) WHEN 2 THEN 'https://example.org/jobs?from=/job_postings/1' WHEN 3 THEN NULL ELSE 'https://example.org/jobs/1' END"


@query("SELECT o_orderpriority, count(*) FILTER (o_orderkey % 5 < 2) AS legacy FROM orders GROUP BY 1")
def legacy_urls(spark, d):
    o = t(spark, d, "orders").select("o_orderpriority", F.col("o_orderkey").alias("k")).selectExpr("o_orderpriority", f"{_EXPOSED.format('STRING')} AS url")
    return o.groupBy("o_orderpriority").agg(F.count_if(text.is_legacy_url(F.col("url"))).alias("legacy"))


@query("SELECT e.event_id, strftime(e.ts, '%Y%m%d_%H%M%S') AS batch FROM events AS e")
def batch_ids(spark, d):
    return t(spark, d, "events").select("event_id", scores.batch_id(F.col("ts")).alias("batch"))


@query("SELECT o_orderkey, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR))[1:3] AS best FROM (SELECT DISTINCT l_orderkey AS o_orderkey, l_linenumber, l_partkey FROM lineitem) GROUP BY 1")
def candidate_signatures(spark, d):
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", F.col("l_partkey").cast("string").alias("p")).alias("x")).distinct()
    ids = lines.groupBy("o_orderkey").agg(F.array_sort(F.collect_list("x")).alias("x")).withColumn("ids", F.transform("x", lambda x: x["p"]))
    return ids.select("o_orderkey", scores.candidate_signature(F.col("ids")).alias("best"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'x' END AS description, CASE WHEN o_orderkey % 2 = 0 THEN '75001' END AS postal_code, 'M1805' AS occupation, CAST(NULL AS VARCHAR) AS occupation_label, CAST(NULL AS VARCHAR) AS appellation, o_orderstatus AS company FROM orders")
def known_offer_rows(spark, d):
    k = F.col("o_orderkey")
    offer = F.struct(
        k.cast("string").alias("id"), F.col("o_orderpriority").alias("intitule"), F.when(k % 3 == 0, " x ").when(k % 3 == 1, "").alias("description"), F.struct(F.when(k % 2 == 0, "75001").alias("codePostal")).alias("lieuTravail"),
        F.lit("M1805").alias("romeCode"), F.lit(None).cast("string").alias("romeLibelle"), F.lit("").alias("appellationlibelle"), F.struct(F.concat(F.lit(" "), "o_orderstatus").alias("nom")).alias("entreprise"),
    )
    return normalize.known_offers(t(spark, d, "orders").select(offer.alias("offer")))


@query("SELECT n_nationkey, n_name FROM nation")
def csv_append(spark, d):
    """A first part, then all rows: those already written aren't written twice."""
    path, n = f"{shared_dir(spark)}/csv", t(spark, d, "nation").select("n_nationkey", "n_name")
    writers.append_csv(n.filter("n_nationkey < 10"), path, "n_nationkey")
    writers.append_csv(n, path, "n_nationkey")
    return readers.read_csv(spark, path, "n_nationkey long, n_name string")


@query("SELECT count(*) AS rows FROM customer")
def csv_row_count(spark, d):
    path = f"{shared_dir(spark)}/csv"
    writers.write_csv(t(spark, d, "customer").select("c_custkey", "c_name"), path)
    return readers.csv_rows(spark, path)


@query("SELECT r_regionkey, r_name FROM region WHERE r_regionkey < 2")
def first_reference(spark, d):
    """Of two landed reference folders, the first in name order."""
    root, r = shared_dir(spark), t(spark, d, "region").select("r_regionkey", "r_name")
    r.write.parquet(f"{root}/reference-2")
    r.filter("r_regionkey < 2").write.parquet(f"{root}/reference-1")
    return spark.read.parquet(readers.first_matching(spark, f"{root}/reference-*"))

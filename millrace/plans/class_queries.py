"""Registered queries of the occupation classifier over titles, whose scores SQL can express, and of its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import occupation
from millrace.operators.occupation import BASELINE, V1_A, V1_B
from millrace.sources.tables import table

from .analogs import OFFERS_CTE
from .queries import _known, _labels, _scored_sides, query


def _scores_sql(n: str, known: str, asked: str, c: occupation.Config) -> str:
    """CTEs named ..{n}: profiles of `known`, scores of `asked` (rows of the prepared sides), under one configuration."""
    often = f"SELECT f, token FROM f{n} GROUP BY 1, 2 HAVING count(*) > greatest(2, floor((SELECT count(DISTINCT occupation) FROM {known}) * {c.ratio}))" if c.ratio <= 1 else f"SELECT f, token FROM f{n} WHERE false"
    part = lambda x: f"round(100.0 * coalesce({x}, 0) / CAST(len(title_tokens) AS DOUBLE), 4)"
    return f"""kt{n} AS (SELECT occupation AS code, title, row_number() OVER (PARTITION BY occupation ORDER BY count(*) DESC, title) AS r FROM {known} WHERE title <> '' GROUP BY 1, 2),
kd{n} AS (SELECT occupation AS code, token, row_number() OVER (PARTITION BY occupation ORDER BY count(*) DESC, token) AS r FROM (SELECT occupation, unnest(title_tokens) AS token FROM {known}) GROUP BY 1, 2),
pt{n} AS (SELECT DISTINCT occupation AS code, string_split(occupation, '-')[1] AS token FROM {known} UNION SELECT kt{n}.code, unnest(title_tokens) FROM kt{n} JOIN (SELECT DISTINCT title, title_tokens FROM {known}) USING (title) WHERE r <= 80),
f{n} AS (SELECT 't' AS f, code, token FROM pt{n} UNION ALL SELECT 'd', code, token FROM (SELECT * FROM pt{n} UNION SELECT code, token FROM kd{n} WHERE r <= 160)),
of{n} AS ({often}), pf{n} AS (SELECT f{n}.* FROM f{n} ANTI JOIN of{n} USING (f, token)),
h{n} AS (SELECT id, code, count(*) FILTER (f = 't') AS th, count(*) FILTER (f = 'd') AS dh FROM (SELECT id, unnest(title_tokens) AS token FROM {asked}) JOIN pf{n} USING (token) GROUP BY 1, 2),
x{n} AS (SELECT id, code, 1 AS exact FROM {asked} JOIN (SELECT code, title FROM kt{n} WHERE r <= 80 UNION SELECT DISTINCT occupation, occupation FROM {known}) USING (title)),
s{n} AS (SELECT id, code, round(CASE WHEN len(title_tokens) > 0 THEN ({part('th')} * {c.title} + {part('dh')} * {c.description}) / 100 ELSE 0.0 END + coalesce(exact, 0) * {c.bonus}, 4) AS score, coalesce(th, 0) > 0 AS discriminant FROM h{n} FULL JOIN x{n} USING (id, code) JOIN {asked} USING (id)),
t{n} AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, code) AS r FROM s{n}),
b{n} AS (SELECT id, max(CASE WHEN r = 1 THEN code END) AS code, max(CASE WHEN r = 1 THEN score END) AS score, max(CASE WHEN r = 1 THEN score END) - coalesce(max(CASE WHEN r = 2 THEN score END), 0.0) AS margin, bool_or(discriminant) FILTER (r = 1) AS discriminant, list(code ORDER BY r) FILTER (r <= 3) AS codes FROM t{n} GROUP BY id)"""


_ONE = f"{OFFERS_CTE}, {_scores_sql('1', 'b', 'a', V1_A)}"


def _titles(spark, d):
    """Both sides with title tokens as their description's, and the scores of the incoming one."""
    a, b = map(table, _known(spark, d))
    return a, b, table(occupation.class_scores(a, occupation.profiles(b, _labels(b), V1_A.ratio)))


@query(f"WITH {_ONE} SELECT id, code, round(score, 3) AS score FROM s1")
def occupation_title_scores(spark, d):
    return _titles(spark, d)[2].select("id", "code", F.round("score", 3).alias("score"))


@query(f"WITH {_ONE} SELECT id, code, round(score, 3) AS score, round(margin, 3) AS margin, CASE WHEN coalesce(score, 0) < 60 THEN 'INSUFFICIENT' WHEN NOT coalesce(discriminant, false) THEN 'INSUFFICIENT' WHEN margin < 5 THEN 'AMBIGUOUS' ELSE 'AUTO_ASSIGNED' END AS status FROM a LEFT JOIN b1 USING (id)")
def occupation_title_assign(spark, d):
    a, _, scores = _titles(spark, d)
    best = a.select("id").join(occupation.best_class(scores), "id", "left").withColumn("matched_code", F.lit(None).cast("string")).withColumn("generic_title", F.lit(False))
    return best.select("id", "code", F.round("score", 3).alias("score"), F.round("margin", 3).alias("margin"), occupation.assignment()["status"].alias("status"))


@query(f"WITH {_ONE} SELECT occupation AS truth, code AS predicted, count(*) AS n FROM a LEFT JOIN b1 USING (id) GROUP BY ALL")
def occupation_title_confusion(spark, d):
    a, _, scores = _titles(spark, d)
    return occupation.confusion(a.select("id", F.col("code").alias("truth")).join(occupation.best_class(scores).select("id", "code"), "id", "left"))


# --- evaluation: offers whose title stands on the known side too count as present there, matched to the least id ---------------

_REFS = f"{OFFERS_CTE}, m AS (SELECT a.id, min(b.id) AS known_id FROM a JOIN b USING (title) WHERE a.title <> '' GROUP BY 1), refs AS (SELECT m.id, b.occupation AS code, known_id FROM m JOIN b ON b.id = known_id), hb AS (SELECT * FROM b WHERE id NOT IN (SELECT known_id FROM refs)), q AS (SELECT * FROM a WHERE id IN (SELECT id FROM refs))"


def _decisions(a, b):
    """Offers whose title stands on the known side. Known offers are one row a title before they meet, so no pair is made."""
    titles = b.filter("title <> ''").groupBy("title").agg(F.min("id").alias("best_id"))
    first = a.select("id", "title").join(titles, "title").groupBy("id").agg(F.min("best_id").alias("best_id"))
    return first.join(b.select(F.col("id").alias("best_id"), F.col("code").alias("best_code")), "best_id").withColumn("decision", F.lit("PRESENT"))


@query(f"WITH {_REFS} SELECT id, code, known_id FROM refs")
def occupation_references(spark, d):
    return occupation.references(_decisions(*_known(spark, d)))


@query(f"WITH {_REFS} SELECT id FROM hb")
def occupation_holdout(spark, d):
    a, b = map(table, _known(spark, d))
    return occupation.held_out(b, occupation.references(_decisions(a, b))).select("id")


def _benchmark(spark, d):
    a, b = map(table, _known(spark, d))
    return occupation.benchmark(a, b, _labels(b), table(occupation.references(_decisions(a, b))), "seed")


_THREE = f"{_REFS}, " + ", ".join(_scores_sql(c.name, "hb", "q", c) for c in (BASELINE, V1_A, V1_B))


@query(f"WITH {_THREE} " + " UNION ALL ".join(f"SELECT '{c.name}' AS config, count(*) AS n, count(*) FILTER (codes[1] = refs.code) AS top1, count(*) FILTER (list_contains(codes, refs.code)) AS top3, count(*) FILTER (codes IS NULL) AS unassigned FROM refs JOIN q USING (id) LEFT JOIN b{c.name} AS p USING (id)" for c in (BASELINE, V1_A, V1_B)))
def occupation_benchmark(spark, d):
    return _benchmark(spark, d)[0]


@query()
def occupation_benchmark_thresholds(spark, d):
    return _benchmark(spark, d)[1]


def _benchmark_of_texts(spark, d):
    """The evaluation over title, skills and whole text."""
    a, b = map(table, _scored_sides(spark, d))
    return occupation.benchmark(a, b, _labels(b), table(occupation.references(_decisions(a, b))), "seed")


@query()
def text_benchmark(spark, d):
    return _benchmark_of_texts(spark, d)[0]


@query()
def text_benchmark_thresholds(spark, d):
    return _benchmark_of_texts(spark, d)[1]

"""Imports by natural key, published runs, threshold cells and exact middles."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import occupation, ordering
from millrace.operators.imports import CourseImport, OfferImport
from millrace.sources.runs import Runs

ITEM = "source_id string, title string, description string, postal_code string, company string, codes array<string>, skills array<struct<id:string,slug:string,name:string>>, place long"


def item(i, title, codes, skills, place):
    return (i, title, None, "75001", "x", codes, [(a, b, c) for a, b, c in skills], place)


BATCHES = [
    [item("1", "one", [" ", "M1"], [("9", "java", "Java"), (None, "sql", "SQL"), (None, " ", "none")], 1), item("2", "two", None, [("9", "java", "Java again")], 2), item("1", "one again", ["M9"], [("8", "go", "Go")], 3), item(None, "nameless", ["M1"], [], 4)],
    [item("2", "two changed", ["M2"], [("8", "go", "Go"), ("9", "java", "Java")], 1), item("3", "three", [], [("7", "c", "C")], 2)],
]


def plain_import(batches):
    """One offer after another, as a session would add them."""
    offers, skills, links, out = {}, {}, set(), []
    for batch in batches:
        imported = skipped = left_out = 0
        for i, title, d, p, c, codes, its, _ in sorted(batch, key=lambda x: x[-1]):
            if i is None:
                left_out += 1
                continue
            code = next((x.strip() for x in codes or [] if x.strip()), None)
            if i in offers:
                skipped += 1
                offers[i][1] = offers[i][1] or code
            else:
                imported += 1
                offers[i] = [title, code]
            for a, b, name in its:
                s = (a or "").strip() or (b or "").strip()
                if s:
                    skills.setdefault(s, name)
                    links.add((i, s))
        out.append((imported, skipped, left_out))
    return offers, skills, links, out


def tables(imp):
    o, s, k = (x.rows().collect() for x in (imp.offers, imp.skills, imp.links))
    ids, codes = {r.offer_id: r.source_id for r in o}, {r.skill_id: r.code for r in s}
    assert sorted(ids) == list(range(1, len(o) + 1)) and sorted(codes) == list(range(1, len(s) + 1))
    return {r.source_id: [r.title, r.occupation] for r in o}, {r.code: r.label for r in s}, {(ids[r.offer_id], codes[r.skill_id]) for r in k}


def test_offers_as_one_after_another(spark, tmp_path):
    imp, counts = OfferImport(spark, f"{tmp_path}/t"), []
    for n, rows in enumerate(BATCHES):
        counts.append(imp.run(spark.createDataFrame(rows, ITEM), n))
    *want, seen = plain_import(BATCHES)
    assert tables(imp) == tuple(want)
    assert [(c["imported"], c["skipped"], c["left_out"]) for c in counts] == seen
    assert counts[1]["filled"] == 1 and sorted(r.code for r in imp.occupations.rows().collect()) == ["M1", "M2", "M9"]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    """The second batch dies before its links, then runs again: same ids, same counts."""
    imp = OfferImport(spark, f"{tmp_path}/t")
    imp.run(spark.createDataFrame(BATCHES[0], ITEM), 0)
    monkeypatch.setattr(imp.links, "merge", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        imp.run(spark.createDataFrame(BATCHES[1], ITEM), 1)
    monkeypatch.undo()
    first = imp.run(spark.createDataFrame(BATCHES[1], ITEM), 1)
    assert first == imp.run(spark.createDataFrame(BATCHES[1], ITEM), 1) and first["imported"] == 1
    assert tables(imp) == tuple(plain_import(BATCHES)[:3])


def test_courses_with_children(spark, tmp_path):
    schema = "title string, siret string, code_rncp string, level string, modality string, region string, year int, month int, entries long, partial long, total long, code string, place long"
    row = lambda t, m, e, code, place: (t, "s", "37", "NIV5", "x", "r", 2024, m, e, 0, e, code, place)
    imp = CourseImport(spark, f"{tmp_path}/t")
    one = imp.run(spark.createDataFrame([row("a", 1, 5, "M1", 1), row("a", 1, 9, "M2", 2), row("a", 2, 6, "M1", 3), row("b", None, 1, None, 4)], schema), 0)
    assert (one["imported"], one["skipped"], one["new_flows"], one["new_occupations"]) == (2, 2, 2, 2)
    two = imp.run(spark.createDataFrame([row("a", 3, 7, "M3", 1), row("c", 1, 2, "M1", 2)], schema), 1)
    assert (two["imported"], two["skipped"], two["new_flows"]) == (1, 1, 1)
    assert sorted((r.course_id, r.month, r.entries) for r in imp.flows.rows().collect()) == [(1, 1, 5), (1, 2, 6), (3, 1, 2)]


def test_runs_are_published_whole_or_not_at_all(spark, tmp_path):
    runs, df = Runs(spark, f"{tmp_path}/runs"), spark.range(100).withColumn("x", F.col("id") % 7)
    with pytest.raises(ValueError, match="no published run"):
        runs.manifest()
    told = runs.publish("r1", {"t": df, "none": df.limit(0)}, {"in": df})
    assert told["outputs"]["t"]["rows"] == 100 and told["outputs"]["none"]["rows"] == 0 and runs.current() == "r1"
    assert runs.publish("r2", {"none": df.limit(0), "t": df.orderBy(F.desc("id")).repartition(3)})["unchanged"] and runs.current() == "r1"
    with pytest.raises(ValueError, match="too few"):
        runs.publish("r3", {"t": df.limit(3)}, check=lambda n: ["too few"] if n["t"] < 50 else [])
    with pytest.raises(FileExistsError):
        runs.publish("r1", {"t": df})
    assert runs.current() == "r1" and runs.read("t").count() == 100 and runs.same_inputs({"in": df}) == [] and runs.same_inputs({"in": df.limit(9)}) == ["in"]
    assert runs.publish("r4", {"t": df.limit(60)})["unchanged"] is False and runs.current() == "r4" and runs.read("t", "r1").count() == 100
    df.limit(60).withColumn("x", F.lit(1).cast("long")).write.mode("overwrite").parquet(f"{tmp_path}/runs/r4/t")
    with pytest.raises(ValueError, match="isn't what r4 published"):
        runs.read("t")
    with pytest.raises(ValueError, match="no table"):
        runs.read("other")


def test_threshold_cells(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 49.9, 50.0, 64.99, 65.0, 80.0, 99.0]), rng.choice([None, 0.0, 5.0, 9.9, 10.0, 30.0, 50.0]), rng.choice(["a", "b", None]), rng.choice(["a", "b"])) for _ in range(300)]
    got = {(r.min_score, r.min_margin): (r.covered, r.correct) for r in occupation.threshold_grid(spark.createDataFrame(rows, "score double, margin double, code string, truth string")).collect()}
    for s in range(50, 81, 5):
        for m in range(5, 31, 5):
            in_ = [r for r in rows if r[0] is not None and r[1] is not None and r[0] >= s and r[1] >= m]
            assert got[s, m] == (len(in_), sum(r[2] == r[3] for r in in_))
    assert len(got) == 42


def test_middles(spark):
    rng = random.Random(6)
    for values in ([3.0], [1.0, 2.0], [5.0] * 9, [rng.gauss(0, 1e6) for _ in range(501)], [rng.choice([1.0, 1e12, -7.0]) for _ in range(100)], [2.0, None, 9.0, None]):
        df, real = spark.createDataFrame([(v,) for v in values], "v double"), sorted(v for v in values if v is not None)
        assert ordering.exact_median(df, "v") == statistics.median(real)
        assert ordering.at_ranks(df, "v", [0, len(real) - 1]) == [real[0], real[-1]]
    assert ordering.exact_median(spark.createDataFrame([], "v double"), "v") is None

"""Text functions of one select share a Python worker, and give the rows of their plain functions."""

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import matching

SCHEMA = "id string, title string, description string, company string, postal_code string, locality string, occupation string"


def test_texts_of_an_offer_share_a_worker(spark):
    """Before, each of the four texts had a worker of its own in every task."""
    offers = spark.createDataFrame([("a", "t", "d", "c", "75001", "l", "o")], SCHEMA)
    plan = matching.prepare(offers)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan


def test_batches_of_any_size(spark):
    values = [None, "", "É & <b>x</b>", "plain"] * 900 + ["last"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    got = df.select("i", text.normalize_description(F.col("v")).alias("d"), text.clean_text(F.col("v")).alias("c")).orderBy("i").collect()
    assert [(r.d, r.c) for r in got] == [(text.normal("description", v), text.clean(v)) for v in values]
    assert spark.createDataFrame([], "v string").select(text.fold(F.col("v"))).collect() == []

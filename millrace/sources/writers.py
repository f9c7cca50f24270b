"""Sinks: CSV, JSON lines, split outputs, review queues, reports; Spark's commit makes each of them whole or absent."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ";", mode: str = "errorifexists") -> None:
    df.write.csv(path, sep=sep, header=True, mode=mode)


def append_csv(df: DataFrame, path: str, key: str, sep: str = ";") -> None:
    """Append rows whose key isn't written yet, so an interrupted run resumes; each of Spark's files has the header of its own."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        done = spark.read.csv(path, sep=sep, header=True).select(F.col(key).cast(df.schema[key].dataType).alias(key))
        df = df.join(done, key, "left_anti").select(*df.columns)
    write_csv(df, path, sep, "append")


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.option("ignoreNullFields", "false").json(path, mode=mode)


def write_split(df: DataFrame, path: str, by: str, mode: str = "errorifexists") -> None:
    """One folder for each value of `by`."""
    df.write.partitionBy(by).option("ignoreNullFields", "false").json(path, mode=mode)


def write_if_changed(df: DataFrame, path: str, digest: str | None = None) -> str:
    """Write JSON lines unless the content's digest is the one given; the digest is free of row order."""
    row = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    n, h = df.agg(F.count("*"), F.sum(row)).first()
    now = f"{n}-{h}"
    if now != digest:
        write_jsonl(df, path, "overwrite")
    return now


REVIEW_COLUMNS = ("id", "title", "company", "decision", "priority", "action", "score", "reasons_text")


def review_rows(queue: DataFrame, columns: tuple[str, ...] = REVIEW_COLUMNS) -> DataFrame:
    """The queue with its reasons in writing and its columns in order."""
    return queue.withColumn("reasons_text", F.array_join("reasons", "; ")).select(*columns)


def write_review_csv(queue: DataFrame, path: str) -> None:
    """For spreadsheets: a byte-order mark in front of the header's first name."""
    rows = review_rows(queue)
    rows.withColumnRenamed(rows.columns[0], "﻿" + rows.columns[0]).write.csv(path, sep=";", header=True)


def markdown(counts: DataFrame, title: str, most: int = 200) -> str:
    """A small table of counts as Markdown; for aggregates, not for rows."""
    rows = counts.limit(most).collect()
    lines = [f"# {title}", "", "| " + " | ".join(counts.columns) + " |", "|" + " --- |" * len(counts.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def review_page(queue: DataFrame, title: str, most: int = 2000) -> str:
    """A self-contained page that lists a review queue and filters it by text, priority and score. `most` is the page's size."""
    rows = [json.loads(x) for x in queue.limit(most).toJSON().collect()]
    data = json.dumps(rows, ensure_ascii=False).replace("</", "<\\/")
    return f"""<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title>
<h1>{html.escape(title)}</h1><input id="q" placeholder="title, company or id"><select id="p"><option value="">all<option>HAUTE<option>MOYENNE<option>FAIBLE</select><input id="s" type="number" value="0">
<table id="t"></table><script>
const rows = {data};
const show = () => {{
  const q = document.getElementById("q").value.toLowerCase(), p = document.getElementById("p").value, s = +document.getElementById("s").value;
  const keep = rows.filter(r => (!q || [r.title, r.company, r.id].some(x => (x || "").toLowerCase().includes(q))) && (!p || r.priority === p) && (r.score || 0) >= s);
  const t = document.getElementById("t"); t.replaceChildren();
  for (const r of keep) {{ const tr = t.insertRow(); for (const k of ["id", "title", "company", "priority", "score"]) tr.insertCell().textContent = r[k] ?? ""; }}
}};
for (const id of ["q", "p", "s"]) document.getElementById(id).oninput = show;
show();
</script>
"""


def filter_queue(queue: DataFrame, contains: str | None = None, priority: str | None = None, least_score: float | None = None) -> DataFrame:
    """The page's filters over the whole queue."""
    if contains:
        q = contains.lower()
        queue = queue.filter(F.contains(F.lower(F.concat_ws("\n", "title", "company", "id")), F.lit(q)))
    if priority:
        queue = queue.filter(F.col("priority") == priority)
    if least_score is not None:
        queue = queue.filter(F.coalesce("score", F.lit(0.0)) >= least_score)
    return queue

"""Streams: keyed state that a batch changes by its own size, and batches that fail after any step and are repeated."""

import pytest
from pyspark.sql import functions as F

from millrace.streaming import ingest
from tests.test_operators import fold_payloads

STATE = "k long, is_active boolean, first_seen_at string, last_seen_at string, inactive_since string, content_hash string, batch string, offer struct<a:string,b:long>"
SNAPSHOTS = {"s1": [(1, "x", 1), (2, "y", 2)], "s2": [(1, "x", 9), (3, "z", 3)], "s3": [(2, "y", 2), (3, "z", 3)], "s4": [(1, "x", 9), (2, "q", 2), (3, "z", 3)]}


def sync(spark, root, now=str):
    s = ingest.landing_stream(spark, f"{root}/in", "k long, a string, b long, snapshot string", "parquet", 2)
    return ingest.sync_snapshots(s, "k", ["a", "b"], "snapshot", f"{root}/state", f"{root}/log", f"{root}/checkpoint", spark.createDataFrame([], STATE), now)


def land(spark, root, names):
    for name in names:
        spark.createDataFrame([(*r, name) for r in SNAPSHOTS[name]], "k long, a string, b long, snapshot string").coalesce(1).write.mode("append").parquet(f"{root}/in")


def state_and_log(spark, root):
    state = ingest.Versions(spark, f"{root}/state").before()
    kept = sorted(tuple(r) for r in state.select("k", "is_active", "first_seen_at", "last_seen_at", "inactive_since", "batch", "offer.a", "offer.b").collect())
    log = sorted(tuple(r) for r in spark.read.parquet(f"{root}/log").select("changed_at", "change_type", "k", F.col("changed_fields").cast("string")).collect())
    return kept, log


def test_snapshots_by_hand(spark, tmp_path):
    land(spark, tmp_path, SNAPSHOTS)
    sync(spark, tmp_path).awaitTermination()
    kept, log = state_and_log(spark, tmp_path)
    assert kept == [(1, True, "s1", "s4", None, "s4", "x", 9), (2, True, "s1", "s4", None, "s4", "q", 2), (3, True, "s2", "s4", None, "s4", "z", 3)]
    assert log == [
        ("s1", "NEW", 1, None), ("s1", "NEW", 2, None), ("s2", "INACTIVATED", 2, None), ("s2", "NEW", 3, None), ("s2", "UPDATED", 1, "[b]"), ("s3", "INACTIVATED", 1, None),
        ("s3", "REACTIVATED", 2, None), ("s4", "REACTIVATED", 1, None), ("s4", "UPDATED", 2, "[a]"),
    ]


@pytest.mark.parametrize("fails_at", [1, 2, 5, 6])
def test_a_batch_killed_after_any_step_gives_the_same_state(spark, tmp_path, fails_at):
    """Two files a batch and two snapshots in each; `now` is asked before and after each write."""
    land(spark, tmp_path, SNAPSHOTS)
    calls = []

    def now(name):
        calls.append(name)
        if len(calls) == fails_at + 1:
            raise RuntimeError("killed")
        return name

    with pytest.raises(Exception, match="killed"):
        sync(spark, tmp_path, now).awaitTermination()
    sync(spark, tmp_path).awaitTermination()
    land(spark, tmp_path / "once", SNAPSHOTS)
    sync(spark, tmp_path / "once").awaitTermination()
    assert state_and_log(spark, tmp_path) == state_and_log(spark, tmp_path / "once")


def test_what_a_snapshot_writes_doesn_t_grow_with_the_state(spark, tmp_path):
    v = ingest.Versions(spark, f"{tmp_path}/state")
    big = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.col("id").alias("b"), F.lit("s1").alias("snapshot"))
    big.coalesce(1).write.parquet(f"{tmp_path}/in")
    sync(spark, tmp_path).awaitTermination()
    for name in ("s2", "s3", "s4"):
        spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.col("id").alias("b"), F.lit(name).alias("snapshot")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        sync(spark, tmp_path).awaitTermination()
    rows = [spark.read.parquet(f"{tmp_path}/state/{'-'.join(map(str, n))}").count() for n in v.whole()]
    assert rows == [5000, 5000, 20, 20] and v.before().count() == 5000 and v.before().filter("is_active").count() == 20


def test_folders_are_united(spark, tmp_path):
    """State and log stay the same; folders of the batch in progress and of later ones aren't touched."""
    v = ingest.Versions(spark, f"{tmp_path}/state", keep=3)
    for n in range(6):
        v.write(spark.createDataFrame([(n % 4, f"v{n}")], "k int, p string"), "k", n)
    before = sorted(map(tuple, v.before().collect())), sorted(map(tuple, v.before(4).collect()))
    assert v.unite(4) and v.whole() == [(4,), (5,)]
    assert before == (sorted(map(tuple, v.before().collect())), sorted(map(tuple, v.before(4).collect())))
    assert not v.unite(6) and sorted(map(tuple, v.before().collect())) == [(0, "v4"), (1, "v5"), (2, "v2"), (3, "v3")]


def arrivals(n):
    return [(i * i % 7, [None, "", "2024-01", "2024-02", "2024-03"][i * 3 % 5], i, f"p{i}") for i in range(n)]


def test_a_hot_key_s_arrivals_are_narrowed_first():
    import pandas as pd

    rows = [(1, f"{i % 9}", i, f"p{i}") for i in range(5000)] + [(1, None, 5000, "restart"), (1, "3", 5001, "a"), (1, "1", 5002, "b"), (1, "1", 5003, "c")]
    got = ingest._could_win(pd.DataFrame(rows, columns=["k", "u", "o", "p"]), ["k"], "u", "o")
    assert sorted(got["o"]) == [5000, 5001, 5003]


def test_newest_payloads_write_changed_keys_alone(spark, tmp_path):
    schema, rows = "k int, u string, o long, p string", arrivals(60)
    for i in range(0, 60, 12):
        spark.createDataFrame(rows[i : i + 12], schema).repartition(2).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        s = ingest.landing_stream(spark, f"{tmp_path}/in", schema, "parquet", 1)  # a new start for each file
        ingest.newest_payloads(s, "k", "p", "u", "o", f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    v = ingest.Versions(spark, f"{tmp_path}/state")
    assert {r.k: r.p for r in v.before().collect()} == fold_payloads(rows)
    assert {r.k: r.p for r in v.before(2).collect()} == fold_payloads(rows[:24])
    assert max(spark.read.parquet(f"{tmp_path}/state/{n[0]}").count() for n in v.whole()) <= 7


def test_replay_of_a_failed_batch(spark, tmp_path, monkeypatch):
    """The batch fails after its folder is written; the next start repeats it."""
    schema, rows = "k int, u string, o long, p string", arrivals(24)
    for i in (0, 12):
        spark.createDataFrame(rows[i : i + 12], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    start = lambda: ingest.newest_payloads(ingest.landing_stream(spark, f"{tmp_path}/in", schema, "parquet", 1), "k", "p", "u", "o", f"{tmp_path}/state", f"{tmp_path}/cp").awaitTermination()
    real = ingest.Versions.write

    def once(self, changed, key, batch, step=None):
        real(self, changed, key, batch, step)
        if batch == 1:
            raise RuntimeError("killed")

    monkeypatch.setattr(ingest.Versions, "write", once)
    with pytest.raises(Exception, match="killed"):
        start()
    monkeypatch.setattr(ingest.Versions, "write", real)
    start()
    assert {r.k: r.p for r in ingest.Versions(spark, f"{tmp_path}/state").before().collect()} == fold_payloads(rows)

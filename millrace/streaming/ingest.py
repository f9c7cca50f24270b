"""Streaming: landed pages to the newest payload of each key, and snapshots to the catalog's state."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.catalog import change_log, snapshot_diff


def landing_stream(spark: SparkSession, path: str, schema: str | StructType, format_: str = "json", files_per_batch: int = 100, **options) -> DataFrame:
    """New files of a folder, a bounded number at a time; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).format(format_).option("maxFilesPerTrigger", files_per_batch).options(**options).load(path)


class Versions:
    """State by key as a log of changes: each batch writes the rows that it changed to a folder of its own, and a key's newest row
    counts. What a batch writes grows with the batch, not with the state.

    A folder is named by its batch, or by batch and step where a batch has several; it counts once it is whole. The state before a
    batch never rests on the batch itself, so a batch that failed after any of its steps can be repeated. Folders of committed
    batches are united into one when there are `keep` of them and they are larger than what was united before, so rows are
    rewritten a bounded number of times on average; a batch in progress is never touched by that."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 8):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self, prefix: str = "") -> dict[tuple[int, ...], str]:
        """Whole folders by number, in order: of a batch 5 it is (5,), of its third step (5, 2)."""
        fs = self._fs()
        names = [f.getPath().getName() for f in fs.listStatus(self._path())] if fs.exists(self._path()) else []
        found = {tuple(map(int, m[1].split("-"))): n for n in names if (m := re.fullmatch(prefix + "([0-9]+(?:-[0-9]+)?)", n)) and fs.exists(self._path(n, "_SUCCESS"))}
        return dict(sorted(found.items()))

    def whole(self) -> list[tuple[int, ...]]:
        return list(self._folders())

    def before(self, batch: int | tuple[int, ...] | None = None) -> DataFrame | None:
        """The state from all that was written before a batch or a step of it."""
        limit = (batch,) if isinstance(batch, int) else batch
        earlier = lambda v: limit is None or v < limit
        united = [(v, n) for v, n in self._folders("to-").items() if earlier(v)][-1:]
        names = [n for _, n in united] + [n for v, n in self._folders().items() if earlier(v) and not (united and v <= united[0][0])]
        if not names:
            return None
        rows = self.spark.read.parquet(*[f"{self.root}/{n}" for n in names])
        keys = [f.name for f in rows.schema if f.metadata.get("key")]
        rest = [c for c in rows.columns if c not in keys]
        marked = [F.col(k).alias(k, metadata={"key": True}) for k in keys]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__number").alias("__row")).select(*marked, "__row.*").drop("__number")

    def write(self, changed: DataFrame, key: str | Sequence[str], batch: int, step: int | None = None) -> DataFrame:
        """Write the rows that a batch or a step of it changed, one for each key (of one or more columns); gives them as written."""
        keys = [key] if isinstance(key, str) else list(key)
        name = f"{batch}" if step is None else f"{batch}-{step}"
        number = F.array(F.lit(batch), F.lit(-1 if step is None else step))
        changed.select(*[F.col(k).alias(k, metadata={"key": True}) for k in keys], *[c for c in changed.columns if c not in keys], number.alias("__number")).write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.parquet(f"{self.root}/{name}").drop("__number")

    def unite(self, batch: int) -> bool:
        """Unite the folders of batches before this one, which are committed when it begins, if they are many and large enough."""
        fs, size = self._fs(), lambda names: sum(self._fs().getContentSummary(self._path(n)).getLength() for n in names)
        united, some = self._folders("to-"), {v: n for v, n in self._folders().items() if v < (batch,)}
        if len(some) < self.keep or size(some.values()) < size(united.values()):
            return False
        last = next(reversed(some))
        state = self.before(batch)
        number = F.array(F.lit(last[0]), F.lit(last[1] if len(last) > 1 else -1))
        state.withColumn("__number", number).write.mode("overwrite").parquet(f"{self.root}/to-{some[last]}")
        for n in [*united.values(), *some.values()]:
            fs.delete(self._path(n), True)
        return True


def _could_win(rows: pd.DataFrame, key: list[str], updated: str, order: str) -> pd.DataFrame:
    """Of each key the arrivals that may still be kept: the last without an update text and, of those behind it, each that has a
    greater text than all later ones."""
    rows = rows.assign(**{updated: rows[updated].where(rows[updated] != "", None)}).sort_values([*key, order], ascending=False, kind="stable")
    keep, last, best = [], object(), None
    for k, u in zip(rows[key].itertuples(index=False, name=None), rows[updated]):
        if k != last:
            last, best, done = k, None, False
        fresh = not done and (u is None or best is None or u > best)
        keep.append(fresh)
        if fresh:
            done, best = u is None, u
    return rows[keep]


def _winners(rows: list[tuple]) -> list[tuple]:
    """_could_win of one key's (payload, updated, order), without pandas: a key has few rows in a batch, and there are many keys."""
    keep, best = [], None
    for row in sorted(rows, key=lambda r: r[2], reverse=True):
        if row[1] is None or best is None or row[1] > best:
            keep.append(row)
            best = row[1]
            if best is None:
                break
    return keep


def newest_payloads(stream: DataFrame, key: str, payload: str, updated: str, order: str, state: str, checkpoint: str) -> StreamingQuery:
    """Keeps the payload of each key by the rule of dedupe_payloads, over batches that arrive in order.

    The kept payloads are in Spark's state store, which reads and writes the keys of a batch alone; those that a batch changed go
    to `state`, a log of Versions. Arrivals that can't win are dropped before the shuffle, so a hot key sends few rows a task."""
    kinds = {c: stream.schema[c].dataType.simpleString() for c in (key, payload, updated)}
    schema = f"{key} {kinds[key]}, {payload} {kinds[payload]}, {updated} {kinds[updated]}, {order} long"
    versions = Versions(stream.sparkSession, state)

    def narrow(batches):
        for pdf in batches:
            yield _could_win(pdf, [key], updated, order)

    def fold(k, batches, kept):
        rows = []
        for pdf in batches:
            texts = [None if u is None or u == "" or u != u else u for u in pdf[updated].tolist()]
            rows = _winners([*rows, *zip(pdf[payload].tolist(), texts, pdf[order].tolist())])
        old = new = kept.get if kept.exists else None
        for p, u, o in sorted(rows, key=lambda r: r[2]):
            if new is None or u is None or new[1] is None or u >= new[1]:
                new = (p, u, int(o))
        if new is not old:
            kept.update(new)
            yield pd.DataFrame(dict(zip((key, payload, updated, order), ([v] for v in (k[0], *new)))))

    def write(batch: DataFrame, n: int) -> None:
        versions.unite(n)
        versions.write(batch, key, n)

    rows = stream.select(key, payload, updated, F.col(order).cast("long").alias(order)).mapInPandas(narrow, schema)
    changed = rows.groupBy(key).applyInPandasWithState(fold, schema, f"{payload} {kinds[payload]}, {updated} {kinds[updated]}, {order} long", "update", "NoTimeout")
    return changed.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sync_snapshots(stream: DataFrame, key: str, fields: Sequence[str], batch_column: str, state: str, log: str, checkpoint: str, empty_state: DataFrame, now: Callable[[str], str] = str) -> StreamingQuery:
    """Each snapshot (the rows of a batch_column value, oldest first) brings the catalog's state up to date and logs its changes.

    A snapshot writes its own rows and those that it made inactive; offers that stay away are not written again. The change log is
    read off what was written, so both come from one join."""
    versions = Versions(stream.sparkSession, state)

    def merge(batch: DataFrame, n: int) -> None:
        versions.unite(n)
        names = [r[0] for r in batch.select(batch_column).distinct().orderBy(batch_column).collect()]  # snapshots, not rows
        for i, name in enumerate(names):
            current = versions.before((n, i))
            diff = snapshot_diff(empty_state if current is None else current, batch.filter(F.col(batch_column) == name).select(key, *fields), key, fields, now(name), name)
            written = versions.write(diff.filter("change IS NOT NULL"), key, n, i)
            change_log(written, key, now(name)).write.mode("overwrite").parquet(f"{log}/batch={n}/step={i}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame, key: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def resume(work: DataFrame, done: DataFrame | None, keys: list[str]) -> DataFrame:
    """The work that isn't done yet."""
    return work if done is None else work.join(done.select(*keys).distinct(), keys, "left_anti")


def replay(reference: DataFrame, parent: DataFrame, key: str = "query", order: str = "place") -> DataFrame:
    """(key, order, reused): the reference's queries in their order, those that succeeded in the parent batch marked for reuse; all
    others are asked again."""
    done = parent.filter("status = 'OK'").select(key).distinct().withColumn("__done", F.lit(True))
    return reference.join(done, key, "left").select(key, order, F.coalesce("__done", F.lit(False)).alias("reused"))


def merged_results(reference: DataFrame, reused: DataFrame, retried: DataFrame, key: str = "query", order: str = "place") -> DataFrame:
    """Results of reused and retried queries with the reference's place; a retried query replaces what was reused."""
    new = retried.select(key).distinct()
    both = reused.join(new, key, "left_anti").unionByName(retried)
    return both.join(reference.select(key, order), key)


def revisited(pages: DataFrame, url: str = "url", order: str = "pos") -> DataFrame:
    """Pages whose link was visited before: the walk would go round."""
    first = pages.groupBy(url).agg(F.min(order).alias("__first"))
    return pages.join(first, url).filter(F.col(order) > F.col("__first")).drop("__first")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row, rows and input_hash: the same for the same rows in any order."""
    h = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(h).cast("string").alias("input_hash"))


def resume_checked(work: DataFrame, done: DataFrame | None, done_hash: str | None, keys: list[str]) -> DataFrame:
    """The work that isn't done yet; done rows that belong to other inputs are an error."""
    mine = fingerprint(work).first()["input_hash"]
    if done is not None and done_hash != mine:
        raise ValueError(f"the checkpoint belongs to other inputs: {done_hash} instead of {mine}")
    return resume(work, done, keys)

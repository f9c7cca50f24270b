"""The differential catalog: content hash, snapshot differences, change log, checks and promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

CLASSES = ("NEW", "UPDATED", "UNCHANGED", "REACTIVATED", "INACTIVATED")


def canonical(c: Column, kind: DataType) -> Column:
    """JSON text of a value with sorted fields, nulls kept and every list in the order of its items' texts."""
    if isinstance(kind, StructType):
        parts = [F.concat(F.lit(f'"{f.name}":'), canonical(c.getField(f.name), f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.coalesce(F.when(c.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))), F.lit("null"))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(F.array_sort(F.transform(c, lambda x: canonical(x, kind.elementType))), ","), F.lit("]"))), F.lit("null"))
    wrapped = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(wrapped, 6, 1 << 30).substr(F.lit(1), F.length(wrapped) - 6)


def content_hash(df: DataFrame, fields: Sequence[str], version: str = "v1") -> Column:
    """SHA-256 of the version and the canonical business fields."""
    parts = [F.concat(F.lit(f'"{f}":'), canonical(F.col(f), df.schema[f].dataType)) for f in sorted(fields)]
    return F.sha2(F.concat(F.lit('{"business_projection":{'), F.concat_ws(",", *parts), F.lit(f'}},"content_hash_version":"{version}"}}')), 256)


def changed_fields(fields: Sequence[str], old: str, new: str) -> Column:
    """Sorted names of the fields in which two structs differ."""
    return F.array_compact(F.array(*[F.when(~F.col(f"{old}.{f}").eqNullSafe(F.col(f"{new}.{f}")), F.lit(f)) for f in sorted(fields)]))


def snapshot_diff(state: DataFrame, snapshot: DataFrame, key: str, fields: Sequence[str], now: str, batch: str) -> DataFrame:
    """The next state with each row's change class (null where an inactive row stays away).

    state(key, is_active, first_seen_at, last_seen_at, inactive_since, content_hash, batch, offer struct of fields);
    snapshot(key, fields...). One full outer join on the key."""
    s = snapshot.withColumn("new_hash", content_hash(snapshot, fields)).select(F.col(key), "new_hash", F.struct(*sorted(fields)).alias("new_offer"))
    p = state.select(F.col(key), *[F.col(c).alias(f"old_{c}") for c in ("is_active", "first_seen_at", "last_seen_at", "inactive_since", "content_hash", "batch", "offer")])
    j = p.join(s, key, "full_outer")
    here, was = F.col("new_hash").isNotNull(), F.col("old_content_hash").isNotNull()
    same = F.col("old_content_hash") == F.col("new_hash")
    change = (
        F.when(here & ~was, "NEW").when(here & ~F.col("old_is_active"), "REACTIVATED").when(here & same, "UNCHANGED").when(here, "UPDATED")
        .when(F.col("old_is_active"), "INACTIVATED")
    )
    at = F.lit(now)
    diff = F.when(here & was & ~same, changed_fields(fields, "old_offer", "new_offer"))
    return j.select(
        F.col(key), here.alias("is_active"), F.coalesce("old_first_seen_at", at).alias("first_seen_at"), F.when(here, at).otherwise(F.col("old_last_seen_at")).alias("last_seen_at"),
        F.when(change == "INACTIVATED", at).when(~here, F.col("old_inactive_since")).alias("inactive_since"),
        F.coalesce("new_hash", "old_content_hash").alias("content_hash"), F.col("old_content_hash").alias("previous_hash"),
        F.when(here | (change == "INACTIVATED"), F.lit(batch)).otherwise(F.col("old_batch")).alias("batch"), change.alias("change"), diff.alias("changed_fields"),
        F.when(change == "REACTIVATED", ~same).alias("content_changed_on_reactivation"), F.coalesce("new_offer", "old_offer").alias("offer"),
    )


def state_of(diff: DataFrame) -> DataFrame:
    return diff.drop("change", "changed_fields", "previous_hash", "content_changed_on_reactivation")


def change_log(diff: DataFrame, key: str, now: str) -> DataFrame:
    """A row for every change; rows that stayed as they were have none."""
    return diff.filter("change IS NOT NULL AND change <> 'UNCHANGED'").select(F.lit(now).alias("changed_at"), F.col("change").alias("change_type"), F.col(key), F.col("previous_hash").alias("previous_content_hash"), F.when(F.col("change") != "INACTIVATED", F.col("content_hash")).alias("new_content_hash"), "changed_fields")


def diff_counts(diff: DataFrame) -> DataFrame:
    """One row: offers before and after, active ones, and each class; `ok` is the invariant that classes add up."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    one = diff.agg(n(F.col("previous_hash").isNotNull()).alias("before"), F.count("*").alias("after"), n(F.col("is_active")).alias("active"), *[n(F.coalesce(F.col("change") == c, F.lit(False))).alias(c.lower()) for c in CLASSES])
    return one.withColumn("ok", F.col("new") + F.col("updated") + F.col("unchanged") + F.col("reactivated") == F.col("active"))


def incoherent_rows(state: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Stored rows whose content no longer gives their hash."""
    flat = state.select(F.col(key), F.col("content_hash").alias("__stored"), "offer.*")
    return flat.filter(content_hash(flat, fields) != F.col("__stored")).select(key)


def gate(status: str | None, failed: int | None, requested: int | None, succeeded: int | None, failed_pages: list | None, next_url: str | None) -> list[str]:
    """Why a collection isn't complete enough to deactivate what it lacks; empty if it is."""
    checks = {"status": status == "COMPLETED", "pages_failed": failed == 0, "pages": requested is not None and requested == succeeded, "failed_pages": failed_pages == [], "next_page_url": next_url is None}
    return [k for k, ok in checks.items() if not ok]


def dedupe_payloads(pages: DataFrame, key: str, payload: str, updated: str, order: str) -> DataFrame:
    """The payload kept for each key: the newer by update text; equal or missing texts give way to the later arrival.

    With a missing text, what came before it no longer counts, so the rule is a fold in the order of arrival: the last arrival
    without a text restarts it, and among later ones the greatest text, then the latest arrival, wins (an arrival directly after
    a missing text always replaces it)."""
    e = F.nullif(F.col(updated), F.lit(""))
    restart = pages.groupBy(key).agg(F.max(F.when(e.isNull(), F.col(order))).alias("__restart"))
    j = pages.join(restart, key).withColumn("__u", e).filter(F.col("__restart").isNull() | (F.col(order) >= F.col("__restart")))
    return j.groupBy(key).agg(F.max_by(payload, F.struct(F.coalesce("__u", F.lit("")), F.col(order))).alias(payload), F.count("*").alias("versions"))


def classify_repeats(rows: DataFrame, key: str, payload: str, stripped: str, order: str) -> DataFrame:
    """How every later payload of a key differs from its first: identical, context_only (equal once stripped) or business."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(order, payload, stripped), F.col(order)).alias("f"))
    j = rows.join(first, key).filter(F.col(order) > F.col(f"f.{order}"))
    kind = F.when(F.col(payload).eqNullSafe(F.col(f"f.{payload}")), "identical").when(F.col(stripped).eqNullSafe(F.col(f"f.{stripped}")), "context_only").otherwise("business")
    return j.select(key, order, kind.alias("difference"))

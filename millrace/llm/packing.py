"""Packing token ids into fixed windows: best-fit decreasing with a segment tree.

Documents are tokenised with a public tokenizer and end with its end id. Ids longer than a window are cut into whole windows and
a rest, so nothing is lost. Documents are dealt to groups by a hash of their id and ids, so that a repeated or null id spreads; a
group holds about `group_tokens` ids whatever the corpus, and one task packs one group: pieces in descending length go to the open window with the least room that still holds
them, found in a segment tree over the windows' room. A packed window is a row of ids (padded), the cumulative lengths of its
segments, positions that start again at 0 with each segment, and each segment's document and offset. The rows of ids, positions
and cumulative lengths are arrays (pack) or little-endian 32-bit binary (pack_binary), so that the files are the matrices.

Defined results: a null text is empty: the end id alone; a very long text is tokenised whole and fills windows of its own, its ids
in one group; pieces of equal length keep the order of id, length and ids; rows that share an id are packed one by one; an empty
table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices


class Rooms:
    """A segment tree over room values 0..window: which value is the least with an open window that has at least so much room."""

    def __init__(self, window: int):
        self.leaves = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, window: int) -> None:
        if room:
            self.open[room].append(window)
            self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (window, room) with the least room >= need."""
        i = self.leaves + need
        if not self.count[i]:
            while i > 1 and not (i % 2 == 0 and self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, window: int) -> np.ndarray:
    """The window of each piece; pieces have 1 to `window` ids. Ties in length keep the given order."""
    rooms, where, opened = Rooms(window), np.zeros(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = rooms.take(n)
        if found is None:
            found, opened = (opened, window), opened + 1
        where[i] = found[0]
        rooms.put(found[1] - n, found[0])
    return where


def cut_long(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, offset, length) of the pieces: whole windows, then the rest."""
    pieces = np.maximum(1, -(-lengths // window))
    doc = np.repeat(np.arange(len(lengths)), pieces)
    offset = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
    return doc, offset, np.minimum(window, lengths[doc] - offset)


@lru_cache(2)
def _tokenizer(name: str, pattern: str):
    import tiktoken

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_ids(docs: DataFrame, vocabulary: str, pattern: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens and the ids as little-endian 16-bit values (32-bit if the end id needs them)."""
    context = docs.sparkSession.sparkContext
    name = os.path.basename(vocabulary)
    if not any(str(f).endswith("/" + name) for f in context.listFiles):
        context.addFile(vocabulary)
    kind = np.uint16 if end_id < 1 << 16 else np.uint32

    def make():
        tokenizer = _tokenizer(name, pattern)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [np.append(tokenizer.encode_to_numpy(t or "", disallowed_special=()).astype(kind), kind(end_id)) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], ["id", "n_tokens", "ids"])

        return part

    return map_slices(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), make, f"id {docs.schema[key].dataType.simpleString()}, n_tokens long, ids binary", "text")


def grouped_tokens(tokens: DataFrame, groups: int):
    return tokens.withColumn("grp", F.pmod(F.xxhash64("id", "ids"), F.lit(groups)).cast("int")).groupBy("grp")


def _pack_group(t: pa.Table, window: int, pad_id: int, kind) -> dict:
    """A group's windows: matrices of ids and positions, and flat lists of segments with each window's bounds in them."""
    t = t.sort_by([("id", "ascending"), ("n_tokens", "ascending"), ("ids", "ascending")])
    lengths = t.column("n_tokens").to_numpy().astype(np.int64)
    flat = np.frombuffer(b"".join(t.column("ids").to_pylist()), kind)
    doc, offset, length = cut_long(lengths, window)
    where = best_fit_decreasing(length, window)
    order = np.lexsort((offset, doc, where))
    doc, offset, length, where = doc[order], offset[order], length[order], where[order]
    source = (np.cumsum(lengths) - lengths)[doc] + offset
    first = np.concatenate(([0], np.flatnonzero(np.diff(where)) + 1))  # of each window, among the segments
    before = np.cumsum(length) - length
    start = before - np.repeat(before[first], np.diff(np.append(first, len(where))))
    inside = np.arange(length.sum()) - np.repeat(before, length)
    at = np.repeat(where * window + start, length) + inside
    ids, positions = (np.full(len(first) * window, x, np.int32) for x in (pad_id, 0))
    ids[at] = flat[np.repeat(source, length) + inside]
    positions[at] = inside
    bounds = np.append(first, len(where)).astype(np.int32)
    cu = np.insert(start + length, first, 0).astype(np.int32)
    return {
        "grp": pa.array(np.full(len(first), t.column("grp")[0].as_py(), np.int32)), "pack": pa.array(where[first]), "n_tokens": pa.array(np.add.reduceat(length, first)),
        "ids": ids.reshape(-1, window), "position_ids": positions.reshape(-1, window), "cu_seqlens": pa.ListArray.from_arrays(pa.array(bounds + np.arange(len(bounds), dtype=np.int32)), pa.array(cu)),
        "doc_ids": pa.ListArray.from_arrays(pa.array(bounds), t.column("id").combine_chunks().take(pa.array(doc))), "offsets": pa.ListArray.from_arrays(pa.array(bounds), pa.array(offset)),
    }


_SEGMENTS = ("grp", "pack", "n_tokens", "cu_seqlens", "doc_ids", "offsets")


def _segments_ddl(tokens: DataFrame) -> str:
    return f"grp int, pack long, n_tokens long, cu_seqlens array<int>, doc_ids array<{tokens.schema['id'].dataType.simpleString()}>, offsets array<long>"


def pack(tokens: DataFrame, groups: int, window: int, pad_id: int, wide: bool) -> DataFrame:
    """Rows of token_ids to windows: grp, pack, n_tokens, cu_seqlens, doc_ids, offsets, ids, position_ids."""
    kind = np.uint32 if wide else np.uint16

    def one(t: pa.Table) -> pa.Table:
        p = _pack_group(t, window, pad_id, kind)
        n = len(p["ids"])
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * window), pa.array(p[c].reshape(-1))) for c in ("ids", "position_ids")]
        return pa.table([p[c] for c in _SEGMENTS] + lists, [*_SEGMENTS, "ids", "position_ids"])

    return grouped_tokens(tokens, groups).applyInArrow(one, _segments_ddl(tokens) + ", ids array<int>, position_ids array<int>")


def _binary(rows: np.ndarray) -> pa.Array:
    """A matrix' rows as little-endian 32-bit values."""
    return pa.array([row.tobytes() for row in rows.astype("<i4")], pa.binary())


def pack_binary(tokens: DataFrame, groups: int, window: int, pad_id: int, wide: bool) -> DataFrame:
    """As pack, with ids, position_ids and cu_seqlens in binary: a row of the id matrix and of the positions, and the bounds."""
    kind = np.uint32 if wide else np.uint16

    def one(t: pa.Table) -> pa.Table:
        p = _pack_group(t, window, pad_id, kind)
        bounds = pa.array([np.asarray(x, "<i4").tobytes() for x in np.split(p["cu_seqlens"].values.to_numpy(), p["cu_seqlens"].offsets.to_numpy()[1:-1])], pa.binary())
        cols = {**{c: p[c] for c in _SEGMENTS}, "cu_seqlens": bounds, "ids": _binary(p["ids"]), "position_ids": _binary(p["position_ids"])}
        return pa.table(list(cols.values()), list(cols))

    return grouped_tokens(tokens, groups).applyInArrow(one, _segments_ddl(tokens).replace("cu_seqlens array<int>", "cu_seqlens binary") + ", ids binary, position_ids binary")


def pack_digests(tokens: DataFrame, groups: int, window: int, pad_id: int, wide: bool) -> DataFrame:
    """As pack, with the SHA-256 of each window's ids and positions (little-endian 32-bit) in the matrices' place."""
    kind = np.uint32 if wide else np.uint16

    def one(t: pa.Table) -> pa.Table:
        p = _pack_group(t, window, pad_id, kind)
        digests = [pa.array([hashlib.sha256(row.astype("<i4").tobytes()).hexdigest() for row in p[c]]) for c in ("ids", "position_ids")]
        return pa.table([p[c] for c in _SEGMENTS] + digests, [*_SEGMENTS, "ids_sha256", "positions_sha256"])

    return grouped_tokens(tokens, groups).applyInArrow(one, _segments_ddl(tokens) + ", ids_sha256 string, positions_sha256 string")


def packed_documents(docs: DataFrame, vocabulary: str, pattern: str, end_id: int, key: str = "doc_id", text: str = "text", window: int = 2048, group_tokens: int = 1_000_000, how=pack) -> DataFrame:
    """Packed windows of whole texts (how: pack, pack_binary or pack_digests). Groups follow the corpus' characters, about three to a
    token."""
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    groups = max(1, -(-chars // (3 * group_tokens)))
    return how(token_ids(docs, vocabulary, pattern, end_id, key, text), groups, window, end_id, end_id >= 1 << 16)


def write_binary(packed: DataFrame, path: str) -> None:
    """Packed windows (of pack) as binary columns: little-endian int32 matrices, a row a window, in Parquet files under `path`."""

    def run(batches):
        for b in batches:
            raw = [pa.array([np.asarray(x, "<i4").tobytes() for x in b.column(c).to_pylist()], pa.binary()) for c in ("ids", "cu_seqlens", "position_ids")]
            yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("pack"), b.column("n_tokens"), *raw], ["grp", "pack", "n_tokens", "ids", "cu_seqlens", "position_ids"])

    packed.mapInArrow(run, "grp int, pack long, n_tokens long, ids binary, cu_seqlens binary, position_ids binary").write.mode("errorifexists").parquet(path)

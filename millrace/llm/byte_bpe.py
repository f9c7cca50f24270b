"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

Texts are cut into chunks where a rolling hash of their last 32 bytes says so, wherever in a word that falls, so a passage that
several documents share gives the same chunks in each. Chunks that occur more than once in the table are encoded once: counted by
digest, their texts meet by digest and their ids go back to every document that holds them. A document is then put together from
the ids of shared chunks and of the stretches between them. Joins are repaired: the last pretoken before a join and some text
behind it are encoded again, and more of it until the pretokens found agree with those that the right side began by itself; from
there on both scans are the same. So the ids are those of the whole text, which the library gives.

No task needs all shared digests: a Bloom filter of at most ``most_bits`` bits tells which documents may hold a shared chunk. Others
are encoded where they are read, in the same way but without a join to anything. What the filter takes for shared in error has no
ids to join and is encoded with its document; a full filter costs shuffles, never rows.

Pretokens are found by the vocabulary's fixed pattern; the classes of its characters are asked of the library itself, for the
common scripts at the start and for others when they are met. A pretoken's ids are asked of the library once and remembered up to
a bound. Decoding joins the bytes of the ids' tokens.

Defined results: a null text is empty; an empty one has no ids and decodes to the empty text; texts of the vocabulary's special
tokens are those tokens, as in the library; a very long text is put together from stretches of at most STRETCH bytes, so that its
ids are the largest thing in memory besides itself; repeated rows get equal results; an empty table gives an empty table; extra
columns are ignored; key may be of any type and null.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import GEAR
from .common import Bloom, map_slices, slices, table

#: Least and greatest bytes of a chunk; beyond the least, one place in 1024 is a boundary.
LEAST, MOST, MASK = 256, 8192, np.uint32(0xFFC00000)
#: Bytes of a stretch that is encoded at once.
STRETCH = 1 << 18
#: Ranges of characters whose classes are asked for at the start: Latin, Greek, Cyrillic; punctuation.
_COMMON = (range(0x0, 0x530), range(0x1E00, 0x20D0))
#: Beginnings of 'll, 're and 've.
_CUT_SHORT = {"'l", "'r", "'v"}
_STAND_INS = {"L": "a", "N": "1", "S": "\n", "O": "!"}


def _gear(data: np.ndarray, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """Places (ends of chunks) where the hash of the 32 bytes before has zeros at MASK, block by block."""
    for start in range(0, len(data), block):
        lead = min(start, 31)
        h = GEAR[data[start - lead : start + block]]
        for step in (1, 2, 4, 8, 16):
            if len(h) > step:
                wider = h.copy()
                wider[step:] += h[:-step] << np.uint32(step)
                h = wider
        yield np.flatnonzero((h[lead:] & MASK) == 0) + start + 1


def chunk_ends(segments: list[bytes]) -> list[list[int]]:
    """Where each segment's chunks end. The hash runs over all segments at once: no boundary depends on a byte before its chunk."""
    data = np.frombuffer(b"".join(segments), np.uint8)
    hits = np.concatenate([*_gear(data), np.empty(0, np.int64)])
    out, base = [], 0
    for s in segments:
        ends, start, n = [], 0, len(s)
        for p in (hits[np.searchsorted(hits, base + LEAST) : np.searchsorted(hits, base + n)] - base).tolist() + [n]:
            while p - start > MOST:  # no boundary in reach
                start = _char_start(s, start + MOST)
                ends.append(start)
            if p - start >= LEAST:
                start = _char_start(s, p)
                ends.append(start)
        if n and (not ends or ends[-1] < n):
            ends.append(n)
        out.append(ends)
        base += n
    return out


def _char_start(s: bytes, p: int) -> int:
    """The first place from p on that begins a character."""
    while p < len(s) and s[p] & 0xC0 == 0x80:
        p += 1
    return p


def _open_words(words: list[str]) -> int:
    """How many of the last pretokens may change with what follows: the last, and an apostrophe before the first of two letters
    that it may take along."""
    return 2 if "".join(words[-2:]) in _CUT_SHORT and len(words) > 1 else 1


def _byte_chars() -> dict[int, str]:
    """The vocabulary's character for each byte: printable ones of Latin-1 stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Classes(dict):
    """For str.translate: characters as they are in the common ranges, stand-ins of the same class elsewhere."""

    def __init__(self, kind):
        self.kind = kind

    def __missing__(self, c: int) -> int | str:
        self[c] = c if any(c in r for r in _COMMON) else _STAND_INS[self.kind(chr(c))]
        return self[c]


class Encoder:
    """Encodes with a tokenizer file of byte-level BPE."""

    def __init__(self, model: str, bound: int = 400_000):
        from tokenizers import Tokenizer

        told = json.loads(model)
        pre = told["pre_tokenizer"] or {}
        if told["model"]["type"] != "BPE" or told["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("not a byte-level BPE tokenizer without normalizer and prefix space")
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in told["added_tokens"]):
            raise ValueError("special tokens that take their surroundings are not supported")
        told["truncation"] = told["padding"] = None
        self.library = Tokenizer.from_str(json.dumps(told))
        self.special = {a["content"]: a["id"] for a in told["added_tokens"]}
        self.split = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")
        back = {c: b for b, c in _byte_chars().items()}
        size = max([*told["model"]["vocab"].values(), *self.special.values()]) + 1
        self.raw = [b""] * size
        for token, i in told["model"]["vocab"].items():
            self.raw[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.raw[i] = token.encode()
        kinds: dict[str, list[str]] = {"L": [], "N": [], "S": [], "O": []}
        for r in _COMMON:
            for c in r:
                kinds[self._kind(chr(c))].append(f"\\U{c:08x}")
        letters, numbers, spaces = ("".join(kinds[k]) for k in "LNS")
        # the fixed pattern of this family of vocabularies
        self.pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+|[{spaces}]+(?![^{spaces}])|[{spaces}]+")
        self.rare = re.compile(f"[^{''.join(f'\\U{r.start:08x}-\\U{r.stop - 1:08x}' for r in _COMMON)}]")
        self.classes = _Classes(self._kind)
        self.bound, self.known = bound, {}

    def _kind(self, c: str) -> str:
        """L(etter), N(umber), S(pace) or O(ther), as the library sees it."""
        parts = lambda s: len(self.library.pre_tokenizer.pre_tokenize_str(s))
        if parts(f"a{c}") == 1:
            return "L"
        if parts(f"1{c}") == 1:
            return "N"
        return "O" if parts(f"!{c}") == 1 else "S"

    def pretokens(self, text: str) -> list[str]:
        if self.rare.search(text) is None:
            return self.pattern.findall(text)
        return [text[slice(*m.span())] for m in self.pattern.finditer(text.translate(self.classes))]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each pretoken, as little-endian 32-bit integers. New ones are asked together, as the words of one text: batches
        would start the library's threads for a few words."""
        known = self.known
        try:
            return list(map(known.__getitem__, words))
        except KeyError:
            pass
        new = list(set(words).difference(known))
        for i in range(0, len(new), 2000):
            part = new[i : i + 2000]
            e = self.library.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, ends = np.array(e.ids, "<u4").tobytes(), np.searchsorted(np.array(e.word_ids), np.arange(len(part) + 1)) * 4
            known.update((w, ids[x:y]) for w, x, y in zip(part, ends.tolist(), ends[1:].tolist()))
        out = list(map(known.__getitem__, words))
        if len(known) > self.bound:
            known.clear()
        for w in new:
            if len(w) > 64:
                known.pop(w, None)
        return out

    def piece(self, text: str) -> tuple[bytes, int, int]:
        """Ids of a stretch by itself, and of its end that may change the characters and the bytes of ids."""
        words = self.pretokens(text)
        ids = self._ids(words)
        n = _open_words(words)
        return b"".join(ids), sum(map(len, words[-n:])), sum(map(len, ids[-n:]))

    def joined(self, pieces: Iterator[tuple[str, tuple[bytes, int, int] | None]]) -> list[bytes]:
        """Ids of texts that follow each other, some of them already encoded by themselves."""
        out: list[bytes] = []
        tail, tail_ids = "", b""  # what may change so far; its ids aren't in out yet
        for text, code in pieces:
            ids, chars, n = code or self.piece(text)
            if not tail:
                out.append(ids[: len(ids) - n])
                tail, tail_ids = text[len(text) - chars :], ids[len(ids) - n :]
                continue
            width = 48
            while True:
                end = min(len(text), width)
                end += end < len(text) and text[end - 2 : end] in _CUT_SHORT
                right, window = self.pretokens(text[:end]), self.pretokens(tail + text[:end])
                begins, at, skip = {}, 0, 0
                for w, x in zip(right, self._ids(right)):
                    begins[at] = skip
                    at, skip = at + len(w), skip + len(x)
                at, agreed = -len(tail), None
                for i, w in enumerate(window):
                    if at in begins:
                        agreed = i
                        break
                    at += len(w)
                if agreed is not None or end == len(text):
                    break
                width *= 4
            if agreed is None:
                found = self._ids(window)
                n = _open_words(window)
                out += found[:-n]
                tail, tail_ids = "".join(window[-n:]), b"".join(found[-n:])
            else:
                out += self._ids(window[:agreed])
                rest = max(begins[at], len(ids) - n)
                out.append(ids[begins[at] : rest])
                tail, tail_ids = text[max(at, len(text) - chars) :], ids[rest:]
        return [*out, tail_ids]

    def segments(self, text: str) -> list[tuple[str, bytes]]:
        """The text between special tokens, each with the id of the token behind it."""
        out, at = [], 0
        for m in self.split.finditer(text):
            out.append((text[at : m.start()], np.array([self.special[m[0]]], "<u4").tobytes()))
            at = m.end()
        return [*out, (text[at:], b"")]

    def encode(self, text: str, codes: dict[bytes, tuple[bytes, int, int]] | None = None) -> bytes:
        """Ids of a whole text; codes: shared chunks by digest."""
        if not codes and len(text) <= STRETCH and self.split.search(text) is None:
            return b"".join(self._ids(self.pretokens(text)))
        out: list[bytes] = []
        for segment, special in self.segments(text):
            out += self.joined(self._stretches(segment, codes or {}))
            out.append(special)
        return b"".join(out)

    def _stretches(self, segment: str, codes: dict) -> Iterator[tuple[str, tuple[bytes, int, int] | None]]:
        data = segment.encode("utf-8", "surrogatepass")
        start = open_ = 0
        plain = lambda a, b: data[a:b].decode("utf-8", "surrogatepass")
        for end in chunk_ends([data])[0]:
            code = codes.get(xxhash.xxh3_128_digest(data[start:end])) if codes else None
            if code is not None:
                if open_ < start:
                    yield plain(open_, start), None
                yield plain(start, end), code
                open_ = end
            elif end - open_ > STRETCH:
                yield plain(open_, end), None
                open_ = end
            start = end
        if open_ < start:
            yield plain(open_, start), None

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def _encoder(name: str) -> Encoder:
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return Encoder(f.read())


@lru_cache(2)
def _splitter(name: str) -> re.Pattern:
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return re.compile("|".join(re.escape(a["content"]) for a in json.load(f)["added_tokens"]) or "(?!)")


def _digests(texts: list[str | None], split: re.Pattern) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Digest (high, low) of every chunk, the text it belongs to, and the chunks."""
    segments, owner = [], []
    for i, t in enumerate(texts):
        for s in split.split(t) if t else ():
            if s:
                segments.append(s.encode("utf-8", "surrogatepass"))
                owner.append(i)
    chunks, of = [], []
    for s, i, ends in zip(segments, owner, chunk_ends(segments)):
        start = 0
        for end in ends:
            chunks.append(s[start:end])
            of.append(i)
            start = end
    found = np.frombuffer(b"".join([xxhash.xxh3_128_digest(c) for c in chunks]), ">u8").astype(np.uint64).reshape(-1, 2)
    return found, np.array(of, np.int64), chunks


def _as_rows(found: np.ndarray, names: list[str], *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0].view(np.int64)), pa.array(found[:, 1].view(np.int64)), *columns], ["high", "low", *names])


def ship(docs: DataFrame, model: str) -> str:
    """Send the tokenizer file to the executors; its name there."""
    name, context = os.path.basename(model), docs.sparkSession.sparkContext
    if not any(str(f).endswith("/" + name) for f in context.listFiles):
        context.addFile(model)
    return name


def shared_chunks(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """(high, low, n): digests of chunks that occur more than once in the table."""

    def make():
        split = _splitter(name)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _digests(batch.column(0).to_pylist(), split)[0]
            return _as_rows(np.ascontiguousarray(found), [])

        return part

    return map_slices(docs.select(F.col(text).alias("text")), make, "high long, low long").groupBy("high", "low").agg(F.count("*").alias("n")).filter("n > 1")


def chunk_codes(docs: DataFrame, shared: DataFrame, bloom, name: str, text: str = "text") -> DataFrame:
    """(high, low, ids, chars, n_ids): each shared chunk encoded by itself, once."""

    def make():
        split = _splitter(name)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, _, chunks = _digests(batch.column(0).to_pylist(), split)
            at = np.flatnonzero(bloom.value(found))
            at = at[np.unique(found[at], axis=0, return_index=True)[1]] if len(at) else at  # once a slice
            return _as_rows(np.ascontiguousarray(found[at]), ["chunk"], pa.array([chunks[i] for i in at.tolist()], pa.binary()))

        return part

    texts = map_slices(docs.select(F.col(text).alias("text")), make, "high long, low long, chunk binary")
    # the hint keeps the plan the same at every size
    once = texts.groupBy("high", "low").agg(F.min("chunk").alias("chunk")).join(shared.select("high", "low").hint("merge"), ["high", "low"], "left_semi")

    def encode():
        e = _encoder(name)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            codes = [e.piece(c.decode("utf-8", "surrogatepass")) for c in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c[0] for c in codes], pa.binary()), pa.array([c[1] for c in codes], pa.int32()), pa.array([c[2] for c in codes], pa.int32())], ["high", "low", "ids", "chars", "n_ids"])

        return part

    return map_slices(once, encode, "high long, low long, ids binary, chars int, n_ids int", "chunk")


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", most_bits: int = 1 << 27) -> DataFrame:
    """key, ids (little-endian unsigned 32-bit integers) and the text decoded from them, for every row of docs.

    model: path of the tokenizer file on the driver; most_bits: bits of the Bloom filter at most, a power of two."""
    name = ship(docs, model)
    kind = docs.schema[key].dataType.simpleString()
    shared = table(shared_chunks(docs, name, text))
    bloom = docs.sparkSession.sparkContext.broadcast(Bloom.of(shared, most_bits))
    codes = table(chunk_codes(docs, shared, bloom, name, text))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def holds(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each text may hold a shared chunk; digests of such chunks and their texts."""
        found, of, _ = _digests(batch.column(1).to_pylist(), _splitter(name))
        hit = bloom.value(found) if len(found) else np.empty(0, bool)
        held = np.zeros(batch.num_rows, bool)
        held[of[hit]] = True
        return held, found[hit], of[hit]

    def result(keys: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
        e = _encoder(name)
        return pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.large_binary()).cast(pa.binary()), pa.array([e.decode(x) for x in ids], pa.string())], ["key", "ids", "decoded"])

    def alone():
        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            free = batch.filter(pa.array(~holds(batch)[0]))
            e = _encoder(name)
            return result(free.column(0), [e.encode(t or "") for t in free.column(1).to_pylist()])

        return part

    def keep():
        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            held, found, of = holds(batch)
            at = np.flatnonzero(held).tolist()
            mine: dict[int, set[tuple[int, int]]] = {i: set() for i in at}
            for i, pair in zip(of.tolist(), found.view(np.int64).tolist()):
                mine[i].add(tuple(pair))
            wanted = pa.array([[{"high": h, "low": low} for h, low in mine[i]] for i in at], pa.list_(pa.struct([("high", pa.int64()), ("low", pa.int64())])))
            some = batch.filter(pa.array(held))
            return pa.RecordBatch.from_arrays([some.column(0), some.column(1), wanted], ["key", "text", "wanted"])

        return part

    free = map_slices(rows, alone, f"key {kind}, ids binary, decoded string")
    held = table(map_slices(rows, keep, f"key {kind}, text string, wanted array<struct<high:long,low:long>>").withColumn("row", F.monotonically_increasing_id()))
    wanted = held.select("row", F.explode("wanted").alias("x")).select("row", "x.*")
    given = wanted.join(codes.hint("merge"), ["high", "low"]).groupBy("row").agg(F.collect_list(F.struct("high", "low", "ids", "chars", "n_ids")).alias("codes"))

    def together(batches):
        e = _encoder(name)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids = []
                for t, codes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    digest = lambda c: np.array([c["high"], c["low"]], np.int64).astype(">i8").tobytes()
                    ids.append(e.encode(t, {digest(c): (c["ids"], c["chars"], c["n_ids"]) for c in codes or ()}))
                yield result(batch.column(0), ids)

    joined = held.select("row", "key", "text").join(given.hint("merge"), "row", "left").select("key", "text", "codes")
    return free.unionByName(joined.mapInArrow(together, f"key {kind}, ids binary, decoded string")).withColumnRenamed("key", key)


def encode_report(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens and SHA-256 of the ids and of the decoded text."""
    e = encode(docs, model, key, text)
    return e.select(key, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file gives pieces and scores. Texts are normalised as the model asks, cut where no piece can cross, and each distinct
stretch ("word") is encoded once in a slice: the symbols of all words lie in one flat array, a round finds every word's pair of
least rank, merges its leftmost non-overlapping places at once and compacts the array, until no pair is left. Where a merged
piece could take part in a better merge at once, a round merges the leftmost place alone, which is the order of the library's
queue. Characters without a piece become byte pieces.

Defined results: a null text is empty; an empty text has the end id alone (if asked for) and decodes to the empty text; a very
long text is a slice of its own, encoded whole; of pairs of equal rank the leftmost merges first; repeated rows get equal results; an empty table gives an empty table; extra columns are ignored by ``encode_digests``.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import map_slices

SPACE = "▁"
NONE = np.int64(1) << 40


class Encoder:
    """Encodes with a model's vocabulary; the library itself is asked for pieces, scores and the normalised text alone."""

    def __init__(self, model: bytes, bound: int = 250_000):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.sp, self.bound = sp, bound
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        kind = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        self.vocab = {p: i for i, p in enumerate(pieces) if not kind[i]}
        self.byte_ids = np.zeros(256, np.int64)
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
        self.eos = sp.eos_id()
        scores = np.array([sp.get_score(i) for i in range(size)])
        order = -scores
        ranks = np.unique(order, return_inverse=True)[1].astype(np.int64)
        # symbols: ids of the vocabulary, then characters without a piece
        left, right, made = [], [], []
        best_with = np.full(size, NONE, np.int64)
        for p, i in self.vocab.items():
            for k in range(1, len(p)):
                a, b = self.vocab.get(p[:k]), self.vocab.get(p[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
                    best_with[a], best_with[b] = min(best_with[a], ranks[i]), min(best_with[b], ranks[i])
        key = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        at = np.argsort(key)
        self.keys, self.made = key[at], np.array(made, np.int64)[at]
        self.ranks = ranks
        self.alone = best_with <= ranks  # merge these one place at a time
        # a stretch may be cut before a space sign that follows another character, and around characters in no longer piece
        assert not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.vocab), "a piece has a space inside"
        joined = {c for p in self.vocab if len(p) > 1 for c in p}
        self.single = {c for c in "\n\t\r" if c not in joined}
        breaks = "".join(re.escape(c) for c in sorted(self.single)) or "\x00"
        self.cut = re.compile(f"[{breaks}]+|{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+")
        self.raw = [b""] * size
        for p, i in self.vocab.items():
            self.raw[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.raw[int(i)] = bytes([b])
        self.known: dict[str, tuple[str, int, bytes]] = {}
        probe = "a  b ﬁ\n c"
        self.plain = sp.normalize(probe) == SPACE + probe.replace(" ", SPACE) and sp.normalize("") == ""

    def normalized(self, text: str) -> str:
        if not text:
            return ""
        return SPACE + text.replace(" ", SPACE) if self.plain else self.sp.normalize(text)

    def _pair_ranks(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pair that starts at each symbol; NONE where there is no such piece."""
        rank, product = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            ok = np.flatnonzero((word[1:] == word[:-1]) & (sym[1:] >= 0) & (sym[:-1] >= 0))
            key = sym[ok] << 20 | sym[ok + 1]
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[i] == key
            ok, i = ok[hit], i[hit]
            product[ok] = self.made[i]
            rank[ok] = self.ranks[self.made[i]]
        return rank, product

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each distinct word, all words together."""
        chars = "".join(words)
        once = {c: self.vocab.get(c) for c in set(chars)}
        odd = [c for c, i in once.items() if i is None]
        for k, c in enumerate(odd):
            once[c] = -1 - k
        sym = np.fromiter(map(once.__getitem__, chars), np.int64, len(chars))
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        done_sym, done_word, done_place = [], [], []
        place = np.arange(len(sym))
        rank, product = self._pair_ranks(sym, word)
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            live = np.repeat(least < NONE, sizes)
            if not live.all():  # words without a pair are ready
                done_sym.append(sym[~live]), done_word.append(word[~live]), done_place.append(place[~live])
                sym, word, place, rank, product = sym[live], word[live], place[live], rank[live], product[live]
                keep = least < NONE
                least, sizes = least[keep], sizes[keep]
                if not len(sym):
                    break
            target = np.repeat(least, sizes)
            hits = np.flatnonzero(rank == target)
            # the leftmost of places that overlap, then every second one
            new = np.concatenate(([True], hits[1:] != hits[:-1] + 1))
            run = np.maximum.accumulate(np.where(new, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            first = np.concatenate(([True], word[hits[1:]] != word[hits[:-1]]))
            hits = hits[first | ~self._alone_in_word(hits, product, word)]
            sym[hits] = product[hits]
            keep = np.ones(len(sym), bool)
            keep[hits + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[hits] = True
            touched[np.maximum(hits - 1, 0)] = True
            sym, word, place, rank, product, touched = (x[keep] for x in (sym, word, place, rank, product, touched))
            self._refresh(sym, word, rank, product, touched)
        s, w, p = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_sym, done_word, done_place))
        order = np.argsort(p)
        s, w = s[order], w[order]
        if odd and (s < 0).any():
            spelled = [self.byte_ids[np.frombuffer(c.encode("utf-8", "surrogatepass"), np.uint8)] for c in odd]
            width = np.ones(len(s), np.int64)
            width[s < 0] = np.array([len(x) for x in spelled])[-1 - s[s < 0]]
            out = np.repeat(s, width)
            out[out < 0] = np.concatenate([spelled[-1 - x] for x in s[s < 0].tolist()])
            s, w = out, np.repeat(w, width)
        ends = np.searchsorted(w, np.arange(len(words)), side="right").tolist()
        ids = s.tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _alone_in_word(self, hits: np.ndarray, product: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Whether a place's word has to merge one place in this round: one of its products could merge on at once."""
        w = word[hits]
        starts = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        any_alone = np.logical_or.reduceat(self.alone[product[hits]], starts)
        return np.repeat(any_alone, np.diff(np.append(starts, len(hits))))

    def _refresh(self, sym, word, rank, product, touched) -> None:
        """Ranks of the pairs that begin at the symbols touched by a round."""
        at = np.flatnonzero(touched)
        rank[at], product[at] = NONE, 0
        ok = at[at < len(sym) - 1]
        ok = ok[(word[ok + 1] == word[ok]) & (sym[ok] >= 0) & (sym[ok + 1] >= 0)]
        key = sym[ok] << 20 | sym[ok + 1]
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[i] == key
        ok, i = ok[hit], i[hit]
        product[ok] = self.made[i]
        rank[ok] = self.ranks[self.made[i]]

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Each text's words, all of them known afterwards as (decimal ids, number of ids, decoded bytes)."""
        if len(self.known) > self.bound:
            self.known.clear()
        cut = [self.cut.findall(self.normalized(t)) for t in texts]
        new = list({w for words in cut for w in words if w not in self.known})
        for w, ids in zip(new, self.encode_words(new)):
            self.known[w] = (" ".join(map(str, ids)), len(ids), b"".join([self.raw[i] for i in ids]))
        return cut

    def encode(self, texts: list[str], end: bool = True) -> list[list[int]]:
        tail = [self.eos] if end else []
        return [[int(x) for w in words for x in self.known[w][0].split()] + tail for words in self.learn(texts)]

    def decoded(self, words: list[str]) -> str:
        """The text of the ids of these words: bytes of the pieces in turn, less the space that encoding put in front."""
        raw = b"".join([self.known[w][2] for w in words])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(2)
def _encoder(name: str) -> Encoder:
    with open(SparkFiles.get(name), "rb") as f:
        return Encoder(f.read())


def ship_model(docs: DataFrame, model: str) -> str:
    """Send the model file to the executors; its name there."""
    name = f"{os.path.basename(model)}"
    context = docs.sparkSession.sparkContext
    if not any(str(f).endswith("/" + name) for f in context.listFiles):
        context.addFile(model)
    return name


def encode_digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """Key, n_tokens, SHA-256 of the decimal ids joined by a space, SHA-256 of the decoded text."""
    name = ship_model(docs, model)

    def make():
        e = _encoder(name)
        tail = str(e.eos) if end else ""

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids, texts = [], [], []
            for words in e.learn([t or "" for t in batch.column(1).to_pylist()]):
                known = [e.known[w] for w in words]
                joined = " ".join([k[0] for k in known])
                joined = f"{joined} {tail}" if joined and tail else joined or tail
                n.append(sum([k[1] for k in known]) + bool(end))
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                texts.append(hashlib.sha256(e.decoded(words).encode()).hexdigest())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

        return part

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string", text, most_bytes=8 << 20)


def encode_ids(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """Key, ids (array of int) and the text decoded from them."""
    name = ship_model(docs, model)

    def make():
        e = _encoder(name)

        def part(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = e.encode(texts, end)
            back = [e.decoded(words) for words in e.learn(texts)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())], [key, "ids", "decoded"])

        return part

    return map_slices(docs.select(key, text), make, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>, decoded string", text)

"""Byte-level BPE with chunk reuse: the library's ids whatever chunks are coded, and the same over a table."""

import random

import numpy as np
import pytest
import xxhash

from millrace.llm import byte_bpe
from millrace.llm.queries import tokenizer_path

PIECES = ["a", "b", " ", "  ", "\n", "'s", "'", "'l", "l", "!", "1", "é", "x" * 50, " " * 70, "<|endoftext|>", "\U0001f600", "中", " ", "\U0001e900", "'ll", "?!'", "\t", "\U00031350", "՘", "0" * 40, "'" * 33, "\r\n"]


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    library = Tokenizer.from_str(model)
    return byte_bpe.Encoder(model), library, lambda t: np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def all_codes(e, text):
    out = {}
    for segment, _ in e.segments(text):
        data, start = segment.encode(), 0
        for end in byte_bpe.chunk_ends([data])[0]:
            out[xxhash.xxh3_128_digest(data[start:end])] = e.piece(data[start:end].decode())
            start = end
    return out


def test_joins_of_any_chunks_give_the_library_s_ids(both, monkeypatch):
    e, library, ids = both
    monkeypatch.setattr(byte_bpe, "LEAST", 33)
    monkeypatch.setattr(byte_bpe, "MOST", 120)
    monkeypatch.setattr(byte_bpe, "MASK", np.uint32(0xF0000000))
    monkeypatch.setattr(byte_bpe, "STRETCH", 200)
    rng = random.Random(4)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(60)))
        codes = {k: v for k, v in all_codes(e, text).items() if rng.random() < 0.7}
        assert e.encode(text, codes) == e.encode(text) == ids(text), text
        assert e.decode(ids(text)) == library.decode(library.encode(text, add_special_tokens=False).ids, skip_special_tokens=False) == text


def test_long_texts_in_stretches(both):
    e, _, ids = both
    for text in ("word " * 200_000, "x" * 600_000, " " * 300_000 + "a", "don't " * 100_000):
        assert e.encode(text) == ids(text)


def test_character_classes_are_the_library_s(both):
    """All characters of common scripts, and some of each other plane, in every neighbourhood of classes."""
    e, library, _ = both
    for c in [*range(0x0, 0x530), *range(0x1E00, 0x20D0), *range(0x530, 0x30000, 97)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)}!{chr(c)} "
            assert e.pretokens(text) == [text[slice(*at)] for _, at in library.pre_tokenizer.pre_tokenize_str(text)], hex(c)


def test_chunks_resist_shifts():
    text = " ".join(f"word{i * i}" for i in range(3000)).encode()
    cut = lambda s: [s[a:b] for a, b in zip([0, *byte_bpe.chunk_ends([s])[0]], byte_bpe.chunk_ends([s])[0])]
    a, b = cut(text), cut(b"something in front " + text)
    assert b"".join(a) == text and len(set(a) & set(b)) >= len(a) - 2


def test_table(both, spark):
    e, library, ids = both
    passage = " ".join(f"shared{i * 7919 % 1000}" for i in range(800))
    texts = [None, "", "short", passage, passage, f"Own start 1 {passage} and own end", f"another's {passage[300:]}", passage + "<|endoftext|>" + passage, "long " * 120_000, "中文 " * 400, "<|endoftext|>"]
    rows = [(i // 2 if i != 5 else None, t, "x", "y", "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, row string, codes string")
    for bits in (1 << 27, 64):  # a filter that takes everything for shared gives the same rows
        got = [(r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in byte_bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), most_bits=bits).collect()]
        assert sorted(got, key=str) == sorted([(r[0], ids(r[1] or ""), r[1] or "") for r in rows], key=str)
    assert byte_bpe.shared_chunks(docs, byte_bpe.ship(docs, tokenizer_path("byte_bpe_50k.json"))).count() > 5
    assert byte_bpe.encode(docs.limit(0), tokenizer_path("byte_bpe_50k.json")).collect() == []


def test_query_over_a_table(both, spark):
    import hashlib

    from millrace.llm.queries import QUERIES, documents

    _, _, ids = both
    d = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_byte_bpe"](spark, d).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark, d).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert got == {i: (len(ids(t)) // 4, sha(ids(t)), sha(t.encode())) for i, t in texts.items()}


def test_new_words_of_a_text_are_asked_in_one_call(both):
    """Before, each text's few new words went through a batch, which runs the library's threads."""
    e, library, ids = both
    asked = []

    class Counted:
        def __getattr__(self, name):
            asked.append(name)
            return getattr(library, name)

    text = "".join(random.Random(5).choice(PIECES) for _ in range(400)).replace("<|endoftext|>", "") + " neverseen" + "z" * 200
    e.known.clear()
    held, e.library = e.library, Counted()
    try:
        assert e.encode(text) == ids(text)
    finally:
        e.library = held
    assert asked.count("encode") == 1 and "encode_batch_fast" not in asked
    assert e.known and max(map(len, e.known)) <= 64

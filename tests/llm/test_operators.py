"""Each numbered operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns with clashing names."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import chunks, langid, license_scan, minhash, mixing, packing, pii, quality, sentencepiece_bpe, sharding
from millrace.llm.common import WORD, lower_ascii
from millrace.llm.queries import tokenizer_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, kept boolean, size int, row string, at string, range int, draw double, n_tokens string, key string, component string, grp int, hash string"
EXTRA = (7, True, 1, "x", "y", 3, 0.5, "z", "k", "c", 2, "h")


def prose(rng, n, words=None):
    words = words or ["the", "of", "and", "water", "light", "stone", "river", "over", "under", "quick", "brown", "fox", "jumps", "lazy", "dog", "café", "naïve", "straße"]
    return " ".join(rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows], COLUMNS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(600)]
    base = [prose(rng, rng.randint(60, 200), vocabulary) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    for i in range(30, 60):  # near copies and copies
        words = base[i % 10].split()
        for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", None if i % 7 == 0 else "s0"))
    rows += [
        (60, None, None, "s1"), (61, "", "en", "s1"), (62, "  \n\t ", "en", None), (63, "two words", "en", "s2"), (64, "Two WORDS", "en", "s2"), (65, "one", "fr", "s2"),
        (66, prose(rng, 30_000, vocabulary), "en", "s0"), (67, "x" * 50_000, "en", "s0"), (68, "日本語のテキスト 😀 \x00 end", "en", "s1"), (12, rows[12][1], "en", "s0"), (None, "a null id with some words", "en", "s1"),
        (69, "line one here\nline one here\nline one here\n" * 30, "en", "s1"), (70, "#### $$$$ |||| <<<< " * 40, "en", "s1"), (71, "SHOUTING LOUD WORDS " + " ".join(f"WORD{i}" for i in range(60)), "en", "s2"),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, texts)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_quality(docs, empty, texts):
    want = []
    for i, t, *_ in texts:
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        windows = list(zip(w, w[1:], w[2:]))
        often, flagged = Counter(windows), set()
        for k, x in enumerate(windows):
            if often[x] > 1:
                flagged |= {k, k + 1, k + 2}
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(flagged), len(w) < 50 or 100 * len(flagged) > 50 * len(w)))
    got = quality.quality_report(docs)
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
    kept = {r[0]: r[1] for r in got.select("doc_id", "kept").collect()}
    assert kept[0] and not any(kept[i] for i in (60, 61, 62, 69, 70, 71))
    assert quality.quality_report(empty).count() == 0
    few = quality.quality_filter(docs)
    assert few.columns == docs.columns and {r.doc_id for r in few.collect()} == {i for i, k in kept.items() if k}


def test_cascade_order_follows_rejections_per_cost_and_never_changes_verdicts(docs):
    seen = quality.estimate(docs, quality.RULES)
    assert {e["rule"] for e in seen} == {r.name for r in quality.RULES}
    cheap = [{"rule": "symbols", "seconds": 1e-6, "rejected": 10, "seen": 10}, {"rule": "capitals", "seconds": 1.0, "rejected": 10, "seen": 10}]
    assert [r.name for r in quality.cascade_order(cheap, quality.OWN_RULES)][:2] == ["symbols", "capitals"]
    for t in ("a " * 60, "#### " * 60, "fine words here " * 2):
        d = quality.Document(t)
        assert (quality.first_rejection(d, quality.RULES) is None) == (quality.first_rejection(d, quality.RULES[::-1]) is None)


def test_license_scan(spark, docs, empty):
    notice = license_scan.NOTICES[2].text
    rows = [
        (1, "before MIT License. after mit-license and Apache  License", None, None), (2, "gnu general public license gnu general", None, None), (3, "cc by 4.0 cc by", None, None), (4, notice, None, None),
        (5, "some words " + notice.replace("redistribute", "pass on").replace("terms of the", "terms in the") + " more", None, None), (6, "the license of the public general gnu", None, None), (7, None, None, None), (8, "Éapache license", None, None),
    ]
    got = {r.doc_id: r for r in license_scan.license_scan(frame(spark, rows)).collect()}
    for i, t, *_ in rows:
        words = license_scan.WORDS.findall(lower_ascii(t or ""))
        places = [(k, p.label) for p in license_scan.PHRASES for k in range(len(words)) if words[k : k + len(p.words)] == p.words]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted({x for _, x in places}))), i
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None)), i
    assert "gpl-notice" in got[4].labels and got[4].score == 1.0 and "gpl-notice" in got[5].labels
    assert got[6].labels == "" and got[6].score == 0.0
    assert license_scan.license_scan(docs).count() == docs.count() and license_scan.license_scan(empty).count() == 0


def test_language_id(spark, docs, empty):
    rng = random.Random(1)
    syllables = {"en": ["th", "ing", "er", "and", "wh"], "fr": ["eau", "oi", "qu", "é", "ent"], "de": ["sch", "ung", "ü", "ei", "ch"]}
    rows = [(i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(40)), lang, None) for i in range(240) for lang in [("en", "fr", "de")[i % 3]]]
    rows += [(900, None, "en", None), (901, "1234 !!", "en", None), (902, "", None, None), (903, rows[0][1], None, None)]
    got = {r.doc_id: r for r in langid.language_id(frame(spark, rows), train_docs=40).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902)) and got[903].lang_pred == "en"
    held = [(got[i].lang_pred, lang) for i, _, lang, _ in rows[:240] if got[i].held_out]
    assert len(held) > 20 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.language_id(docs).count() == docs.count() and langid.language_id(empty).count() == 0


def test_kneser_ney_probabilities_sum_to_one(spark):
    rows = [(i, t, "en", None) for i, t in enumerate(["banana band", "bandana and", "an ab ba"] * 4)]
    m = langid.train(frame(spark, rows), train_docs=9)
    table = langid._fold_table()
    seen = np.unique(np.concatenate([langid.symbols(t, table) for _, t, *_ in rows]))
    for context in (" b", "ana", "zz"):
        s = np.array([ord(c) for c in context], np.uint64)
        total = sum(float(np.exp(m._logp(np.append(s, c), np.array([len(s)]), len(s) + 1))[0, 0]) for c in seen)
        assert 0.8 < total <= 1.0 + 1e-6, context  # the rest is for symbols never seen


def packer(docs, how=packing.pack):
    import public_tokenizers as p

    return packing.packed_documents(docs, tokenizer_path("byte_bpe_50k.tiktoken"), p.PATTERN, 50256, window=256, group_tokens=20_000, how=how)


def test_packing_is_lossless(docs, empty, texts):
    import base64

    import public_tokenizers as p
    import tiktoken

    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        e = tiktoken.Encoding("t", pat_str=p.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    got, rows = {}, packer(docs).collect()
    for r in rows:
        assert len(r.ids) == 256 and r.cu_seqlens[-1] == r.n_tokens and set(r.ids[r.n_tokens :]) <= {50256}
        for k, (d, o) in enumerate(zip(r.doc_ids, r.offsets)):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert r.position_ids[a:b] == list(range(b - a))
            got.setdefault(d, []).append((o, r.ids[a:b]))
    want = {}
    for i, t, *_ in texts:
        want.setdefault(i, []).append(e.encode_ordinary(t or "") + [50256])
    for i, lists in want.items():
        assert sorted(x for _, part in got[i] for x in part) == sorted(x for ids in lists for x in ids), i
        if len(lists) == 1:
            assert sum((x for _, x in sorted(got[i])), []) == lists[0], i
    digests = {(r.grp, r.pack): r for r in packer(docs, packing.pack_digests).collect()}
    assert all(digests[r.grp, r.pack].ids_sha256 == hashlib.sha256(np.asarray(r.ids, "<i4").tobytes()).hexdigest() for r in rows)
    assert packer(empty).count() == 0


def test_write_binary(spark, docs, tmp_path):
    packing.write_binary(packer(docs), f"file://{tmp_path}/packs")
    back = spark.read.parquet(f"file://{tmp_path}/packs").collect()
    want = {(r.grp, r.pack): r for r in packer(docs).collect()}
    assert len(back) == len(want) and all(np.frombuffer(r.ids, "<i4").tolist() == want[r.grp, r.pack].ids for r in back)


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(2)
    for _ in range(30):
        window = rng.randint(5, 60)
        lengths = np.array([rng.randint(1, window) for _ in range(rng.randint(0, 80))], np.int64)
        rooms, want = [], np.zeros(len(lengths), np.int64)
        for i in np.argsort(-lengths, kind="stable"):
            fits = [(r, k) for k, r in enumerate(rooms) if r >= lengths[i]]
            if not fits:
                rooms.append(window)
                fits = [(window, len(rooms) - 1)]
            k = min(fits)[1]
            rooms[k] -= lengths[i]
        got = packing.best_fit_decreasing(lengths, window)
        used = np.bincount(got, lengths, len(rooms)) if len(lengths) else np.zeros(0)
        assert sorted(used) == sorted(window - r for r in rooms)


def test_sentencepiece_equals_the_library(docs, empty, texts):
    import sentencepiece

    model = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    want = []
    for i, t, *_ in texts:
        ids = sp.encode(t or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert rows_of(sentencepiece_bpe.encode_digests(docs, model), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    both = {r.doc_id: r for r in sentencepiece_bpe.encode_ids(docs, model).collect()}
    assert both[0].ids == sp.encode(texts[0][1], add_eos=True) and both[0].decoded == texts[0][1]
    assert sentencepiece_bpe.encode_digests(empty, model).count() == 0


def test_sentencepiece_on_random_strings():
    import sentencepiece

    model = tokenizer_path("piece_bpe_32k.model")
    e, sp = sentencepiece_bpe.Encoder(open(model, "rb").read()), sentencepiece.SentencePieceProcessor(model_file=model)
    rng = random.Random(3)
    parts = ["▁", " ", "  ", "\n", "a", "ab", "aaa", "é", "日本", "😀", "\t", "22", "the", "ing", "==", "----", "<s>", "ا", "ﬁ", "́", "http", "://", "er"]
    xs = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + ["", " ", "a" * 3000, " " * 77]
    got = e.encode(xs)
    assert got == sp.encode(xs, add_eos=True)
    assert [e.decoded(w) for w in e.learn(xs)] == [sp.decode(x) for x in got]


def brute_components(rows, k, percent):
    sets = []
    for i, t, *_ in rows:
        w = WORD.findall(lower_ascii(t or ""))
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr)


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_minhash(docs, empty, texts, k, percent):
    got = minhash.near_duplicates(docs, k, percent)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_components(texts, k, percent)
    assert minhash.near_duplicates(empty, k, percent).count() == 0


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])
def test_minhash_finds_links_that_the_pivots_miss(spark, monkeypatch, block):
    """Chains: neighbours are near, ends are not, and the bucket's least id is an end. Small blocks deal a bucket to many tasks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        rows.append((i * 3 + 1, " ".join(words), None, None))
        words = words[:]
        for _ in range(4):
            words[rng.randrange(300)] = f"n{rng.random()}"
    rng.shuffle(rows)
    got = minhash.near_duplicates(frame(spark, rows), 3, 85)
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows, 3, 85)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, 100).astype(np.uint64)])) for _ in range(2))
        errors.append((minhash.signature(a, 120) == minhash.signature(b, 120)).mean() - 0.6)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_components_of_a_long_chain(spark):
    from millrace.llm.components import components

    n = 200
    got = components(spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5000, 5000)], "a long, b long"))
    assert {(r.id, r.component) for r in got.collect()} == {(i, 0) for i in range(n + 1)} | {(1000, 1000), (1001, 1000)}


def test_keep_one(docs, texts):
    kept = {i for i, _, _, k in brute_components(texts, 5, 80) if k}
    got = minhash.keep_one(docs)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == kept


def test_pii(docs, empty, texts, spark):
    values = "mail a.b1@mail3.example.com card 4532015112830366 ip 84.27.175.186 tel +1 (017) 555-7713 token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" on 2024-02-29 iban DE89370400440532013000 ssn 123-45-6789"
    rows = [*texts, (200, values, "en", None), (201, "again " + values.upper(), "en", None), (202, "4532-0151-1283-0366 version 3.0 of 1984", "en", None)]
    d = frame(spark, rows)
    p = pii.Pseudonyms(pii.DEMO_KEY)
    got = {r.doc_id: r for r in pii.pii_report(d).collect()}
    for i, t, *_ in texts:
        assert got[i].text == p.text(t)[0]
        if t and not re.search("[0-9@=:]", t):
            assert got[i].text == t and got[i].n_values == 0
    new = got[200].text
    assert got[200].n_values == 8 and not any(x in new for x in re.findall(r"\S*\d\S*", values) if x != "+1")
    card = re.search(r"card (\d{16})", new)[1]
    assert pii.luhn(card) and card in got[202].text.replace("-", "") and "3.0 of 1984" in got[202].text
    assert re.search(r"mail (\S+)", new)[1].upper() in got[201].text and pii.iban(re.search(r"iban (\S+)", new)[1])
    back = pii.pseudonymize(pii.pseudonymize(d), undo=True)
    assert back.columns == d.columns and {(r.doc_id, r.text) for r in back.collect()} == {(i, t) for i, t, *_ in rows}
    assert pii.pii_report(empty).count() == 0


def test_pii_neighbours():
    p, back = pii.Pseudonyms(pii.DEMO_KEY), pii.Pseudonyms(pii.DEMO_KEY, undo=True)
    for value, after in [("AT61 1904 3002 3457 3201", " BIC"), ("BE68 5390 0754 7034", " AND"), ("ES91 2100 0418 4502 0005 1332", " IBAN"), ("GB29 NWBK 6016 1331 9268 19", " BIC CODE")]:
        alone = p.text(value)[0]
        assert alone != value and pii.iban(alone.replace(" ", ""))
        assert p.text(f"to {value}{after} now") == (f"to {alone}{after} now", ["iban"]) and back.text(f"{alone}{after}")[0] == value + after
    card = "4111 1111 1111 1111"
    alone = p.text(card)[0]
    assert alone != card and pii.luhn(alone.replace(" ", "")) and p.text(card.replace(" ", ""))[0] == alone.replace(" ", "")
    for before, after in [("ID12 ", ""), ("", " 12/26"), ("2024 ", ""), ("", " 123"), ("", " 2024"), ("CVV 123 ", " 12/26"), ("12/26 ", ""), ("", " 4")]:
        assert p.text(before + card + after) == (before + alone + after, ["card"]), (before, after)
        assert back.text(before + alone + after)[0] == before + card + after
    phone = p.text("+1 212 555 0100")[0]
    assert p.text(f"+1 212 555 0100 {card}") == (f"{phone} {alone}", ["phone", "card"])
    assert p.text(f"{card} 2024-02-29")[1] == ["card", "ymd"] and p.text(f"{card} 5500 0000 0000 0004")[1] == ["card", "card"]
    number = "1234 5678 9012 3456"  # fails Luhn and stays a number
    assert p.text(f"{number} {card}") == (f"{p.text(number)[0]} {alone}", ["card", "card"]) and number not in p.text(number)[0]


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000, 73_049])
def test_permutations_have_no_fixed_point(size):
    p = pii.Permutation(b"k", "t", size)
    xs = range(size) if size < 5000 else range(0, size, 37)
    assert all(p(x) != x and p.undo(p(x)) == x and 0 <= p(x) < size for x in xs) and len({p(x) for x in xs}) == len(xs)


def test_fingerprints(docs, empty, texts):
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for n, (i, t, *_) in enumerate(order):
        t, following = t or "", order[(n + 1) % len(order)][1] or ""
        e = chunks.edited(t, following)
        f, g, h = map(chunks.fingerprint, (t, e, following))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), chunks.as_text(f), chunks.as_text(g), chunks.containment(f, g), chunks.containment(f, h)))
    cols = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    for per in (5, 1000):
        assert rows_of(chunks.neighbour_fingerprints(docs, rows_per_range=per), *cols) == sorted(want, key=repr)
    assert rows_of(chunks.fingerprints(docs), "doc_id", "fingerprint") == sorted(((w[0], w[3]) for w in want), key=repr)
    assert chunks.neighbour_fingerprints(empty).count() == 0


def test_chunks_resist_shifts():
    rng = random.Random(4)
    t = prose(rng, 3000)
    assert chunks.containment(chunks.fingerprint(t), chunks.fingerprint("inserted words " + t)) > 0.97
    assert sum(chunks.chunk_lengths(t.encode())) == len(t.encode()) and chunks.containment({}, {}) == 1.0
    raw = np.random.default_rng(1).integers(0, 256, 500).astype(np.uint8).tobytes()
    slow = [sum(int(chunks.GEAR[raw[i - j]]) << j for j in range(min(i + 1, 32))) % 2**32 for i in range(len(raw))]
    assert chunks.gear_hashes(raw).tolist() == slow


def test_mixing(docs, empty, texts):
    got = mixing.mix_report(docs, rows_per_bin=4)
    rows = got.collect()
    size = Counter()
    for i, t, _, s in texts:
        size[s] += len(WORD.findall(t or ""))
    assert len(rows) == len(texts) and all(r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in rows)
    names = sorted(x for x in size if x is not None) + [None]
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    total, target, free = sum(size.values()), {}, set(names)
    while free:  # water-filling, one round at a time
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * size[s]}
        target |= {s: 3 * size[s] for s in over} if over else {s: level * weight[s] for s in free}
        free -= over or free
    by = {s: {"t": 0, "g": set()} for s in names}
    of = {}
    for i, _, _, s in texts:
        of.setdefault(i, s)
    for r in rows:
        s = of[r.doc_id]
        by[s]["t"] += r.taken if r.source_size == size[s] else 0
    assert {(r.source_size, round(r.target, 6)) for r in rows} == {(size[s], round(target[s], 6)) for s in names}
    assert rows_of(got, "doc_id", "size", "taken") == rows_of(mixing.mix_report(docs, rows_per_bin=1000), "doc_id", "size", "taken")
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert mixing.mix(docs).columns == docs.columns


def test_mixing_comes_near_its_targets(spark):
    rng = random.Random(6)
    d = frame(spark, [(i, prose(rng, rng.randint(5, 40)), None, "abcde"[min(4, i % 9)]) for i in range(900)])
    rows = {r.doc_id: r for r in mixing.mix_report(d, rows_per_bin=50).collect()}
    taken, target = Counter(), {}
    for i, r in rows.items():
        s = "abcde"[min(4, i % 9)]
        taken[s] += r.taken
        target[s] = r.target
    assert all(abs(taken[s] - target[s]) <= 40 for s in target)
    assert mixing.mix(d).count() == sum(r.taken // r["size"] for r in rows.values())


def test_sharding(docs, empty, texts):
    got = sharding.shard_report(docs, rows_per_run=1)
    rows = got.collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"key"} and all(0 <= r.shard < 24 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in texts), key=repr)
    assert rows_of(got, "doc_id", "size", "text_crc32") == want
    assert rows_of(got, "doc_id", "shard", "slot") == rows_of(sharding.shard_report(docs), "doc_id", "shard", "slot")
    assert sharding.shard_report(empty).count() == 0


def test_weights_move_rows_only_into_what_grew(spark):
    from pyspark.sql import functions as F

    ids = spark.range(20_000)
    tree = sharding.tree_of(24)
    more = [[list(k) for k in r] for r in tree]
    more[0][1][2] = 4.0
    got = ids.select(sharding.shard_of(F.col("id"), tree).alias("a"), sharding.shard_of(F.col("id"), more).alias("b")).groupBy("a", "b").count().collect()
    region = lambda s: s // 12
    rack = lambda s: s // 4
    for r in (r for r in got if r.a != r.b):
        assert region(r.b) == 0 and (region(r.a) != 0 or (rack(r.b) == 1 and (rack(r.a) != 1 or r.b == 6)))
    n = Counter()
    for r in got:
        n[r.a] += r["count"]
    assert min(n.values()) > 650 and max(n.values()) < 1020
    assert sum(len(k) for r in sharding.tree_of(27) for k in r) == 27 and sharding.tree_of(25) == sharding.grown(tree)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_queries_match_their_sql(spark):
    import duckdb

    from millrace.llm.queries import ORACLE_SQL, QUERIES

    for view in ("documents", "labels"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM '/root/testdata/sf0.001/{view}.parquet'")
    for name, sql in ORACLE_SQL.items():
        q, o = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas(), duckdb.sql(sql).df()
        by = ["doc_id"] if "doc_id" in q else ["part", "filter_order", "step"]
        a, b = (x[sorted(q.columns)].sort_values(by).reset_index(drop=True) for x in (q, o))
        assert len(a) == len(b) and ((a == b) | (a.isna() & b.isna())).all().all(), name

"""The classifier's evaluation over all fields, against plain Python: held-out profiles, three configurations, the split, the
threshold grid and its choice, and the metrics of each part."""

import hashlib
import random
from collections import Counter

import pytest

from millrace.functions import text
from millrace.operators.occupation import BASELINE, V1_A, V1_B
from millrace.plans.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, d = random.Random(8), str(tmp_path_factory.mktemp("bench"))
    words = [f"{a}{b}" for a in ("bo", "ca", "du", "fe", "gi", "lo") for b in ("ran", "sel", "tix", "vom")] + ["avec", "les", "plus", "42"]
    titles = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 8))) for _ in range(40)]
    # a title is mostly of one source, so that classes can be learned
    docs = []
    for i in range(240):
        k = rng.randrange(40)
        docs.append((i, titles[k] + "\n" + " ".join(rng.choice(words[k % 9 : k % 9 + 9]) for _ in range(20)), "fr", f"s{k % 11 if rng.random() < 0.8 else rng.randrange(11)}"))
    parts = [(k, f"{rng.choice(words)} {rng.choice(words)}{k}") for k in range(30)]
    lines = [(rng.randrange(260), rng.randrange(30)) for _ in range(500)]
    for name, rows, ddl in [("documents", docs, "doc_id long, text string, lang string, source string"), ("part", parts, "p_partkey long, p_name string"), ("lineitem", lines, "l_orderkey long, l_partkey long")]:
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d, docs, parts, lines


def tokens(kind, s):
    return {w for w in text.normal(kind, s).split() if len(w) >= 3 and not w.isdigit() and w not in text.CLASSIFIER_STOP_WORDS}


def top(counts, k):
    return {v for v, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]}


def plain_profiles(offers, ratio):
    out = {}
    for code in {o[0] for o in offers}:
        own = [o for o in offers if o[0] == code]
        titles = top(Counter(" ".join(sorted(o[1])) for o in own if o[1]), 80)
        base = {"fr"} | {w for x in titles for w in x.split()}
        out[code] = [base, base | top(Counter(w for o in own for s in o[2] for w in s), 80), base | top(Counter(w for o in own for w in o[3]), 160), titles | {code}]
    for f in range(3):
        often = Counter(w for p in out.values() for w in p[f])
        for p in out.values():
            p[f] = {w for w in p[f] if ratio > 1 or often[w] <= max(2, int(len(out) * ratio))}
    return out


def plain_prediction(offer, profiles, c):
    """(codes of the best three, score, margin)"""
    _, title, skills, described = offer
    found = []
    for code, p in profiles.items():
        hits = [round(100.0 * len(q & p[f]) / len(q), 4) if q else 0.0 for f, q in enumerate((title, set().union(*skills), described))]
        exact = " ".join(sorted(title)) in p[3]
        if any(hits) or exact:
            found.append((-round((hits[0] * c.title + hits[1] * c.skill + hits[2] * c.description) / 100 + c.bonus * exact, 4), code))
    found.sort()
    score = -found[0][0] if found else 0.0
    return [x for _, x in found[:3]], score, score + found[1][0] if len(found) > 1 else score


def plain_split(truth):
    by, balance, out = {}, 0, {}
    for i, code in truth.items():
        by.setdefault(code, []).append(i)
    for code in sorted(by):
        ids = sorted(by[code], key=lambda i: (hashlib.sha256(f"seed:{code}:{i}".encode()).hexdigest(), i))
        if len(ids) >= 4:
            first = max(1, round(len(ids) * 0.7))
            out |= {i: "calibration" if n < first else "validation" for n, i in enumerate(ids)}
            balance += 3 * first - 2 * len(ids)
        else:
            for i in ids:
                out[i] = "calibration" if balance <= 0 else "validation"
                balance += 1 if balance <= 0 else -2
    return out


def test_benchmark_of_texts(spark, tables):
    d, docs, parts, lines = tables
    names, skills = dict(parts), {}
    for o, k in set(lines):
        skills.setdefault(o, []).append(tokens("description", names[k]))
    offer = {str(i): (f"{lang}-{s}", tokens("title", " ".join(x.split("\n")[0].split(" ")[:8])), skills.get(i, []), tokens("description", x)) for i, x, lang, s in docs}
    known = {str(i): offer[str(i)] for i, *_ in docs if i // 20 % 2}
    matched = {}
    for i, o in offer.items():
        if i not in known and o[1] and (same := [k for k, x in known.items() if x[1] == o[1]]):
            matched[i] = min(same)
    learn = [o for k, o in known.items() if k not in matched.values()]
    truth = {i: known[k][0] for i, k in matched.items()}
    assert len(truth) > 60
    want, chosen = {}, {}
    for c in (BASELINE, V1_A, V1_B):
        profiles = plain_profiles(learn, c.ratio)
        p = {i: plain_prediction(offer[i], profiles, c) for i in truth}
        want[c.name] = (len(truth), sum(x[0][:1] == [truth[i]] for i, x in p.items()), sum(truth[i] in x[0] for i, x in p.items()), sum(not x[0] for x in p.values()))
        chosen = p if c is V1_A else chosen
    got = {r.config: (r.n, r.top1, r.top3, r.unassigned) for r in QUERIES["text_benchmark"](spark, d).collect()}
    assert got == want and 0 < want["V1_A"][1] < len(truth)

    part_of = plain_split(truth)
    right = {i: x[0][:1] == [truth[i]] for i, x in chosen.items()}
    inside = lambda rows, s, m: [i for i in rows if chosen[i][1] >= s and chosen[i][2] >= m]
    rows = [i for i in truth if part_of[i] == "calibration"]
    options = []
    for s in range(50, 81, 5):
        for m in range(5, 31, 5):
            covered = inside(rows, s, m)
            if len(covered) >= 5:
                precision = sum(right[i] for i in covered) / len(covered)
                options.append((precision < 0.9, -precision, -len(covered), s, m))
    s, m = min(options)[-2:] if options else (100, 100)
    metrics = {}
    for part in ("calibration", "validation", "all"):
        rows = [i for i in truth if part in ("all", part_of[i])]
        covered = inside(rows, s, m)
        errors = sum(not right[i] for i in covered)
        metrics[part] = (s, m, len(rows), len(covered), errors, round((len(covered) - errors) / len(covered), 4) if covered else None, round(len(covered) / len(rows), 4))
    got = {r.part: (r.min_score, r.min_margin, r.sample_size, r.auto_assigned, r.errors, r.precision, r.coverage) for r in QUERIES["text_benchmark_thresholds"](spark, d).collect()}
    assert got == metrics

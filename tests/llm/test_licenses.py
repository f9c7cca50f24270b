"""Spans of notices against a plain search over the words, keys of other types, repeated keys."""

from difflib import SequenceMatcher

from millrace.llm import license_scan as scan
from millrace.llm.common import lower_ascii

from .test_operators import docs, frame, texts  # noqa: F401

MIT, GPL = scan.NOTICES[0].text, scan.NOTICES[2].text


def labels(spark, rows):
    return {r.doc_id: (r.labels, round(r.score, 6)) for r in scan.license_scan(frame(spark, rows)).collect()}


def test_a_notice_with_inserted_lines(spark):
    words = GPL.split()
    header = " page 7 of 12 annual report of the committee on works "
    cut = " ".join(words[:14]) + header + " ".join(words[14:27]) + " copyright 1999 by the holder of all these rights " + " ".join(words[27:])
    got = labels(spark, [(1, "before it " + cut + " after it", None, None), (2, " ".join(words[20:] + words[:20]), None, None), (3, " ".join(words[:9]), None, None), (4, GPL + " x " * 500 + MIT, None, None)])
    assert got[1] == ("gpl,gpl-notice", 1.0)
    assert "gpl-notice" not in got[3][0] and got[4][0] == "gpl,gpl-notice,mit-text"


def test_labels_against_a_plain_search(spark, docs, texts):  # noqa: F811
    """Every document against every template: the best alignment of the whole text, without votes."""
    rows = [(1000 + n, "intro words here " + " ".join(w for k, w in enumerate(t.text.split()) if k % 9 or n % 2) + " and an end", None, None) for n, t in enumerate(scan.NOTICES)]
    rows += [(i, t, None, None) for i, t, *_ in texts if i is not None and i < 60]
    got = {r.doc_id: set(r.labels.split(",")) - {""} for r in scan.license_scan(frame(spark, rows)).collect()}
    for i, t, *_ in rows:
        w, want = scan.WORDS.findall(lower_ascii(t)), set()
        for x in scan.TEMPLATES:
            if x.phrase:
                if any(w[k : k + len(x.words)] == x.words for k in range(len(w))):
                    want.add(x.label)
            elif sum(b.size for b in SequenceMatcher(None, x.words, w, autojunk=False).get_matching_blocks() if b.size >= scan.TEXT_K) >= 0.5 * len(x.words):
                want.add(x.label)
        assert got[i] >= want and (i < 1000 or got[i] == want), i


def test_keys_of_any_type_and_repeated_rows(spark):
    d = spark.createDataFrame([("a", "the MIT license"), ("a", "nothing"), (None, "apache license apache license"), (None, "apache license apache license"), ("b", None)], "doc_id string, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.base_labels) for r in scan.license_scan(d).collect()), key=repr)
    assert got == sorted([("a", 3, 1, "mit"), ("a", 1, 0, ""), (None, 4, 2, "apache"), (None, 4, 2, "apache"), ("b", 0, 0, "")], key=repr)

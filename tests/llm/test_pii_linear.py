"""Long texts of awkward shapes are scanned in a time in proportion to their length, and long values are permuted and undone."""

import random
import time

import numpy as np
import pytest

from millrace.llm import pii

SHAPES = {
    "letters": "x" * 3_000_000,
    "digits": "7" * 3_000_000,
    "short_runs": "a.b-" * 750_000 + "1",
    "groups": "1234 " * 200_000,
    "iban_starts": "AB12 " * 100_000,
    "hex": "ab12" * 750_000,
    "no_hex": "password: " + "a" * 3_000_000 + "Z",
    "keywords": "token " * 500_000 + "=",
    "local_part": "ab" * 1_500_000 + "@x.com",
    "no_domain": "a@" * 1_500_000,
    "labels": "a@" + "a." * 1_500_000,
    "addresses": "a@b.co " * 200_000,
}


@pytest.mark.parametrize("name", SHAPES)
def test_time_is_linear(name):
    begin = time.process_time()
    pii.Pseudonyms(pii.DEMO_KEY).text(SHAPES[name])
    assert time.process_time() - begin < 20


@pytest.mark.parametrize("value", ["ab12" * 200, "0123456789" * 100, "password: " + "aB3_" * 200, "x.y" * 150 + "@example.com"])
def test_long_values_are_undone(value):
    new, kinds = pii.Pseudonyms(pii.DEMO_KEY).text(value)
    assert len(kinds) == 1 and new != value and len(new) == len(value)
    assert [c.isdigit() for c in new] == [c.isdigit() for c in value]
    assert pii.Pseudonyms(pii.DEMO_KEY, undo=True).text(new)[0] == value


def test_wide_network_permutes_every_string():
    """All strings of radices 3, 2, 4: a bijection without a fixed point, undone by undo."""
    p = pii.WidePermutation(b"k", "t", np.array([3, 2, 4]))
    every = [np.array([a, b, c]) for a in range(3) for b in range(2) for c in range(4)]
    out = [tuple(p(x).tolist()) for x in every]
    assert sorted(out) == sorted(tuple(x.tolist()) for x in every)
    assert all(o != tuple(x.tolist()) and tuple(p.undo(np.array(o)).tolist()) == tuple(x.tolist()) for o, x in zip(out, every))


LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def plain_emails(text):
    """Every @ in turn: characters to its left, then labels to its right, by hand."""
    out, pos = [], 0
    for at, c in enumerate(text):
        if c != "@" or at < pos:
            continue
        start = at
        while start > pos and text[start - 1] in LOCAL:
            start -= 1
        run = at + 1
        while run < len(text) and (text[run].isascii() and text[run].isalnum() or text[run] in "-."):
            run += 1
        best = None
        for end in range(run, at + 1, -1):
            *labels, top = text[at + 1 : end].split(".")
            if labels and all(labels) and len(top) > 1 and top.isalpha():
                best = end
                break
        if start < at and best:
            out.append(text[start:best])
            pos = best
    return out


def test_addresses_are_those_of_a_plain_scan():
    rng = random.Random(3)
    parts = ["a", "bc", ".", "-", "@", "@", " ", "com", "9", "_", "+", "\u00e9", "x.org", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        emails, pos, got = pii.Emails(text), 0, []
        while e := emails.after(pos):
            got.append(text[slice(*e)])
            pos = e[1]
        assert got == plain_emails(text), text

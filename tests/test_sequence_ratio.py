"""Sequence similarity of many pairs at once against difflib, one by one."""

import random
import time
from difflib import SequenceMatcher

from millrace.functions import text


def test_ratios_are_difflibs():
    rng = random.Random(4)
    word = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    pairs = [(word("ab c", rng.randrange(30)), word("abcé", rng.randrange(30))) for _ in range(3000)]
    pairs += [(word("abcdefghij ", rng.randrange(150, 230)), word("abcdefghij ", rng.randrange(150, 230))) for _ in range(60)]
    pairs += [("", ""), ("a", ""), ("", "a"), (None, "a"), ("a", None), ("a\0", "\0"), ("日本語", "本語日"), ("x" * 199, "x" * 199), ("supplier 000000001", "customer 000000010")]
    pairs += [(chr(0x100 + i) + "b", chr(0x101 + i) + "b") for i in range(400)]  # more characters than a byte tells apart
    want = [SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in pairs]
    assert list(text.ratios(*zip(*pairs))) == want


def test_many_pairs_are_fast():
    """Before, each pair went through difflib by itself."""
    rng = random.Random(5)
    a, b = (["supplier " + str(rng.randrange(10**9)) for _ in range(20_000)] for _ in range(2))
    began = time.perf_counter()
    text.ratios(a, b)
    quick = time.perf_counter() - began
    began = time.perf_counter()
    for x, y in zip(a[:2000], b[:2000]):
        SequenceMatcher(None, x, y).ratio()
    assert quick < 10 * (time.perf_counter() - began) / 3


def test_texts_are_coded_once(monkeypatch):
    """Before, a text was coded anew for each pair that it was in."""
    seen, matched = [], text.matched
    monkeypatch.setattr(text, "matched", lambda xs, ys, *pairs: seen.append((len(xs), len(ys))) or matched(xs, ys, *pairs))
    xs, ys = [f"supplier {i:09d}" for i in range(5)], [f"customer {i:09d}" for i in range(200)]
    pairs = [(x, y) for x in xs for y in ys]
    assert list(text.ratios(*zip(*pairs))) == [SequenceMatcher(None, x, y).ratio() for x, y in pairs]
    assert seen == [(5, 200)]

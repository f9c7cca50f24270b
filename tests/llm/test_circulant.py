"""The signature's permutations, its agreement with similarity, and recall just above the threshold."""

import numpy as np

from millrace.llm import minhash


def test_each_coordinate_permutes_the_points():
    w = minhash.second_permutation(8)
    for j in (0, 3, 7):
        assert len(np.unique(w[:, j])) == minhash.CIRCLE and not np.any(w[:, j] & np.uint32(0xFFF))
    assert (w[1:, 0] == w[:-1, 1]).all()


def pairs(rng, n, similarity, size=600):
    """Pairs of sets of hashes with a similarity of (size - k) / (size + k)."""
    k = round(size * (1 - similarity) / (1 + similarity))
    for _ in range(n):
        x = rng.integers(0, 2**63, size + k).astype(np.uint64)
        yield np.unique(x[:size]), np.unique(x[k:])


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(6)
    for similarity in (0.3, 0.85):
        shares = [(minhash.signature(a, 128) == minhash.signature(b, 128)).mean() for a, b in pairs(rng, 150, similarity)]
        assert abs(np.mean(shares) - similarity) < 0.01 and np.std(shares) < 1.3 * (similarity * (1 - similarity) / 128) ** 0.5


def test_recall_just_above_the_threshold():
    bands, rows = minhash.bands_for(85)
    least, met = minhash.least_agreement(85, bands * rows), 0
    for a, b in pairs(np.random.default_rng(9), 1000, 0.853):
        x, y = (minhash.signature(s, bands * rows) for s in (a, b))
        assert minhash.linked(a, b, 85)
        same = x == y
        met += bool(same.reshape(bands, rows).all(axis=1).any()) and same.sum() >= least
    assert met == 1000

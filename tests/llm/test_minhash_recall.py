"""How many pairs at the threshold the signatures find, on planted sets."""

import numpy as np
import pytest

from kindred.llm import minhash


@pytest.mark.parametrize("common, union", [(80, 100), (800, 1000), (850, 1000)])
def test_pairs_at_the_threshold_share_a_key(common, union):
    """A pair is found if some chunk has at most ``ERRORS`` errors and the whole
    signature at most ``VERIFY_DISTANCE``."""
    rng = np.random.default_rng(5)
    only, n, lost = union - common, 2000, 0
    chunks = np.linspace(0, minhash.N_SYMBOLS, minhash.CHUNKS + 1).astype(int)[:-1]
    for _ in range(n):
        x = rng.integers(0, 2 ** 64, union, np.uint64)
        one = np.sort(x[:common + only // 2])
        two = np.sort(np.concatenate((x[:common], x[common + only // 2:])))
        errors = minhash.signature(one) != minhash.signature(two)
        near = (np.add.reduceat(errors, chunks) <= minhash.ERRORS).any()
        assert near or errors.sum() > minhash.GUARANTEED_DISTANCE
        lost += not (near and errors.sum() <= minhash.VERIFY_DISTANCE)
    assert lost <= n * 0.002

"""Block keys of the Jaccard join: linked sets share one, sets with a few common shingles do not."""

import numpy as np
import pytest

from tidemark.llm.jaccard_join import Threshold, block_keys


def distinct(rng, n):
    return rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2)


def keys(values, t):
    return set(block_keys(np.unique(values), t, t.bands(1 << 40)).tolist())


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_key(percent):
    rng, t = np.random.default_rng(percent), Threshold(percent)
    for _ in range(600):
        common = distinct(rng, int(rng.integers(1, 300)))
        differing = 100 * len(common) // percent - len(common)  # of a union that just allows the link
        mine = int(rng.integers(0, differing + 1))
        x, y = (np.concatenate([common, distinct(rng, n)]) for n in (mine, differing - mine))
        assert keys(x, t) & keys(y, t)


def test_common_shingles_do_not_join_unrelated_sets():
    rng, t = np.random.default_rng(3), Threshold(80)
    common = distinct(rng, 12)
    sets = [np.concatenate([common, distinct(rng, 250)]) for _ in range(60)]
    held = [keys(x, t) for x in sets]
    met = sum(bool(held[i] & held[j]) for i in range(60) for j in range(i))
    assert met < 0.05 * 60 * 59 / 2

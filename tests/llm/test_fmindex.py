import numpy as np
import pytest

from basketry.llm.fmindex import FMIndex, expand, suffix_array


def text(seed):
    pick = np.random.default_rng(seed)
    parts = [pick.integers(1, pick.integers(2, 8), pick.integers(1, 30)) for _ in range(6)]
    parts += [parts[0], np.concatenate([parts[0], parts[0]])]
    return np.concatenate([np.append(p, 0) for p in parts])


@pytest.mark.parametrize("seed", range(30))
def test_suffixes_are_sorted(seed):
    t = text(seed)
    ends = np.flatnonzero(t == 0)
    rank = {int(e): i for i, e in enumerate(ends)}
    keys = [[rank[j] - len(ends) if t[j] == 0 else t[j] for j in range(i, len(t))] for i in range(len(t))]
    assert suffix_array(t).tolist() == sorted(range(len(t)), key=keys.__getitem__)


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("sample", [1, 4, 32])
def test_search_finds_every_place(seed, sample):
    t, pick = text(seed), np.random.default_rng(seed)
    index = FMIndex(t, sample)
    for length in (1, 2, 5):
        patterns = pick.integers(1, 9, (20, length))
        rows, of = expand(*index.search(patterns))
        places = index.locate(rows)
        for k, pattern in enumerate(patterns):
            there = [i for i in range(len(t) - length + 1) if (t[i : i + length] == pattern).all()]
            assert sorted(places[of == k].tolist()) == there

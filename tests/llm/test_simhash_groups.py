"""Large groups of fingerprints that share most of their bits."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from wordfold.llm import simhash


def roots(n: int, links) -> list:
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in links:
        root[find(int(j))] = find(int(i))
    return [find(i) for i in range(n)]


def components(labels) -> set:
    by: dict = {}
    for i, x in enumerate(labels):
        by.setdefault(x, []).append(i)
    return {frozenset(v) for v in by.values() if len(v) > 1}


@pytest.mark.parametrize("cut", [4, 32, 4096])
def test_cut_groups_connect_the_same(monkeypatch, cut):
    monkeypatch.setattr(simhash, "CUT", cut)
    r = random.Random(cut)
    for free in (6, 12, 24):
        fps = {r.getrandbits(free) << 20 for _ in range(400)}
        centre = r.getrandbits(free) << 20
        fps |= {centre ^ sum(1 << (20 + b) for b in r.sample(range(free), r.randint(0, 4))) for _ in range(100)}
        fp = np.array(sorted(fps), np.uint64)
        slow = [(i, j) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 4)]
        links = simhash._forest(fp, 4)
        assert all(int(fp[i] ^ fp[j]).bit_count() <= 4 for i, j in links)
        assert components(roots(len(fp), links)) == components(roots(len(fp), slow))


def test_a_large_sparse_group_takes_no_square_of_its_size():
    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 2**40, 200_000, dtype=np.uint64))
    near = base[:500] ^ np.uint64(0b1011)
    fp = np.unique(np.r_[base, near])
    began = time.process_time()
    links = simhash._forest(fp, 4)
    assert time.process_time() - began < 60
    label = roots(len(fp), links)
    at = {int(x): i for i, x in enumerate(fp)}
    assert all(label[at[int(a)]] == label[at[int(b)]] for a, b in zip(base[:500], near))

"""What a block of documents costs: words hashed by pieces of text, keys ordered by sorting values."""

from __future__ import annotations

import numpy as np
import pytest

from wordfold.llm import blocks, common, scoring

TEXTS = [b"", b" ", b"A bc  D\x0b\x0ce\n", b"one", b" \tx", "É\x00é \xa0Z".encode(), b"", b"Long" * 50_000 + b" Word " * 40_000, b"a A", b"\r"]


@pytest.mark.parametrize("piece", [1, 4, 1 << 16])
def test_words_hash_alike_alone_and_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(common, "_PIECE", piece)
    symbols, counts = common.lower_word_symbols(TEXTS)
    alone = [common.word_symbols(t.lower()) for t in TEXTS]
    assert counts.tolist() == [len(x) for x in alone]
    assert np.array_equal(symbols, np.concatenate(alone))
    symbols, counts = common.lower_word_symbols([])
    assert len(symbols) == len(counts) == 0


def test_texts_are_not_hashed_one_by_one(monkeypatch):
    # a call for each text took a third of the time of finding a block's runs
    calls, hashes = [], common.stretch_hashes
    monkeypatch.setattr(common, "stretch_hashes", lambda *a: calls.append(1) or hashes(*a))
    runs = scoring.Runs([(i, b"some words %d" % i) for i in range(2000)], np.zeros(2000, bool), 3)
    assert runs.sizes.tolist() == [4] * 2000 and len(calls) < 5
    assert (runs.run[0][::5] == scoring.START).all() and (runs.run[0][4::5] == scoring.END).all()


def test_keys_are_ordered_as_by_their_places(monkeypatch):
    r = np.random.default_rng(3)
    wide = r.integers(0, 2**64, 3000, np.uint64)
    tied = (wide & ~np.uint64(0xFFF)) | r.integers(0, 3, 3000).astype(np.uint64)  # differ only where nothing is left of a key
    few = r.choice(wide[:50], 3000)
    far = np.array([2**64 - 1, 0, 2**64 - 1, 1, 2**63], np.uint64)
    for keys in (wide, tied, np.repeat(tied[:100], 30) ^ r.integers(0, 3, 3000).astype(np.uint64), few, far, np.array([5, 9, 5], np.uint64), wide[:1], wide[:0], np.full(9, 7, np.uint64)):
        order = blocks.key_order(keys)
        assert np.array_equal(keys[order], np.sort(keys)) and np.array_equal(np.sort(order), np.arange(len(keys)))
    places = []
    monkeypatch.setattr(np, "argsort", lambda *a, **b: places.append(1))
    keys = blocks.Keys(few & scoring._KEY, None, None, "sum")
    assert not places and keys.values is None and np.array_equal(keys.first[keys.group], few & scoring._KEY)

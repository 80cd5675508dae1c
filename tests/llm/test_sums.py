"""What sums move between steps: packed values, and bits where a step needs no more."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordfold.llm import blocks, scoring


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 5000])
def test_pressed_values_come_back(n):
    r = np.random.default_rng(n)
    columns = [r.integers(0, 2**64, n, np.uint64), r.integers(0, 3, n).astype(np.uint64), np.zeros(n, np.uint64), r.integers(-5, 5, n).view(np.uint64)]
    data = b"??" + b"".join(map(blocks.pressed, columns))
    at = 2
    for want in columns:
        got, at = blocks.from_pressed(data, at, n)
        assert np.array_equal(got, want)
    assert at == len(data)


def test_sums_and_what_reaches_a_limit():
    a = blocks.Keys(np.array([5, 9, 5, 2**63], np.uint64), np.array([1, 2, 1, -7]), None, "sum")
    b = blocks.Keys(np.array([9, 11], np.uint64), np.array([3, 0]), None, "sum")
    (x,), (y,) = (blocks._sent(k, np.empty(0, np.uint64)) for k in (a, b))
    totals, reached, odd, odd_sum = blocks._combine([x[1], y[1]], False, "sum", 3)
    assert (odd, odd_sum) == (2, 7)
    told = blocks.Answers(None)
    told.by = {"k": [(0, totals[0])], "k-often": [(0, reached[0])]}
    assert told.totals("k").tolist() == [2, 5, -7] and told.often("k").tolist() == [False, True, False]
    assert told.totals("none").tolist() == told.often("none").tolist() == []


def test_counting_runs_moves_few_bytes(spark, monkeypatch):
    # the keys of one step were 16 bytes each before the shuffle's codec, and each later step was told all counts
    r = np.random.default_rng(4)
    df = spark.createDataFrame([(i, " ".join(f"w{x}" for x in r.zipf(1.3, 400) % 3000)) for i in range(300)], "doc_id long, text string").coalesce(1)
    seen = []
    step = blocks.Blocks.step

    def watched(self, run, schema, kinds=None):
        out = step(self, run, schema, kinds)
        told = self.answers
        if told is not None:
            told = told.where("block >= 0") if kinds is None else told.where("block >= 0").where(F.col("kind").isin(kinds))
        size = lambda x: x.agg(F.coalesce(F.sum(F.length("payload")), F.lit(0))).first()[0]
        seen.append((size(out) if "payload" in schema else 0, size(told) if told is not None else 0))
        return out

    monkeypatch.setattr(blocks.Blocks, "step", watched)
    got = scoring.lm_scores(df, min_count=2)
    assert got.count() == 300
    (words, _), (pairs, told_pairs), (_, told_runs), *_ = seen
    texts = [[x for x in t.split()] for (t,) in df.select("text").collect()]
    n = len({p for t in texts for p in zip(["^", *t], [*t, "$"])})
    assert pairs < 5 * n and words < 8 * n  # and not all pairs in one step
    assert told_pairs < n and told_runs < n

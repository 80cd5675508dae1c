"""Language-model scores from a probabilistic suffix tree over words.

Symbols are lower-cased words and one end after each text; a text starts after a
start symbol, which is only a context. A state of the tree is a context of up to
``DEPTH`` preceding symbols that occurs at least ``MIN_COUNT`` times in the training
texts, so the tree grows with the corpus: in the number of its states, and in what
it knows about each.

The tree is nowhere in one place. What is counted are runs of 1 to ``DEPTH + 1``
symbols: a run's count is that of its last symbol in the state of the ones before,
and also how often the run itself is a context. The counts are found in the
corpus-wide exchange of ``blocks``, shorter runs first, and a longer run is counted only
where the run before its last symbol is frequent (some runs of two anywhere); so each block of documents is told
only about the states that it uses.

A candidate state is kept if the symbols after it diverge from its parent's (the
context without its oldest symbol): the log-likelihood ratio of its training
symbols, each left out of its own count, must reach ``DIVERGENCE`` a symbol seen. This is
summed for each state over all blocks, and each block learns the sums of its own. A state's
distribution is smoothed by the parent's, with ``PRIOR`` symbols' weight; the root's
by one count for every known symbol and the unknown one. A symbol is scored in
the state of the longest kept suffix of what precedes it.

A state's parent always counts as its next shorter candidate context, kept or
not: if that one is not kept, its own kept suffix stands in.

Runs are told by 48-bit hashes: among 10^9 different ones, about 4 in a million share a count with another.

Defined results: null or empty texts are one end symbol; a null id counts as an
empty one in the hold-out rule; without training texts, N and V are 0 and every
symbol has probability 1; repeated rows are repeated texts; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordfold.llm.blocks import Answers, Blocks, Docs, Keys
from wordfold.llm.common import lower_word_symbols, mix64, table

FOLDS, HELD_OUT = 7, 2
DEPTH = 3
MIN_COUNT = 200
DIVERGENCE = 0.02
PRIOR = 50.0

_U = np.uint64
#: Keys are 48 bits wide: what moves is mostly keys, and their low bytes then cost nothing.
_KEY = ~_U(0xFFFF)
#: So many eighths of the runs of two are counted together with the words, wherever they are, and the others where
#: their first symbol is frequent: neither step moves the most of them, so neither needs much more room than the other.
_EARLY = 3
END = _U(0x9AE16A3B2F90404F)  # the end symbol: no word hashes to it but by accident
START = _U(0xC3A5C85C97CB3127)


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


class Runs:
    """A block's symbols, each text behind a start symbol, and hashes of the runs that end at each."""

    def __init__(self, docs: Docs, held: np.ndarray, depth: int) -> None:
        words, counts = lower_word_symbols([data for _, data in docs])
        self.sizes = counts + 1
        self.depth = depth
        begin = np.cumsum(self.sizes + 1) - self.sizes - 1
        symbol = np.empty(len(words) + 2 * len(docs), np.uint64)
        inside = np.ones(len(symbol), bool)
        inside[begin] = inside[begin + self.sizes] = False
        symbol[begin], symbol[begin + self.sizes], symbol[inside] = START, END, words
        self.doc = np.repeat(np.arange(len(docs)), self.sizes + 1)
        # how many symbols of the text, its start included, lie before
        self.behind = np.arange(len(symbol)) - begin[self.doc]
        self.token = self.behind > 0
        self.train = ~held[self.doc]
        self.run = [symbol]

    def runs(self, k: int) -> np.ndarray:
        """Hashes of the runs of ``k`` symbols by their last place (of any sense only where they fit in a text)."""
        while len(self.run) < k:
            n = len(self.run)
            older = np.r_[np.zeros(n, np.uint64), self.run[0][:-n]]
            self.run.append(mix64(self.run[-1] + older * _U(2 * n + 1)))
        return self.run[k - 1]

    def key(self, k: int, at: np.ndarray | slice) -> np.ndarray:
        """Keys of runs of ``k`` symbols: of single tokens odd, of all others even."""
        h = mix64(self.runs(k)[at] + _U(k)) & _KEY
        return (h | _U(1)) if k == 1 else h


class Counts:
    """What a block knows of its runs: ``often[k]`` says if the run of ``k`` that ends at each place
    is frequent, and ``of[k]`` is its training count, -1 where it was not asked for."""

    def __init__(self, runs: Runs, min_count: int) -> None:
        self.runs, self.min_count = runs, min_count
        self.of: dict[int, np.ndarray] = {}
        self.often: dict[int, np.ndarray] = {}
        # told by bits of the key that the choice of its bucket does not use
        self.pairs = runs.key(2, slice(None))
        self.early = (self.pairs >> _U(16) & _U(7)) < _EARLY

    def frequent(self, k: int) -> np.ndarray:
        """Where a context of ``k`` symbols lies before the place and is frequent."""
        out = np.zeros(len(self.runs.token), bool)
        out[1:] = self.often[k][:-1] & self.runs.token[1:]
        return out

    def asked(self, stage: str) -> list[tuple[int, np.ndarray | slice]]:
        """Lengths and last places of the runs that are counted."""
        r = self.runs
        if stage == "words":
            return [(1, slice(None)), (2, np.flatnonzero(r.token & self.early))]
        if stage == "pairs":
            return [(2, np.flatnonzero(self.frequent(1) & ~self.early))]
        # every run of two inside the context must be frequent: some more than are states, never fewer
        often, out = self.frequent(2), []
        inside = often
        for k in range(3, r.depth + 2):
            if k > 3:
                inside = np.r_[False, inside[:-1]] & often
            out.append((k, np.flatnonzero(inside & (r.behind >= k - 1))))
        return out

    def keys(self, stage: str, sums: bool = True) -> tuple[Keys, list[tuple[int, np.ndarray | slice, int]]]:
        """The runs' keys, and lengths, last places and number of the runs; ``sums``: with the block's own counts."""
        places = self.asked(stage)
        key = [self.pairs[p] if k == 2 else self.runs.key(k, p) for k, p in places]
        if stage == "words":  # the start symbol is no token
            key[0][~self.runs.token] &= ~_U(1)
        count = np.concatenate([self.runs.train[p] for _, p in places]).astype(np.int64) if sums else None
        return Keys(np.concatenate(key), count, None, "sum"), [(k, p, len(x)) for (k, p), x in zip(places, key)]

    def learn(self, stage: str, answers: Answers, counts: bool) -> None:
        """``counts``: the counts themselves, else only which of them are frequent."""
        keys, places = self.keys(stage, False)
        told = (answers.totals(stage) if counts else answers.often(stage))[keys.group]
        at, n = 0, len(self.runs.token)
        for k, p, size in places:
            mine = told[at : at + size]
            if counts:
                self.of.setdefault(k, np.full(n, -1, np.int64))[p] = mine
                mine = mine >= self.min_count
            self.often.setdefault(k, np.zeros(n, bool))[p] = mine
            at += size


def _stages(depth: int) -> list[str]:
    return ["words", "pairs", "runs"] if depth > 1 else ["words", "pairs"]


def _states(c: Counts) -> tuple[Keys | None, list[np.ndarray], list[np.ndarray]]:
    """Places with a candidate state, by context length from 1, and their states' keys."""
    places, keys = [], []
    for d in range(1, c.runs.depth + 1):
        p = np.flatnonzero(c.frequent(d))
        places.append(p)
        keys.append(mix64(c.runs.runs(d)[p - 1] + _U(1_000 + d)) & _KEY)
    return places, keys


def _root(c: Counts, n: int, v: int) -> np.ndarray:
    return (c.of[1] + 1.0) / (n + v + 1.0)


def lm_scores(docs: DataFrame, min_count: int = MIN_COUNT, divergence: float = DIVERGENCE, depth: int = DEPTH) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of ``docs``
    (``doc_id, text``); documents with crc32(id) mod 7 = 2 are not learned from."""
    blocks = Blocks(docs, "scoring")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    stages = _stages(depth)

    def counted(d: Docs, answers: Answers, rows: pa.Table, upto: int = len(stages), counts: bool = True) -> Counts:
        held = np.array([held_out(i) for i in rows.column("doc_id").to_pylist()], bool)
        c = Counts(Runs(d, held, depth), min_count)
        for stage in stages[:upto]:
            c.learn(stage, answers, counts)
        return c

    for i, stage in enumerate(stages):
        # which runs to count next follows from which ones are frequent: a bit for each is moved, not its count
        told = [f"{s}-often" for s in stages[:i]]
        blocks.ask(stage, lambda d, a, rows, i=i, s=stage: counted(d, a, rows, i, False).keys(s)[0], kinds=told, often=min_count)
        if not i:
            v, n = blocks.odd_keys("words")

    def gains(d: Docs, answers: Answers, rows: pa.Table) -> Keys:
        c = counted(d, answers, rows)
        places, keys = _states(c)
        p, gain, used = _root(c, n, v), [], []
        for k, (at, key) in enumerate(zip(places, keys), 1):
            own = at[c.runs.train[at]]
            w, m = c.of[k][at - 1], c.of[k + 1][at]
            mine = c.runs.train[at]
            left = (m[mine] - 1 + PRIOR * p[own]) / (w[mine] - 1 + PRIOR)
            # whole millionths, so that the sum does not depend on its order
            gain.append(np.round((np.log(left) - np.log(p[own])) * 1e6).astype(np.int64))
            used.append(key[mine])
            # places without training symbols ask for their state's sum too
            gain.append(np.zeros(int((~mine).sum()), np.int64))
            used.append(key[~mine])
            p[at] = (m + PRIOR * p[at]) / (w + PRIOR)
        return Keys(np.concatenate(used), np.concatenate(gain), None, "sum")

    blocks.ask("gains", gains, kinds=stages)

    def score(d: Docs, answers: Answers, rows: pa.Table) -> pa.Table:
        c = counted(d, answers, rows)
        r = c.runs
        places, keys = _states(c)
        known = Keys(np.concatenate(keys), None, None, "sum")
        total = np.split(answers.totals("gains")[known.group], np.cumsum([len(x) for x in keys])[:-1])
        root = _root(c, n, v)
        p = root.copy()
        for k, (at, gain) in enumerate(zip(places, total), 1):
            w, m = c.of[k][at - 1], c.of[k + 1][at]
            kept = gain / 1e6 >= divergence * w
            at = at[kept]
            p[at] = (m[kept] + PRIOR * p[at]) / (w[kept] + PRIOR)
        of = lambda x: np.bincount(r.doc[r.token], x[r.token], len(d))
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "held_out": pa.array([held_out(i) for i in rows.column("doc_id").to_pylist()], pa.bool_()),
                "n_tokens": pa.array(r.sizes),
                "n_known": pa.array(of(c.of[1] > 0).astype(np.int64)),
                "train_tokens": pa.array([n] * len(d), pa.int64()),
                "base_score": pa.array(of(np.log10(root))),
                "score": pa.array(of(np.log10(p))),
            }
        )

    return blocks.step(
        score,
        f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        [*stages, "gains"],
    )


def q_scoring(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))

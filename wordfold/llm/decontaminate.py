"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

Every window of a document that has as many words as a benchmark item is a
candidate for that item; a document with fewer words is one window, its whole text. A window similar enough must share most shingles with
the item, so windows with fewer shingles known from any item of their size are
passed over by a running count (this loses nothing). The others get a 64-bit
SimHash over their shingles with repeats, looked up in a multi-index: the 64
bits are cut into ``RADIUS + 1`` blocks, and of two fingerprints within
``RADIUS`` bits some block is equal. Pairs within the radius are then verified by
the exact weighted Jaccard similarity (shingles weighted by their count in the
window and in the item).

The benchmark is a query set: it goes to the tasks in blocks of at most
``BLOCK_BYTES`` of text, and the documents are scanned once for each block. No
document is shuffled.

Defined results: words are split at ASCII white space and A-Z lower-cased; an
item of fewer words than a shingle is one shingle; null or empty texts match
nothing; null ids are carried; repeated rows and items are repeated; empty
tables give no rows; other columns are ignored (``decontaminate`` keeps them).
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import arrow_column, mix64, packed, table, text_bytes, unpacked, window_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Similarity 0.8 changes about 10 of 64 bits, give or take 3.
RADIUS = 28
BLOCK_BYTES = 8_000_000

_U = np.uint64


def _shingles(words: list[bytes], k: int) -> list[bytes]:
    return [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]


def _bits(shingles: list[bytes]) -> np.ndarray:
    h = np.array([xxhash.xxh64_intdigest(s) for s in shingles], "<u8")
    return np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64)


def _packed(ones: np.ndarray, n: int) -> np.ndarray:
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view("<u8")[:, 0]


def weighted_jaccard(a: Counter, b: Counter) -> float:
    """Sum of least weights over sum of greatest weights; 1 for two empty bags."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    either = sum(a.values()) + sum(b.values()) - both
    return both / either if either else 1.0


class Items:
    """The index of one block of benchmark items."""

    def __init__(self, items: list[tuple[object, bytes]], shingle: int, similarity: float, radius: int) -> None:
        self.shingle, self.similarity, self.radius = shingle, similarity, radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [(_U(a), _U((1 << (b - a)) - 1)) for a, b in zip(edges[:-1], edges[1:])]
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.bags, self.prints = [], [], []
        self.index: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        known: dict[int, list[np.ndarray]] = defaultdict(list)
        self.sizes: set[int] = set()
        for item_id, data in items:
            words = data.lower().split()
            if not words:
                continue
            k = min(shingle, len(words))
            parts = _shingles(words, k)
            fp = _packed(_bits(parts).sum(axis=0, dtype=np.int64)[None, :], len(parts))[0]
            i = len(self.ids)
            self.ids.append(item_id)
            self.bags.append(Counter(parts))
            self.prints.append(int(fp))
            self.sizes.add(len(words))
            for b, (shift, mask) in enumerate(self.blocks):
                self.index[len(words), b, int(fp >> shift & mask)].append(i)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            known[k].append(window_hashes(mix64(np.array(ids, np.uint64)), k))
        self.known = {k: np.unique(np.concatenate(v)) for k, v in known.items()}

    def matches(self, data: bytes) -> list[tuple[int, int, int, float]]:
        """``(item, first word, words, similarity)`` of the best window for each item that the text holds."""
        words = data.lower().split()
        n = len(words)
        whole = n - self.shingle + 1
        sizes = [s for s in self.sizes if s <= n]
        # a shorter text is similar at most by its share of the item's shingles
        longer = [s for s in self.sizes if s > n and whole >= max(1, self.similarity * (s - self.shingle + 1) - 1e-9)]
        if not sizes and not longer:
            return []
        get = self.vocabulary.get
        ids = mix64(np.fromiter((get(w, 0) for w in words), np.uint64, n))
        best: dict[int, tuple[float, int, int]] = {}
        upto = {}
        for k, known in self.known.items():
            h = window_hashes(ids, k)
            if len(h):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                upto[k] = np.r_[0, np.cumsum(known[at] == h)]
        for size in longer:
            parts = _shingles(words, self.shingle)
            need = math.ceil((whole + size - self.shingle + 1) * self.similarity / (1 + self.similarity) - 1e-9)
            if upto[self.shingle][-1] >= need:
                fp = int(_packed(_bits(parts).sum(axis=0, dtype=np.int64)[None, :], len(parts))[0])
                self._compare(size, fp, parts, 0, n, best)
        for size in sizes:
            k = min(self.shingle, size)
            m = size - k + 1
            need = math.ceil(2 * m * self.similarity / (1 + self.similarity) - 1e-9)
            c = upto[k]
            if c[-1] < need:
                continue
            starts = np.flatnonzero(c[m:] - c[:-m] >= need)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1) if len(starts) else []:
                lo, hi = int(run[0]), int(run[-1]) + size
                parts = _shingles(words[lo:hi], k)
                ones = np.vstack([np.zeros((1, 64), np.int64), np.cumsum(_bits(parts), axis=0, dtype=np.int64)])
                fps = _packed(ones[m:] - ones[:-m], m)
                for w, fp in enumerate(fps):
                    self._compare(size, int(fp), parts[w : w + m], lo + w, size, best)
        return [(i, at, n, s) for i, (s, at, n) in sorted(best.items())]

    def _compare(self, size: int, fp: int, parts: list[bytes], at: int, n: int, best: dict[int, tuple[float, int, int]]) -> None:
        """Look up one window's fingerprint among the items of ``size`` words, verify what is within the
        radius and keep the best window of each item."""
        near: set[int] = set()
        for b, (shift, mask) in enumerate(self.blocks):
            near.update(self.index.get((size, b, fp >> int(shift) & int(mask)), ()))
        near = {i for i in near if (self.prints[i] ^ fp).bit_count() <= self.radius}
        if near:
            bag = Counter(parts)
            for i in near:
                s = weighted_jaccard(bag, self.bags[i])
                if s >= self.similarity - 1e-12 and (i not in best or s > best[i][0]):
                    best[i] = (s, at, n)


def _item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    block, size = [], 0
    for r in items.select("item_id", text_bytes().alias("_text")).toLocalIterator():
        block.append((r[0], bytes(r[1])))
        size += len(r[1]) + 100
        if size > block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, similarity``: a row for each document of
    ``docs`` (``doc_id, text``) and item of ``items`` (``item_id, text``) that it holds, with
    its most similar window (the first of equals; words counted from 0)."""
    slim = docs.select("doc_id", text_bytes().alias("_text"))
    id_type, item_type = slim.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = (
        f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, "
        "first_word bigint, n_words bigint, similarity double"
    )

    def search(block: list[tuple[object, bytes]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Items(block, shingle, similarity, radius)
            for b in batches:
                found = [(i, *m) for i, x in enumerate(b.column(1)) for m in index.matches(x.as_py())]
                doc, item, at, size, s = zip(*found) if found else ((),) * 5
                out = pa.Table.from_arrays(
                    [
                        b.column(0).take(pa.array(doc, pa.int64())),
                        pa.array([index.ids[i] for i in item]),
                        pa.array(at, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(s, pa.float64()),
                    ],
                    names=["doc_id", "item_id", "first_word", "n_words", "similarity"],
                ) if found else None
                if out is not None:
                    yield from out.to_batches()

        return slim.mapInArrow(run, schema)

    found = None
    for block in _item_blocks(items, block_bytes):
        one = search(block)
        found = one if found is None else found.union(one)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns. A row is judged where its text
    is read, so no text moves and no verdict is joined."""

    def judge(block: list[tuple[object, bytes]]):
        def run(texts: pa.Array) -> pa.Array:
            index = Items(block, shingle, similarity, radius)
            return pa.array([not index.matches(x.as_py()) for x in texts], pa.bool_())

        return arrow_column(run, "boolean")

    rows = packed(docs, "text")
    for block in _item_blocks(items, block_bytes):
        rows = rows.withColumn("clean", judge(block)(text_bytes())).where("clean").drop("clean")
    return unpacked(rows, docs)


def q_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

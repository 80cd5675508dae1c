"""SimHash near-duplicate detection with Golay-code keys.

A document's fingerprint has 64 bits, split into segments of 22, 21 and 21.
Each segment is read as a word of the perfect binary Golay code [23, 12]: every
23-bit word is at most 3 bits from exactly one codeword, so a segment and its
neighbours at one bit decode to one or a few codeword indices (12 bits each).

Pigeonhole: of ``4`` differing bits, some pair of segments has at most 2. Two
such pairs meet in a word at one bit in all from each (errors 1+1: flip one
side's bit; 2+0: the word between), so both emit its pair of indices as a key.
Each fingerprint therefore has up to 11 keys per pair of segments, 33 in all,
and every two fingerprints within 4 bits share one. Fingerprints that share a
key are verified by their bit distance; only a spanning forest of the links of
a key's group leaves it, never all pairs. A key with more than ``HOT`` distinct
fingerprints is not compared as one group: its members get the 70 keys of 4 of
8 bytes (4 differing bits leave 4 bytes equal), which spread them again. A group that is large even
then is cut in its task by the bits that differ in it, again and again, so that the number of
comparisons does not grow with the square of its size.

Copies share one fingerprint and are one node. Components are found by
alternating large-star and small-star steps over the links.

Defined results: null or empty texts have no words, fingerprint zero, and are
linked like any other; texts with fewer words than a shingle are one shingle;
rows with null ids take part, and a component's id is its smallest id that is
not null; repeated rows are repeated; an empty table gives no rows; other
columns are ignored (``simhash_dedup`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import only, row_table, stored, table, text_bytes, unpacked

SHINGLE = 4
MAX_BITS = 4
SEED = 42
HOT = 1024
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
# Generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1 (fixed value).
GOLAY = 0xC75

_U = np.uint64


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one UTF-8 text: a bit is 1 if set in over half of the shingles' XXH64."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.r_[0, end[:-1] + 1]
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    bounds = zip(start[: len(words) - k + 1].tolist(), end[k - 1 :].tolist())
    h = np.array([digest(joined[a:b], SEED) for a, b in bounds], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more: str) -> DataFrame:
    """``doc_id``, ``fp``, the fingerprint as a signed 64-bit integer, and the columns ``more`` of ``docs``."""
    kept = docs.select("doc_id", *more).schema.fields
    slim = docs.select(text_bytes().alias("_text"), "doc_id", *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), shingle) for x in b.column(0)], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), *b.columns[1:]], names=["fp", "doc_id", *more])

    found = slim.mapInArrow(run, "fp bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept))
    return found.select("doc_id", "fp", *more)


class Golay:
    """Nearest-codeword indices of 23-bit words."""

    def __init__(self) -> None:
        one = []
        for i in range(23):
            r = 1 << i
            for b in range(i, 10, -1):
                if r >> b & 1:
                    r ^= GOLAY << (b - 11)
            one.append(r)
        word = np.arange(256, dtype=np.int64)
        bit = lambda w, i: (w >> i) & 1
        self.part = [
            np.bitwise_xor.reduce([bit(word, i) * (one[base + i] if base + i < 23 else 0) for i in range(8)])
            for base in (0, 8, 16)
        ]
        self.error = np.zeros(2048, np.int64)
        for weight in (1, 2, 3):
            for at in combinations(range(23), weight):
                s = 0
                for i in at:
                    s ^= one[i]
                self.error[s] = sum(1 << i for i in at)

    def index(self, word: np.ndarray) -> np.ndarray:
        s = self.part[0][word & 255] ^ self.part[1][(word >> 8) & 255] ^ self.part[2][word >> 16]
        return (word ^ self.error[s]) >> 11

    def near(self, word: np.ndarray, width: int) -> np.ndarray:
        """Indices of each word and of its neighbours at one of ``width`` bits, one row per
        word; repeats within a row are -1. The first column is the word's own index."""
        flips = np.r_[0, 1 << np.arange(width, dtype=np.int64)]
        ids = self.index(word[:, None] ^ flips[None, :])
        order = np.argsort(ids, axis=1, kind="stable")
        ranked = np.take_along_axis(ids, order, 1)
        again = np.zeros(ids.shape, bool)
        np.put_along_axis(again, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
        return np.where(again, -1, ids)


def golay_keys(fp: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """``(position of the fingerprint, key)`` of every key of every fingerprint (uint64)."""
    at, keys = [], []
    segs = [((fp >> _U(a)) & _U((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
    near = [code.near(s, w) for s, (_, w) in zip(segs, SEGMENTS)]
    for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        both = [(near[i], near[j][:, :1]), (near[i][:, :1], near[j][:, 1:])]
        for a, b in both:
            key = np.where((a >= 0) & (b >= 0), (p << 24) | (a << 12) | b, -1)
            row, col = np.nonzero(key >= 0)
            at.append(row)
            keys.append(key[row, col])
    return np.concatenate(at), np.concatenate(keys)


_FOURS = list(combinations(range(8), 4))


def byte_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the 70 choices of 4 of 8 bytes."""
    byte = fp.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
    at, keys = [], []
    for p, four in enumerate(_FOURS):
        key = np.full(len(fp), p, np.int64)
        for i in four:
            key = (key << 8) | byte[:, i]
        at.append(np.arange(len(fp)))
        keys.append(key)
    return np.concatenate(at), np.concatenate(keys)


#: A group with more fingerprints is cut again before its pairs are compared.
CUT = 4096


def _forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among distinct fingerprints of one group."""
    if len(fp) > CUT:
        return _cut_forest(fp, bits)
    links, rest = [], np.arange(len(fp))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            hit = np.bitwise_count(fp[rest] ^ fp[i]) <= bits
            if hit.any():
                found = rest[hit]
                links += [(i, j) for j in found]
                todo += found.tolist()
                rest = rest[~hit]
    return links


def _cut_forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """The same for a large group: of the bits that differ in it, cut into one part more than ``bits``, two close
    fingerprints have some part equal, so each part's runs of equal values are groups of their own, all smaller."""
    differ = int(np.bitwise_or.reduce(fp ^ fp[0]))
    places = [b for b in range(64) if differ >> b & 1]
    if len(places) <= bits:  # all are close
        return [(0, j) for j in range(1, len(fp))]
    links = []
    for part in np.array_split(places, bits + 1):
        value = fp & _U(sum(1 << int(b) for b in part))
        order = np.argsort(value, kind="stable")
        edge = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1], True])
        for g in np.flatnonzero(np.diff(edge) > 1):
            own = order[edge[g] : edge[g + 1]]
            links += [(int(own[i]), int(own[j])) for i, j in _forest(fp[own], bits)]
    return links


def _group_links(bits: int, hot: int | None):
    """Task function over rows ``key, fp`` sorted by both: the links of each key's group as
    ``a, b``; fingerprints of groups of more than ``hot`` come out as ``a = b``."""
    small = 8

    def done(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        if len(key):
            edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            size = np.diff(edge)
            mine = np.repeat(size, size)
            for s in range(1, small):
                i = np.flatnonzero((key[:-s] == key[s:]) & (mine[:-s] <= small)) if len(key) > s else []
                i = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= bits] if len(i) else np.empty(0, np.int64)
                a.append(fp[i])
                b.append(fp[i + s])
            for g in np.flatnonzero(size > small):
                own = fp[edge[g] : edge[g + 1]]
                if hot is not None and len(own) > hot:
                    a.append(own)
                    b.append(own)
                elif links := _forest(own, bits):
                    x = np.array(links)
                    a.append(own[x[:, 0]])
                    b.append(own[x[:, 1]])
        cat = lambda x: np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(cat(a)), pa.array(cat(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        over = None  # the key of a hot group that has begun to leave
        for batch in batches:
            key = np.r_[key, batch.column(0).to_numpy()]
            fp = np.r_[fp, batch.column(1).to_numpy().view(np.uint64)]
            if over is not None:
                n = int(np.searchsorted(key, over, "right"))
                if n:
                    x = pa.array(fp[:n].view(np.int64))
                    yield pa.RecordBatch.from_arrays([x, x], names=["a", "b"])
                    key, fp = key[n:], fp[n:]
                if len(key):
                    over = None
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], "left"))
            yield done(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
            if hot is not None and len(key) > hot:
                over, x = key[0], pa.array(fp.view(np.int64))
                yield pa.RecordBatch.from_arrays([x, x], names=["a", "b"])
                key, fp = key[:0], fp[:0]
        yield done(key, fp)

    return run


def _keyed(nodes: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay() if kind == "golay" else None
        for b in batches:
            every = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(every), 4096):
                fp = every[i : i + 4096]
                at, key = golay_keys(fp, code) if code else byte_keys(fp)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at].view(np.int64))], names=["key", "fp"])

    return nodes.select("fp").mapInArrow(run, "key bigint, fp bigint")


def fingerprint_links(nodes: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: links between distinct fingerprints (``nodes.fp``) at ``bits`` or fewer
    differing bits, enough of them to connect every two that a chain of links connects."""
    if bits > MAX_BITS:
        raise ValueError(f"the keys guarantee {MAX_BITS} bits at most")

    def linked(n: DataFrame, kind: str, hot: int | None) -> DataFrame:
        rows = _keyed(n, kind).repartition("key").sortWithinPartitions("key", "fp")
        return rows.mapInArrow(_group_links(bits, hot), "a bigint, b bigint")

    first = stored(linked(nodes, "golay", HOT), "simhash-links")
    hot = first.where("a = b").select(F.col("a").alias("fp")).distinct()
    more = stored(linked(hot, "bytes", None), "simhash-hot-links")
    return first.where("a <> b").union(more)


def star_components(links: DataFrame) -> DataFrame:
    """``node, root``: every node of ``a, b`` links with the smallest node of its component
    (the root itself has no row). Alternates large-star and small-star steps; each
    round is stored, so a lost executor costs one round at most."""
    hi, lo = F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")
    stars = stored(links.select(hi, lo).distinct(), "stars")

    def least(e: DataFrame) -> DataFrame:
        m = stored(e.groupBy("u").agg(F.min("v").alias("m")), "star-least")
        return e.join(m.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))

    state = None
    while True:
        both = stars.selectExpr("node AS u", "root AS v").union(stars.selectExpr("root AS u", "node AS v"))
        large = least(both).where("v > u").selectExpr("v AS u", "least(m, u) AS v").distinct()
        large = stored(large, "star-large")
        small = least(large)
        small = small.selectExpr("u AS node", "m AS root").union(small.where("v <> m").selectExpr("v", "m")).distinct()
        stars = stored(small, "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if now == state:
            return stars
        state = now


def _named_rows(docs: DataFrame, shingle: int, bits: int, *more: str) -> DataFrame:
    """The fingerprints of ``docs`` with ``root`` and ``component_id`` of their components."""
    fps = stored(fingerprints(docs, shingle, *more), "simhash-fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    stars = star_components(fingerprint_links(nodes, bits))
    placed = nodes.join(stars, nodes.fp == stars.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "simhash-placed")
    ids = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-ids")
    named = placed.join(ids.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"))
    named = stored(named.select(F.col("fp").alias("_fp"), "root", "component_id"), "simhash-named")
    return fps.join(named, fps.fp == named["_fp"]).drop("_fp")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs`` (``doc_id, text``)."""
    return _named_rows(docs, shingle, bits).select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component, with all columns: one with its smallest id.
    A row without an id stays only if its component has no id at all. The rows are written once and
    never shuffled; only their fingerprints and a bit for each of them are."""
    rows = row_table(docs, "simhash")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("least")
    named = _named_rows(rows.select("row.doc_id", "row.text", "at"), shingle, bits, "at")
    first = stored(named.groupBy("root").agg(least).select("least.at"), "simhash-first")
    return unpacked(only(rows, first), docs)


def q_simhash(spark, sf_dir):
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

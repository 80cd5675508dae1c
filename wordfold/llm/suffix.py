"""Suffix-array dedup of texts as bytes, with sampled splitters.

A byte goes if a 50-byte string over it also starts in a document with a
smaller id. Sorting every suffix would move many times the corpus, so only the
suffixes that can matter are sorted:

1. In every 50-byte window the 20-gram with the least hash is sampled (equal
   windows sample an equal one). Windows whose 20-gram is in one document only
   are done.
2. Sparse suffixes: the windows that share a sampled 20-gram start side by
   side; the first of them stands for all, as a suffix as long as them
   together. These suffixes are range-partitioned by their leading bytes at
   splitters sampled from the corpus, sorted in their bucket by a multikey
   quicksort (leading bytes, then a fingerprint of the whole suffix), and
   neighbours that are equal learn the smallest id.
3. Dense suffixes: where a 20-gram is in a smaller document but its sparse
   suffix is not, or where it is needed to compare with such a place, the
   suffixes at all its windows go through the same sort, as 50 bytes each.

Splitters lie between different sort keys, so equal suffixes always meet in one
bucket and no comparison crosses a boundary. A suffix that many documents hold is
sent once per block of documents.

Defined results: ids are integers (others are an error), and 2^63 - 1 counts as none;
null or empty texts have no bytes; documents without an id come
after all others and are never the smaller one of two; rows with one id are one
document in that none is smaller; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.blocks import Answers, Blocks, Docs, Keys, from_pressed, pressed
from wordfold.llm.common import BYTE_SYMBOLS, mix64, stretch_hashes, table, window_hashes

K = 20
WINDOW = 50
LEAD = 4
#: Samples for each splitter, and from each sampled block.
PER_SPLITTER, PER_BLOCK = 8, 512
#: Blocks whose 20-grams a bucket gathers: every block sends a message to every bucket, so the messages of a
#: corpus grow with its square divided by this.
BLOCKS_PER_BUCKET = 4
#: Dense suffixes in a bucket, about.
DENSE_PER_BUCKET = 1 << 21
#: Bytes of text that are hashed at once: what is held for each byte then stays in the processor's cache.
PIECE = 1 << 16

_U = np.uint64
#: Sampled 20-grams are compared by 48 bits: a collision only makes more suffixes candidates.
_GRAM = ~_U(0xFFFF)
#: The low bits of a hash give way to its place.
_PLACE = _U(0xFFFFF)
_FACTORS = mix64(np.arange(1, 64, dtype=np.uint64)) | _U(1)


class _Texts:
    """The texts of a block, one after the other: ``raw``, and where each starts and the last ends."""

    def __init__(self, docs: Docs) -> None:
        self.ids = np.array([d for d, _ in docs], np.int64)
        self.raw = np.frombuffer(b"".join(x for _, x in docs), np.uint8)
        self.start = np.cumsum([0, *(len(x) for _, x in docs)], dtype=np.int64)

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, place, "right") - 1

    def pieces(self) -> list[tuple[int, int]]:
        """First and end of runs of texts of about ``PIECE`` bytes, or of one longer text."""
        out, lo, start = [], 0, self.start.tolist()
        for hi in range(1, len(start)):
            if hi + 1 == len(start) or start[hi + 1] - start[lo] > PIECE:
                out.append((lo, hi))
                lo = hi
        return out

    def words(self, kind: str, size: int) -> np.ndarray:
        """The ``size`` bytes from each place on, as a number."""
        return np.ndarray((max(0, len(self.raw) - size + 1),), kind, self.raw, 0, (1,))


def _gram_hashes(words: np.ndarray, raw: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``k`` bytes from each place on, or from the places ``at``: the bytes as scrambled 8-byte
    words (the last may overlap), added up with a factor for each."""
    n = max(0, len(raw) - k + 1)
    if k < 8:
        h = window_hashes(BYTE_SYMBOLS[raw], k)
        return h if at is None else h[at]
    part = mix64(words.astype(np.uint64)) if at is None else None
    h = np.zeros(n if at is None else len(at), np.uint64)
    for factor, off in zip(_FACTORS, [*range(0, k - 8, 8), k - 8]):
        h += (part[off : off + n] if at is None else mix64(words[at + off].astype(np.uint64))) * factor
    return h


class _Grams:
    """Sampled 20-grams of a block's documents: ``place``, and the windows from ``first`` to before
    ``stop`` that sample it, all as places in the joined texts."""

    def __init__(self, texts: _Texts, place: np.ndarray, first: np.ndarray, stop: np.ndarray) -> None:
        self.texts, self.place, self.first, self.stop = texts, place, first, stop

    @property
    def id(self) -> np.ndarray:
        return self.texts.ids[self.texts.doc(self.first)]

    def at(self, which: np.ndarray) -> _Grams:
        return _Grams(self.texts, self.place[which], self.first[which], self.stop[which])

    def keys(self, k: int) -> np.ndarray:
        return _key(_gram_hashes(self.texts.words("<u8", 8), self.texts.raw, k, self.place))

    def packed(self, flag: np.ndarray) -> bytes:
        """With a flag for each, to be kept for later steps."""
        gap = self.first - np.r_[0, self.stop[:-1]] if len(self.first) else self.first
        columns = [pressed(x.view(np.uint64)) for x in (gap, self.stop - self.first, self.place - self.stop + 1)]
        return struct.pack("<q", len(self.first)) + b"".join(columns) + np.packbits(flag).tobytes()

    @classmethod
    def unpacked(cls, texts: _Texts, data: bytes) -> tuple[_Grams, np.ndarray]:
        (n,), at, columns = struct.unpack_from("<q", data), 8, []
        for _ in range(3):
            column, at = from_pressed(data, at, n)
            columns.append(column.view(np.int64))
        gap, size, after = columns
        stop = np.cumsum(gap + size)
        flag = np.unpackbits(np.frombuffer(data, np.uint8, offset=at), count=n).astype(bool)
        return cls(texts, stop - 1 + after, stop - size, stop), flag


def _key(hashes: np.ndarray) -> np.ndarray:
    """Scrambled again, as the least hashes of windows are small: buckets are cut evenly."""
    return mix64(hashes) & _GRAM


def _sampled(texts: _Texts, k: int, window: int) -> tuple[_Grams, np.ndarray]:
    """The sampled 20-grams, and the key of each. The 20-gram of a window is one with the least hash of those in it; which
    one of equal ones does not matter, as equal ones have equal keys."""
    w, words, found = window - k + 1, texts.words("<u8", 8), [[], [], [], []]
    for lo, hi in texts.pieces():
        start = texts.start[lo : hi + 1] - texts.start[lo]
        a, z = int(texts.start[lo]), int(texts.start[hi])
        # windows at places from begin to before end are in one text
        begin, end = start[:-1], start[1:] - window + 1
        real = end > begin
        if not real.any():
            continue
        h = _gram_hashes(words[a : max(a, z - 7)], texts.raw[a:z], k)
        place = np.arange(len(h), dtype=np.uint64)
        cur = (h & ~_PLACE) | (_PLACE - (place & _PLACE))
        width = 1
        while width * 2 <= w:
            cur, width = np.minimum(cur[:-width], cur[width:]), width * 2
        if width < w:
            cur = np.minimum(cur[: len(h) - w + 1], cur[w - width : len(h) - width + 1])
        new = np.ones(len(cur), bool)
        np.not_equal(cur[1:], cur[:-1], out=new[1:])
        new[begin[real]] = True
        new[end[real & (end < len(cur))]] = True
        first = np.flatnonzero(new)
        stop = np.r_[first[1:], len(cur)]
        inside = first < end[np.searchsorted(start, first, "right") - 1]
        first, stop = first[inside], stop[inside]
        low = (_PLACE - (cur[first] & _PLACE)).astype(np.int64)
        at = first + ((low - first) & int(_PLACE))
        for x, y in zip(found, (at + a, first + a, stop + a, _key(h[at]))):
            x.append(y)
    place, first, stop, key = (np.concatenate(x) if x else np.empty(0, t) for x, t in zip(found, [np.int64] * 3 + [np.uint64]))
    return _Grams(texts, place, first, stop), key


def _suffixes(texts: _Texts, start: np.ndarray, stop: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of the suffixes that cover the windows from ``start`` (in order) to before ``stop``:
    their leading bytes, and a fingerprint of all their bytes."""
    mark = np.empty(len(start), np.uint64)
    pieces = texts.pieces()
    cuts = np.searchsorted(start, [int(texts.start[lo]) for lo, _ in pieces] + [len(texts.raw)])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if lo == hi:
            continue
        s, e = start[lo:hi], stop[lo:hi] + window - 1
        a, z = int(s[0]), int(e.max())
        mark[lo:hi] = stretch_hashes(np.take(BYTE_SYMBOLS, texts.raw[a:z]), s - a, e - a)
    lead = texts.words(">u4", LEAD)[start].astype(np.uint64)
    return (lead << _U(32)) | (mark >> _U(32)), mark & _U(0xFFFFFFFF)


def _sparse_keys(g: _Grams, window: int) -> Keys:
    a, b = _suffixes(g.texts, g.first, g.stop, window)
    return Keys(a, g.id, b, "min")


def _dense(g: _Grams, window: int) -> tuple[np.ndarray, Keys]:
    """``(start, keys)`` of every window of ``g``."""
    size = g.stop - g.first
    start = np.repeat(g.first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    a, b = _suffixes(g.texts, start, start + 1, window)
    return start, Keys(a, np.repeat(g.id, size), b, "min")


def sampled_suffixes(blocks: Blocks, k: int, window: int) -> np.ndarray:
    """The leading bytes of sampled blocks' suffixes, sorted."""
    n_blocks = blocks.table.select("block").distinct().count()
    every = max(1, min(n_blocks // 8, n_blocks * PER_BLOCK // (blocks.n_buckets * PER_SPLITTER)))

    def some(rows: pa.Table) -> pa.Table:
        g, _ = _sampled(_Texts([(0, x) for x in rows.column("text").to_pylist()]), k, window)
        g = g.at(np.arange(0, len(g.first), max(1, len(g.first) // PER_BLOCK)))
        a, _ = _suffixes(g.texts, g.first, g.stop, window)
        return pa.table({"first": pa.array(a.view(np.int64))})

    sampled = blocks.table.where(F.pmod(F.xxhash64("block"), F.lit(every)) == 0)
    # at most PER_BLOCK values from each sampled block: about PER_SPLITTER for each bucket
    got = sampled.groupBy("block").applyInArrow(some, "first bigint").toPandas()["first"].to_numpy().view(np.uint64)
    return np.sort(got)


def sampled_splitters(got: np.ndarray, buckets: int, even: np.ndarray) -> np.ndarray:
    """Splitters of the range partition, from the leading bytes of sampled suffixes."""
    if not len(got):
        return even
    return np.unique(got[np.arange(1, buckets) * len(got) // buckets])


def suffix_dedup(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of ``docs`` (``doc_id, text``): each
    byte is removed that lies in a string of ``window`` bytes which also starts in a document with a
    smaller id. ``kept`` is what is left, as bytes."""
    blocks = Blocks(docs, "suffix", integer_ids=True, per_bucket=BLOCKS_PER_BUCKET)
    even = blocks.splitters
    leads = sampled_suffixes(blocks, k, window)
    split = sampled_splitters(leads, blocks.n_buckets, even)

    def grams(docs_: Docs, told: Answers, rows: pa.Table) -> Keys:
        g, key = _sampled(_Texts(docs_), k, window)
        return Keys(key, g.id, None, "min")

    def sparse(docs_: Docs, told: Answers, rows: pa.Table) -> tuple[Keys, bytes, int]:
        """Places whose 20-gram is in several documents, flagged where one of them is smaller."""
        g, key = _sampled(_Texts(docs_), k, window)
        keys = Keys(key, g.id, None, "min")
        many, least = told.least("gram", keys, even)
        which = np.flatnonzero(many[keys.group])
        g, least = g.at(which), least[keys.group][which]
        return _sparse_keys(g, window), g.packed(least < g.id), 0

    def needed(docs_: Docs, told: Answers, rows: pa.Table) -> tuple[Keys, bytes, int]:
        """Of those, flagged: places whose sparse suffix starts in a smaller document. The 20-grams of
        the others: 0 for one that a smaller document has, 1 where none has."""
        g, smaller = _Grams.unpacked(_Texts(docs_), told.rows("sparse-state")[0])
        keys = _sparse_keys(g, window)
        _, least = told.least("sparse", keys, split)
        done = least[keys.group] < g.id
        still = g.at(np.flatnonzero(~done))
        return Keys(still.keys(k), np.where(smaller[~done], 0, 1), None, "min"), np.packbits(done).tobytes(), int((still.stop - still.first).sum())

    def dense(docs_: Docs, told: Answers, rows: pa.Table) -> tuple[Keys, bytes, int]:
        """The settled places, and (flagged) those to compare window by window."""
        g, smaller = _Grams.unpacked(_Texts(docs_), told.rows("sparse-state")[0])
        done = np.unpackbits(np.frombuffer(told.rows("needed-state")[0], np.uint8), count=len(smaller)).astype(bool)
        still = np.flatnonzero(~done)
        keys = Keys(g.at(still).keys(k), np.where(smaller[still], 0, 1), None, "min")
        # a 20-gram without both kinds of places is needed nowhere: no document waits for it
        many, _ = told.least("needed", keys, even)
        wait = np.zeros(len(done), bool)
        wait[still[many[keys.group]]] = True
        g, wait = g.at(np.flatnonzero(done | wait)), wait[done | wait]
        return _dense(g.at(np.flatnonzero(wait)), window)[1], g.packed(wait), 0

    blocks.ask("gram", grams)
    blocks.ask("sparse", sparse, split, two=True, kinds=["gram"])
    blocks.ask("needed", needed, kinds=["sparse", "sparse-state"])
    # suffixes at all windows can be many times those of the 20-grams
    fine = sampled_splitters(leads, max(blocks.n_buckets, blocks.state_total("needed") // DENSE_PER_BUCKET), even)
    blocks.ask("dense", dense, fine, two=True, kinds=["sparse-state", "needed", "needed-state"])
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def remove(d: Docs, answers: Answers, rows: pa.Table) -> pa.Table:
        texts = _Texts(d)
        g, wait = _Grams.unpacked(texts, answers.rows("dense-state")[0])
        covered = g.at(np.flatnonzero(~wait))
        start, keys = _dense(g.at(np.flatnonzero(wait)), window)
        _, least = answers.least("dense", keys, fine)
        hit = start[least[keys.group] < texts.ids[texts.doc(start)]]
        begin, end = np.r_[covered.first, hit], np.r_[covered.stop, hit + 1] + window - 1
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], np.maximum.accumulate(end[order])
        # stretches that overlap or touch are one span, but not across texts
        doc = texts.doc(begin)
        new = np.ones(len(begin), bool)
        new[1:] = (begin[1:] > end[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        begin, doc = begin[first], doc[first]
        end = end[np.r_[first[1:], len(end)] - 1] if len(first) else begin
        of = np.searchsorted(doc, np.arange(len(d) + 1)).tolist()
        out = []
        for i, (_, data) in enumerate(d):
            lo, hi = of[i], of[i + 1]
            kept = data
            if lo < hi:
                a, z = (begin[lo:hi] - texts.start[i]).tolist(), (end[lo:hi] - texts.start[i]).tolist()
                kept = b"".join(data[x:y] for x, y in zip([0, *z], [*a, len(data)]))
            out.append((len(data), len(data) - len(kept), hi - lo, hashlib.sha256(kept).hexdigest(), kept))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        cols = {n: pa.array([x[j] for x in out], t) for j, (n, t) in enumerate(zip(names, types))}
        return pa.table({"doc_id": rows.column("doc_id")} | cols)

    schema = f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return blocks.step(remove, schema, kinds=["dense", "dense-state"])


def q_suffix(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")

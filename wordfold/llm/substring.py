"""Substring dedup by De Bruijn compaction of token k-mers.

Words become 64-bit symbols. Of the k-mers (16 words) in each window of 50
words, the one with the least hash is sampled, so equal windows anywhere sample
an equal k-mer. Sampled k-mers that occur in two or more documents are the
nodes of the graph; two that follow each other in a document are joined by
an edge, which stands for the words from the one's start to the other's end.

An edge that every occurrence of both its nodes runs through is not branching.
Paths of such edges are compacted by pointer doubling in Spark joins; all
occurrences of a path are equal from its first to its last word, and its source
is the place in the document with the smallest id. A window inside a path
follows from that document's id. The other windows with a repeated k-mer (at the
ends of repeated spans, where the graph branches, and those of the sources
themselves) are looked up by a hash of their own 50 words.

Up to here equality is that of 64-bit hashes, so what is found are claims: a
document claims that a stretch of its words stands in a source, the document with the smallest id. The
claims are then verified word by word: stretches, with their coordinates, are joined with the
repeated stretches of the sources, and only what a source really holds is removed, at these coordinates.
Where only parts of a stretch are in one piece of the source, its windows are looked for one by one.

Defined results: ids are integers (others are an error), and 2^63 - 1 counts as none;
null or empty texts have no words; documents without an id come
after all others and are never the smaller one of two; rows with one id are one
document in that none is smaller; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.blocks import ANSWERS, Answers, Blocks, Docs, Keys
from wordfold.llm.common import stored, stretch_hashes, table, window_anchors, window_hashes, word_symbols

K = 16
WINDOW = 50


class _Sampled:
    """The sampled k-mers of a block's documents, document after document."""

    def __init__(self, docs: Docs, k: int, window: int) -> None:
        self.k, self.window = k, window
        at, key, first, stop, doc = [], [], [], [], []
        self.symbols: dict[int, np.ndarray] = {}
        for i, (_, data) in enumerate(docs):
            sym = word_symbols(data)
            if len(sym) < window:
                continue
            h = window_hashes(sym, k)
            a, s, e = window_anchors(h, window - k + 1)
            self.symbols[i] = sym
            at.append(a)
            key.append(h[a])
            first.append(s)
            stop.append(e)
            doc.append(np.full(len(a), i, np.int64))
        cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        self.at, self.key, self.first, self.stop = cat(at, np.int64), cat(key, np.uint64), cat(first, np.int64), cat(stop, np.int64)
        self.doc = cat(doc, np.int64)
        ids = np.array([d for d, _ in docs], np.int64)
        self.id = ids[self.doc] if len(self.doc) else np.empty(0, np.int64)

    def per_document(self, place: np.ndarray):
        """The runs of ``place`` (sorted) that are in one document, with its symbols."""
        doc = self.doc[place]
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(doc)]):
            if lo < hi:
                yield lo, hi, self.symbols[int(doc[lo])]

    def edges(self, place: np.ndarray) -> np.ndarray:
        """Hash of the words from the start of each sampled k-mer ``place`` to the next one's end."""
        out = np.empty(len(place), np.uint64)
        for lo, hi, sym in self.per_document(place):
            out[lo:hi] = stretch_hashes(sym, self.at[place[lo:hi]], self.at[place[lo:hi] + 1] + self.k)
        return out

    def hashes(self, place: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Hash of the window at each ``start`` in the document of the sampled k-mer ``place``."""
        out = np.empty(len(place), np.uint64)
        for lo, hi, sym in self.per_document(place):
            out[lo:hi] = window_hashes(sym, self.window)[start[lo:hi]]
        return out

    def asked(self) -> Keys:
        return Keys(self.key, self.id, None, "min")


def _known(s: _Sampled, answers: Answers, splitters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each sampled k-mer: whether it is a node, and the smallest id that has it."""
    keys = s.asked()
    many, least = answers.least("kmer", keys, splitters)
    return many[keys.group], least[keys.group]


def _linked(s: _Sampled, node: np.ndarray) -> np.ndarray:
    """Places whose k-mer and the next are nodes of one document."""
    both = np.zeros(len(node), bool)
    both[:-1] = node[:-1] & node[1:] & (s.doc[:-1] == s.doc[1:])
    return both


def _inside(s: _Sampled, node: np.ndarray, path: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the path stretch around each sampled k-mer. ``path``: the next k-mer
    follows on the same path."""
    n = len(path)
    on = path & _linked(s, node)
    head = np.ones(n, bool)
    head[1:] = ~on[:-1]
    begin = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    last = n - 1 - np.maximum.accumulate(np.where(~on[::-1], np.arange(n), 0))[::-1]
    return s.at[begin], s.at[last] + k


def _windows(s: _Sampled, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(document, start)`` of every window of the sampled k-mers ``which``, and that k-mer's place."""
    size = (s.stop - s.first)[which]
    place = np.repeat(which, size)
    start = s.first[place] + np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
    return place, start


def _checked(s: _Sampled, answers: Answers, splitters: np.ndarray, k: int, window: int):
    """Of every window of a node: the k-mer's place, the start, whether it follows from its path, and whether
    it may be the source of others by it; and the smallest id that has the k-mer."""
    node, least = _known(s, answers, splitters)
    paths = [np.frombuffer(p, np.uint64) for p in answers.rows("path")]
    on_path = np.isin(s.key, np.concatenate(paths)) if paths else np.zeros(len(s.key), bool)
    lo, hi = _inside(s, node, on_path, k)
    place, start = _windows(s, np.flatnonzero(node))
    inside = (lo[place] <= start) & (start + window <= hi[place])
    smaller = least[place] < s.id[place]
    return place, start, inside & smaller, inside & ~smaller, least[place]


def _runs(doc: np.ndarray, start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First windows of the runs of consecutive ones (in order of ``doc, start``) and the runs' sizes."""
    new = np.ones(len(doc), bool)
    if len(doc):
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
        for x in same:
            new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.diff(np.r_[first, len(doc)])


_CLAIM = "target boolean, id bigint, block bigint, doc bigint, start bigint, n bigint, text binary"


def verified_claims(claims: DataFrame, window: int) -> DataFrame:
    """``block, doc, start, n`` of the windows (``n`` from ``start`` on) that a source holds. ``claims`` is a stored
    table of stretches: those of documents (``target``) and of sources, as words with a space around each."""
    mine = claims.where("target").select("id", "block", "doc", "start", "n", "text")
    of = claims.where("NOT target").select(F.col("id").alias("_id"), F.col("text").alias("_source"))
    whole = mine.join(of, F.col("id") == F.col("_id")).where(F.contains("_source", "text"))
    whole = stored(whole.select("block", "doc", "start", "n").distinct(), "substring-whole")
    names = ("block", "doc", "start")
    told = whole.select(*[F.col(c).alias(f"_{c}") for c in names])
    on = [F.col(c) == F.col(f"_{c}") for c in names]
    rest = mine.join(told, on[0] & on[1] & on[2], "left_anti")
    words = "split(trim(CAST(text AS STRING)), ' ')"
    single = f"transform(sequence(0L, n - 1), i -> struct(start + i AS start, CAST(concat(' ', array_join(slice({words}, CAST(i AS INT) + 1, {window}), ' '), ' ') AS BINARY) AS text))"
    each = rest.select("id", "block", "doc", F.explode(F.expr(single)).alias("w")).select("id", "block", "doc", "w.start", "w.text")
    found = each.join(of, F.col("id") == F.col("_id")).where(F.contains("_source", "text"))
    return whole.unionByName(found.select("block", "doc", "start", F.lit(1).cast("bigint").alias("n")).distinct())


def compact_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``k, path``: nodes with a non-branching edge to the next node, and the first node of their
    path (null on a circle). ``edges``: ``e, a, b, n``; ``nodes``: ``k, n``."""
    na, nb = (nodes.select(F.col("k").alias(f"_{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    single = edges.join(na, F.col("a") == F.col("_a")).join(nb, F.col("b") == F.col("_b"))
    single = stored(single.where("n = na AND n = nb AND a <> b").select("a", "b"), "paths-single")
    # back pointers, doubled until they all rest on a path's first node
    back = single.select(F.col("b").alias("k"), F.col("a").alias("up"))
    n = single.count()
    rounds = 0
    while n and (1 << rounds) <= n:
        back = stored(back, "paths-back")
        up = back.select(F.col("k").alias("_k"), F.col("up").alias("_up"))
        joined = back.join(up, F.col("up") == F.col("_k"), "left")
        if joined.where("_up IS NOT NULL").limit(1).count() == 0:
            break
        back = joined.select("k", F.coalesce("_up", "up").alias("up"))
        rounds += 1
    back = stored(back.select(F.col("k").alias("_k"), "up"), "paths-heads")
    rest = single.select(F.col("b").alias("_b"))
    heads = back.join(rest, F.col("up") == F.col("_b"), "left_anti")
    found = single.join(heads, F.col("a") == F.col("_k"), "left")
    first = single.join(rest, F.col("a") == F.col("_b"), "left_anti").select(F.col("a").alias("_f"))
    return found.join(first, F.col("a") == F.col("_f"), "left").select(
        F.col("a").alias("k"), F.coalesce("up", "_f").alias("path")
    )


def substring_dedup(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` of ``docs`` (``doc_id, text``): each word is
    removed that lies in a run of ``window`` words which also starts in a document with a smaller
    id. ``kept`` is what is left, its words joined by one space."""
    blocks = Blocks(docs, "substring", integer_ids=True)
    split = blocks.splitters
    blocks.ask("kmer", lambda d, _, rows: _Sampled(d, k, window).asked())

    def graph(d: Docs, answers: Answers, rows: pa.Table) -> pa.Table:
        s = _Sampled(d, k, window)
        node, _ = _known(s, answers, split)
        link = np.flatnonzero(_linked(s, node))
        e, edge_at, edge_n = np.unique(s.edges(link), return_index=True, return_counts=True)
        v, node_n = np.unique(s.key[node], return_counts=True)
        a, b = s.key[link[edge_at]], s.key[link[edge_at] + 1]
        block = rows.column("block")[0].as_py()
        none = pa.nulls(len(v), pa.int64())
        signed = lambda x: pa.array(x.view(np.int64))
        return pa.table(
            {
                "block": pa.array([block] * (len(e) + len(v)), pa.int64()),
                "e": pa.concat_arrays([signed(e), none]),
                "a": pa.concat_arrays([signed(a), signed(v)]),
                "b": pa.concat_arrays([signed(b), none]),
                "n": pa.array(np.r_[edge_n, node_n], pa.int64()),
            }
        )

    parts = stored(blocks.step(graph, "block bigint, e bigint, a bigint, b bigint, n bigint"), "substring-graph")
    edges = parts.where("e IS NOT NULL").groupBy("e", "a", "b").agg(F.sum("n").alias("n"))
    held = parts.where("e IS NULL").select("block", F.col("a").alias("k"), "n")
    nodes = held.groupBy("k").agg(F.sum("n").alias("n"))
    paths = stored(compact_paths(stored(edges, "substring-edges"), stored(nodes, "substring-nodes")), "substring-paths")
    # back to the blocks that hold the nodes
    on = held.select("block", "k").join(paths.where("path IS NOT NULL").select(F.col("k").alias("_k")), F.col("k") == F.col("_k"))

    def packed(rows: pa.Table) -> pa.Table:
        keys = rows.column("k").to_numpy().view(np.uint64)
        return pa.table(
            {
                "block": rows.column("block").slice(0, 1),
                "kind": pa.array(["path"], pa.string()),
                "bucket": pa.array([0], pa.int64()),
                "payload": pa.array([keys.tobytes()], pa.binary()),
            }
        )

    blocks.learn(stored(on.select("block", "k").groupBy("block").applyInArrow(packed, ANSWERS), "substring-path"))

    def verify(d: Docs, answers: Answers, rows: pa.Table) -> Keys:
        s = _Sampled(d, k, window)
        place, start, gone, _, _ = _checked(s, answers, split, k, window)
        return Keys(s.hashes(place[~gone], start[~gone]), s.id[place[~gone]], None, "min")

    blocks.ask("window", verify)

    def claim(d: Docs, answers: Answers, rows: pa.Table) -> pa.Table:
        s = _Sampled(d, k, window)
        place, start, gone, source, least = _checked(s, answers, split, k, window)
        other = np.flatnonzero(~gone)
        keys = Keys(s.hashes(place[other], start[other]), s.id[place[other]], None, "min")
        many, seen = answers.least("window", keys, split)
        many, seen = many[keys.group], seen[keys.group]
        hit = seen < s.id[place[other]]
        gone[other[hit]], least[other[hit]] = True, seen[hit]
        source[other[many & ~hit]] = True
        order = np.lexsort((start, s.doc[place]))
        doc, start, gone, source, least = s.doc[place][order], start[order], gone[order], source[order], least[order]
        block, out = rows.column("block")[0].as_py(), []
        words: dict[int, list[bytes]] = {}

        def stretch(i: int, first: int, n: int) -> bytes:
            if i not in words:
                words.clear()
                words[i] = d[i][1].split()
            return b" " + b" ".join(words[i][first : first + n - 1 + window]) + b" "

        first, n = _runs(doc[gone], start[gone], least[gone])
        for i, at, size, of in zip(doc[gone][first].tolist(), start[gone][first].tolist(), n.tolist(), least[gone][first].tolist()):
            out.append((True, of, block, i, at, size, stretch(i, at, size)))
        first, n = _runs(doc[source], start[source])
        parts: dict[int, list[bytes]] = {}
        for i, at, size in zip(doc[source][first].tolist(), start[source][first].tolist(), n.tolist()):
            parts.setdefault(i, []).append(stretch(i, at, size))
        out += [(False, d[i][0], block, i, 0, 0, b"\n".join(p)) for i, p in parts.items()]
        types = [pa.bool_(), *[pa.int64()] * 5, pa.binary()]
        names = ["target", "id", "block", "doc", "start", "n", "text"]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    claims = stored(blocks.step(claim, _CLAIM), "substring-claims")

    def held(rows: pa.Table) -> pa.Table:
        payload = np.concatenate([rows.column(c).to_numpy() for c in ("doc", "start", "n")]).astype(np.int64)
        return pa.table(
            {
                "block": rows.column("block").slice(0, 1),
                "kind": pa.array(["verified"], pa.string()),
                "bucket": pa.array([0], pa.int64()),
                "payload": pa.array([payload.tobytes()], pa.binary()),
            }
        )

    blocks.learn(stored(verified_claims(claims, window).groupBy("block").applyInArrow(held, ANSWERS), "substring-verified"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def remove(d: Docs, answers: Answers, rows: pa.Table) -> pa.Table:
        told = [np.frombuffer(p, np.int64).reshape(3, -1) for p in answers.rows("verified")]
        doc, begin, size = np.concatenate(told, axis=1) if told else np.empty((3, 0), np.int64)
        order = np.argsort(doc, kind="stable")
        doc, begin, end = doc[order], begin[order], (begin + size - 1 + window)[order]
        out = []
        for i, (_, data) in enumerate(d):
            lo, hi = np.searchsorted(doc, [i, i + 1])
            words = data.split()
            if lo == hi:
                kept, removed = words, 0
            else:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, begin[lo:hi], 1)
                np.add.at(edge, end[lo:hi], -1)
                covered = np.cumsum(edge[:-1]) > 0
                kept, removed = [words[j] for j in np.flatnonzero(~covered)], int(covered.sum())
            text = b" ".join(kept)
            out.append((len(words), removed, hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace")))
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "n_words": pa.array([x[0] for x in out], pa.int64()),
                "n_removed": pa.array([x[1] for x in out], pa.int64()),
                "kept_sha256": pa.array([x[2] for x in out], pa.string()),
                "kept": pa.array([x[3] for x in out], pa.string()),
            }
        )

    return blocks.step(remove, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept string", ["verified"])


def q_substring(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept")

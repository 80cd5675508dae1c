"""Corpus-wide questions about keys that tasks find in blocks of documents.

Some operators look up, for every place in every text, something that all
documents decide together (the smallest document with the same words, a total
count). Sending a row per place would move many times the corpus. Instead:

* ``Blocks`` writes the texts once, in blocks of at most ``BLOCK_ROWS`` documents and, but for a single
  longer one, at most ``BLOCK_BYTES`` of text, as a table bucketed by block, so that no later step shuffles a
  text again.
* ``ask`` lets each block send its distinct keys, with one value each, packed by
  bucket of key; a bucket's task combines the values of equal keys, and
  answers each block in the order of the block's own keys.
* The next step reads the block's text again together with all answers so far,
  finds the same keys again and has their values.

A key that a third of all documents hold is one entry per block, not one per
document. Answers are stored, so a lost executor repeats its own tasks only.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from wordfold.llm.common import stored, text_bytes
from wordfold.session import new_output_path

#: Documents and bytes of text in a block, at most. A task holds one block at a time, and several
#: 8-byte values for each of its bytes.
BLOCK_ROWS = 2048
BLOCK_BYTES = 8 << 20
#: Blocks whose keys a bucket gathers, about, where an operator does not say otherwise.
BLOCKS_PER_BUCKET = 1
#: A document without an id comes after all others.
NO_ID = 2**63 - 1

ANSWERS = "block bigint, kind string, bucket bigint, payload binary"


def _cut_blocks(batches):
    """``rid, doc_id, text`` with ``block``: the number of the block's first row."""
    block, rows, held = None, 0, 0
    for b in batches:
        blocks = []
        for rid, size in zip(b.column(0).to_pylist(), pc.binary_length(b.column(2)).to_pylist()):
            if block is None or rows == BLOCK_ROWS or held + size > BLOCK_BYTES:
                block, rows, held = rid, 0, 0
            rows, held = rows + 1, held + size
            blocks.append(block)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *b.columns], names=["block", "rid", "doc_id", "text"])


#: Planes of fewer bytes are left to the codec of the shuffle, which sees those of many messages at once.
_PRESSED = 512


def pressed(values: np.ndarray) -> bytes:
    """64-bit values by byte place: planes of zeros are left out, and each other one is compressed by itself, if
    that makes it smaller, so that a plane of few different bytes is coded by how often they occur."""
    used, small, parts = 0, 0, []
    for i, plane in enumerate(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)):
        if not plane.any():
            continue
        used |= 1 << i
        raw = plane.tobytes()
        if len(raw) >= _PRESSED and len(z := pa.compress(raw, codec="zstd", asbytes=True)) + 4 < len(raw):
            small |= 1 << i
            parts.append(struct.pack("<I", len(z)))
            raw = z
        parts.append(raw)
    return bytes([used, small]) + b"".join(parts)


def from_pressed(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """The ``n`` values that ``pressed`` packed at ``at``, and where they end."""
    out = np.zeros((n, 8), np.uint8)
    used, small = data[at], data[at + 1]
    at += 2
    for i in range(8):
        if not used >> i & 1:
            continue
        if small >> i & 1:
            (size,) = struct.unpack_from("<I", data, at)
            at += 4
            raw = pa.decompress(data[at : at + size], decompressed_size=n, codec="zstd", asbytes=True)
            at += size
        else:
            raw = data[at : at + n]
            at += n
        out[:, i] = np.frombuffer(raw, np.uint8)
    return out.view(np.uint64).ravel(), at


def used_planes(columns: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Columns of 64-bit values by byte place, a row for each place that is not zero everywhere, and bits that tell which."""
    rows, used = [], 0
    for i, column in enumerate(columns):
        # eight byte places a column
        for j, plane in enumerate(column.view(np.uint8).reshape(-1, 8).T):
            if plane.any():
                used |= 1 << (8 * i + j)
                rows.append(plane)
    return np.stack(rows) if rows else np.empty((0, len(columns[0])), np.uint8), used


def from_used_planes(parts: list[tuple[bytes, int, int, int]], columns: int) -> list[np.ndarray]:
    """The columns of several ``used_planes`` one after the other, each given as data, offset, number of values and bits."""
    total, at = sum(n for _, _, n, _ in parts), 0
    out = np.zeros((8 * columns, total), np.uint8)
    places: dict[int, list[int]] = {}
    for data, offset, n, used in parts:
        if used not in places:
            places[used] = [i for i in range(8 * columns) if used >> i & 1]
        rows = places[used]
        out[rows, at : at + n] = np.frombuffer(data, np.uint8, n * len(rows), offset).reshape(len(rows), n)
        at += n
    return [np.ascontiguousarray(out[8 * i : 8 * i + 8].T).view(np.uint64).ravel() for i in range(columns)]


class Keys:
    """Distinct sorted keys of a block with one value each.

    A key is one or two 64-bit words (``second`` breaks ties of ``first``). Under ``min``
    the value is the smallest and ``many`` says if there are different ones; under
    ``sum`` values are added, or left out (None) where only ``group`` is needed: the number of each given key
    among the distinct ones.
    """

    def __init__(self, first: np.ndarray, values: np.ndarray | None, second: np.ndarray | None, how: str) -> None:
        # the order of equal keys matters neither to their sum nor to the smallest value
        order = multikey_order(first, second)
        a, v = first[order], None if values is None else values[order]
        b = None if second is None else second[order]
        new = np.ones(len(a), bool)
        if len(a):
            new[1:] = a[1:] != a[:-1]
            if b is not None:
                new[1:] |= b[1:] != b[:-1]
        start = np.flatnonzero(new)
        self.first, self.second, self.how = a[start], None if b is None else b[start], how
        self.group = np.empty(len(a), np.int64)
        self.group[order] = np.cumsum(new) - 1
        if how == "sum":
            self.values = np.add.reduceat(v, start) if len(a) and v is not None else v
            self.many = np.zeros(len(start), bool)
        else:
            self.values = np.minimum.reduceat(v, start) if len(a) else v
            self.many = self.values != np.maximum.reduceat(v, start) if len(a) else np.zeros(0, bool)

    def buckets(self, splitters: np.ndarray) -> np.ndarray:
        """Where the keys of each bucket begin, and where the last ones end."""
        return np.r_[0, np.searchsorted(self.first, splitters), len(self.first)]


def key_order(keys: np.ndarray) -> np.ndarray:
    """Order by key. Values are sorted faster than places, so each key is sorted with its place in its low
    bits; if there is no room for all of a key and keys that differ only in what was cut lie in the wrong order, places are sorted."""
    n = len(keys)
    if n < 2:
        return np.arange(n)
    low, place = keys.min(), (n - 1).bit_length()
    cut = max(0, int(keys.max() - low).bit_length() + place - 64)
    both = keys - low
    both >>= np.uint64(cut)
    both <<= np.uint64(place)
    both |= np.arange(n, dtype=np.uint64)
    both.sort()
    both &= np.uint64((1 << place) - 1)
    order = both.view(np.int64)
    if cut:
        a = keys[order]
        if (a[1:] < a[:-1]).any():
            return np.argsort(keys)
    return order


def multikey_order(first: np.ndarray, second: np.ndarray | None) -> np.ndarray:
    """Order by ``first`` and ``second``: a quicksort by the leading word, and only the runs that it
    leaves tied between different keys are sorted by the word that follows."""
    if second is None:
        return key_order(first)
    order = np.argsort(first, kind="quicksort")
    a, b = first[order], second[order]
    same = a[1:] == a[:-1]
    differ = same & (b[1:] != b[:-1])
    if differ.any():
        run = np.cumsum(np.r_[False, ~same])
        mixed = np.zeros(run[-1] + 1, bool)
        mixed[run[1:][differ]] = True
        tied = np.flatnonzero(mixed[run])
        t = order[tied]
        order[tied] = t[np.lexsort((second[t], first[t]))]
    return order


def even_splitters(buckets: int) -> np.ndarray:
    """Splitters for keys that are hashes."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


def _sent(keys: Keys, splitters: np.ndarray) -> list[tuple[int, bytes]]:
    edge = keys.buckets(splitters)
    full = np.flatnonzero(edge[1:] > edge[:-1])
    lo, hi = edge[full], edge[full + 1]
    out = []
    if keys.how == "sum":
        for bucket, i, j in zip(full.tolist(), lo.tolist(), hi.tolist()):
            a, v = keys.first[i:j], keys.values[i:j]
            low = int(v.min())
            gaps, rest = np.diff(a, prepend=np.uint64(0)), (v - low).view(np.uint64)
            out.append((bucket, struct.pack("<Iq", j - i, low) + pressed(gaps) + pressed(rest)))
        return out
    if not len(full):
        return out
    # the planes of all keys are made at once, a message takes its part of each
    gaps = np.diff(keys.first, prepend=np.uint64(0))
    gaps[lo] = 0
    low = np.minimum.reduceat(keys.values, lo)
    rest = (keys.values - np.repeat(low, hi - lo)).view(np.uint64)
    data, used = used_planes([gaps, rest] if keys.second is None else [gaps, rest, keys.second])
    for bucket, i, j, x, v in zip(full.tolist(), lo.tolist(), hi.tolist(), keys.first[lo].tolist(), low.tolist()):
        out.append((bucket, struct.pack(_HEAD, j - i, used, x, v) + np.packbits(keys.many[i:j]).tobytes() + data[:, i:j].tobytes()))
    return out


#: Of a message with ``min``: keys, planes, first key, smallest value. Of the answer: planes, smallest value.
_HEAD, _ANSWER = "<IIQq", "<Bq"


def _combine(payloads: list[bytes], two: bool, how: str, often: int | None = None) -> tuple[list[bytes], list[bytes], int, int]:
    """Answers to each payload: for ``sum`` the totals, for ``min`` which keys have different values
    and their smallest (no bytes if no key has). For ``sum`` also which totals reach ``often``, if that is given, the number of odd
    keys with a sum over zero, and the sum of these."""
    if how == "sum":
        first, values, sizes = [], [], []
        for p in payloads:
            n, low = struct.unpack_from("<Iq", p)
            sizes.append(n)
            gaps, at = from_pressed(p, 12, n)
            first.append(np.cumsum(gaps, dtype=np.uint64))
            values.append(from_pressed(p, at, n)[0].view(np.int64) + low)
        keys = Keys(np.concatenate(first), np.concatenate(values), None, how)
        mine = np.split(keys.values[keys.group], np.cumsum(sizes)[:-1])
        odd = keys.values[(keys.values > 0) & ((keys.first & np.uint64(1)) == 1)]
        size = lambda x: struct.pack("<I", len(x))
        reached = [] if often is None else [size(x) + np.packbits(x >= often).tobytes() for x in mine]
        return [size(x) + pressed(x.view(np.uint64)) for x in mine], reached, len(odd), int(odd.sum())
    heads = [struct.unpack_from(_HEAD, p) for p in payloads]
    sizes = np.array([h[0] for h in heads])
    many = np.concatenate([np.unpackbits(np.frombuffer(p, np.uint8, (h[0] + 7) // 8, struct.calcsize(_HEAD)), count=h[0]) for p, h in zip(payloads, heads)])
    parts = [(p, struct.calcsize(_HEAD) + (n + 7) // 8, n, used) for p, (n, used, _, _) in zip(payloads, heads)]
    gaps, rest, *second = from_used_planes(parts, 3 if two else 2)
    start = np.cumsum(sizes) - sizes
    gaps[start] = np.array([h[2] for h in heads], np.uint64)
    first = np.cumsum(gaps, dtype=np.uint64)
    first -= np.repeat(first[start] - gaps[start], sizes)
    values = rest.view(np.int64) + np.repeat(np.array([h[3] for h in heads], np.int64), sizes)
    keys = Keys(first, values, second[0] if two else None, how)
    keys.many[keys.group[np.flatnonzero(many)]] = True
    differ = keys.many[keys.group]
    least = keys.values[keys.group[differ]]
    per = np.add.reduceat(differ, start, dtype=np.int64)
    told = np.flatnonzero(per)
    if not len(told):
        return [b""] * len(payloads), [], 0, 0
    end = np.cumsum(per)
    low = np.minimum.reduceat(least, (end - per)[told])
    data, used = used_planes([(least - np.repeat(low, per[told])).view(np.uint64)])
    out = [b""] * len(payloads)
    for i, x, v in zip(told.tolist(), low.tolist(), zip((end - per)[told].tolist(), end[told].tolist())):
        bits = differ[start[i] : start[i] + sizes[i]]
        out[i] = struct.pack(_ANSWER, used, x) + np.packbits(bits).tobytes() + data[:, v[0] : v[1]].tobytes()
    return out, [], 0, 0


class Answers:
    """What a block was told so far, by kind."""

    def __init__(self, table: pa.Table | None) -> None:
        self.by: dict[str, list[tuple[int, bytes]]] = {}
        if table is not None:
            for kind, bucket, payload in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "payload"))):
                self.by.setdefault(kind, []).append((bucket, payload))

    def totals(self, kind: str) -> np.ndarray:
        """Of the ``sum`` of every key, in the order of the block's keys."""
        got = [from_pressed(p, 4, *struct.unpack_from("<I", p))[0] for _, p in sorted(self.by.get(kind, []))]
        return np.concatenate(got).view(np.int64) if got else np.empty(0, np.int64)

    def often(self, kind: str) -> np.ndarray:
        """Of the ``sum`` of every key, in the order of the block's keys: whether it reaches the limit asked with it."""
        got = [np.unpackbits(np.frombuffer(p, np.uint8, offset=4), count=struct.unpack_from("<I", p)[0]) for _, p in sorted(self.by.get(f"{kind}-often", []))]
        return np.concatenate(got).astype(bool) if got else np.empty(0, bool)

    def least(self, kind: str, keys: Keys, splitters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(many, least)`` for every key of the block: whether its values differ anywhere, and the
        smallest (the block's own where they do not differ)."""
        many, least = np.zeros(len(keys.first), bool), keys.values.copy()
        edge, parts, low, where = keys.buckets(splitters), [], [], []
        for bucket, p in sorted(self.by.get(kind, [])):
            lo, hi = int(edge[bucket]), int(edge[bucket + 1])
            bits = (hi - lo + 7) // 8
            used, x = struct.unpack_from(_ANSWER, p)
            at = np.flatnonzero(np.unpackbits(np.frombuffer(p, np.uint8, bits, struct.calcsize(_ANSWER)), count=hi - lo))
            where.append(at + lo)
            low.append(x)
            parts.append((p, struct.calcsize(_ANSWER) + bits, len(at), used))
        if parts:
            at = np.concatenate(where)
            many[at] = True
            least[at] = from_used_planes(parts, 1)[0].view(np.int64) + np.repeat(np.array(low, np.int64), [len(x) for x in where])
        return many, least

    def rows(self, kind: str) -> list[bytes]:
        return [p for _, p in sorted(self.by.get(kind, []))]


Docs = list[tuple[int, bytes]]


class Blocks:
    """Texts in blocks, and the answers so far."""

    def __init__(self, docs: DataFrame, name: str, integer_ids: bool = False, per_bucket: int = BLOCKS_PER_BUCKET) -> None:
        spark = docs.sparkSession
        if integer_ids and not isinstance(docs.schema["doc_id"].dataType, IntegralType):
            raise TypeError("doc_id must be an integer column")
        self.name, self.answers = name, None
        self.told: list[tuple[set[str] | None, DataFrame]] = []
        # a row's number holds its partition and its place in it; taken once, as it is written
        rows = docs.select("doc_id", text_bytes().alias("text")).select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
        kind = rows.schema["doc_id"].dataType.simpleString()
        rows = rows.mapInArrow(_cut_blocks, f"block bigint, rid bigint, doc_id {kind}, text binary")
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        table = f"llm_{name}_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(parts, "block").option("compression", "zstd")
        writer.option("parquet.compression.codec.zstd.level", "6").option("path", new_output_path(spark, table)).saveAsTable(table)
        self.table = spark.table(table)
        blocks = self.table.agg(F.count_distinct("block")).first()[0]
        self.n_buckets = max(parts, blocks // per_bucket)
        self.splitters = even_splitters(self.n_buckets)

    def step(self, run: Callable[[Docs, Answers, pa.Table], pa.Table], schema: str, kinds: list[str] | None = None) -> DataFrame:
        """``run(documents, answers, rows)`` over every block; documents are ``(id, bytes)`` in the
        order of ``rows`` (``block, rid, doc_id, text``). Only answers of ``kinds`` are moved (all by default)."""

        def prepared(rows: pa.Table) -> tuple[Docs, pa.Table]:
            rows = rows.sort_by("rid")
            ids = rows.column("doc_id").to_pylist()
            return [(NO_ID if i is None else i, x) for i, x in zip(ids, rows.column("text").to_pylist())], rows

        grouped = self.table.groupBy("block")
        if self.answers is None:

            def alone(rows: pa.Table) -> pa.Table:
                d, rows = prepared(rows)
                return run(d, Answers(None), rows)

            return grouped.applyInArrow(alone, schema)

        def told(rows: pa.Table, answers: pa.Table) -> pa.Table:
            d, rows = prepared(rows)
            return run(d, Answers(answers), rows)

        mine = self.answers.where("block >= 0")
        if kinds is not None:
            # tables without these kinds are not opened
            tables = [t for held, t in self.told if held is None or held & set(kinds)]
            mine = reduce(DataFrame.union, tables or [self.answers]).where("block >= 0").where(F.col("kind").isin(kinds))
        return grouped.cogroup(mine.groupBy("block")).applyInArrow(told, schema)

    def odd_keys(self, kind: str) -> tuple[int, int]:
        """The number of odd keys with a sum over zero, of a ``sum``, and the total of their sums."""
        own = self.answers.where((F.col("block") < 0) & (F.col("kind") == kind))
        total = F.expr("aggregate(sequence(7, 0, -1), 0L, (t, i) -> shiftleft(t, 8) + CAST(conv(hex(substring(payload, i + 1, 1)), 16, 10) AS BIGINT))")
        found = own.agg(F.coalesce(F.sum("bucket"), F.lit(0)), F.coalesce(F.sum(total), F.lit(0))).first()
        return int(found[0]), int(found[1])

    def state_total(self, kind: str) -> int:
        """The total of the numbers that blocks gave with their states."""
        own = self.answers.where((F.col("block") < 0) & (F.col("kind") == f"{kind}-state"))
        return int(own.agg(F.coalesce(F.sum("bucket"), F.lit(0))).first()[0])

    def learn(self, answers: DataFrame, kinds: set[str] | None = None) -> None:
        self.told.append((kinds, answers))
        self.answers = answers if self.answers is None else self.answers.union(answers)

    def ask(self, kind: str, find: Callable[[Docs, Answers, pa.Table], Keys | tuple[Keys, bytes, int]], splitters: np.ndarray | None = None, two: bool = False, kinds: list[str] | None = None, often: int | None = None) -> None:
        """Combine the keys that ``find`` gives for each block; the answers are of ``kind``.

        ``find`` may give ``(keys, state, number)``: bytes that later steps get back for the same block
        as ``<kind>-state``, so that they need not find its places again, and a number whose total ``state_total`` has. Of a ``sum``, ``<kind>-often`` tells which ones reach
        ``often``, a bit for each, for steps that need no more.
        """
        split = self.splitters if splitters is None else splitters

        def send(docs: Docs, answers: Answers, rows: pa.Table) -> pa.Table:
            found = find(docs, answers, rows)
            keys, state, number = found if isinstance(found, tuple) else (found, None, 0)
            out = [(bucket, keys.how, p) for bucket, p in _sent(keys, split)]
            block = rows.column("block")[0].as_py()
            if state is not None:  # alone in a bucket below all others
                out.append((-1 - block, "state", struct.pack("<q", number) + state))
            return pa.table(
                {
                    "bucket": pa.array([b for b, _, _ in out], pa.int64()),
                    "block": pa.array([block] * len(out), pa.int64()),
                    "how": pa.array([h for _, h, _ in out], pa.string()),
                    "payload": pa.array([p for _, _, p in out], pa.binary()),
                }
            )

        def combine(rows: pa.Table) -> pa.Table:
            how = rows.column("how")[0].as_py()
            if how == "state":
                (payload,), (block,) = rows.column("payload").to_pylist(), rows.column("block").to_pylist()
                # block -1 is nobody's: it counts for the whole corpus
                return pa.table(
                    {
                        "block": pa.array([block, -1], pa.int64()),
                        "kind": pa.array([f"{kind}-state"] * 2, pa.string()),
                        "bucket": pa.array([-1 - block, struct.unpack_from("<q", payload)[0]], pa.int64()),
                        "payload": pa.array([payload[8:], b""], pa.binary()),
                    }
                )
            payloads, reached, odd, odd_sum = _combine(rows.column("payload").to_pylist(), two, how, often)
            block, bucket = rows.column("block").to_pylist(), rows.column("bucket").to_pylist()
            if how == "min":
                kept = [i for i, p in enumerate(payloads) if p]
                payloads, block, bucket = ([x[i] for i in kept] for x in (payloads, block, bucket))
            twice = 1 + bool(reached)
            return pa.table(
                {
                    "block": pa.array([*block * twice, -1], pa.int64()),
                    "kind": pa.array([*[kind] * len(block), *[f"{kind}-often"] * len(reached), kind], pa.string()),
                    "bucket": pa.array([*bucket * twice, odd], pa.int64()),
                    "payload": pa.array([*payloads, *reached, struct.pack("<q", odd_sum)], pa.binary()),
                }
            )

        sent = self.step(send, "bucket bigint, block bigint, how string, payload binary", kinds)
        self.learn(stored(sent.groupBy("bucket").applyInArrow(combine, ANSWERS), f"{self.name}-{kind}"), {kind, f"{kind}-state", f"{kind}-often"})

"""Hard negatives by a secondary sort.

Every anchor meets every row in cells of a grid (blocks of rows by blocks of
anchors; both blocks have a bounded number of rows), where the scores are one
matrix product. A cell's pairs are packed into keys ``(anchor, descending score,
positives before negatives, id)``. The pairs are dealt to partitions by anchor
and sorted there by key, and an iterator over the sorted rows keeps nothing of an
anchor but its open windows: a positive opens one, the negatives that follow in
descending order and fall into it are emitted until it has enough.

A cell is its own combiner, so that the shuffle does not hold all pairs:

1. of the rows with the anchor's label it sends the first ``positives``, as the
   first of all rows are among the first of their cells;
2. when these are known, it sends the first ``negatives`` rows of other labels
   inside each positive's window, for the same reason.

Nothing is capped: rows that a cell keeps back cannot be in the result.

Defined results: rows without an id, a label or a vector, with a null or
non-finite component, or with a component of 2^31 or more after scaling take no
part; rows are told apart by their place, so rows that repeat an id are others to
each other, and a repeated anchor repeats its result; vectors of different
lengths do not meet; vectors of no components score 0; a score that does not fit
64 bits is an error; ties go to the smaller id; an anchor without positives, or a
positive without negatives, has no rows; an empty table gives none; other columns
are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import stored, table

POSITIVES = 5
NEGATIVES = 3
#: A negative scores between these percentages of its positive.
LOW, HIGH = 50, 95
SCALE = 256
#: Rows and anchors of a cell, about.
ROWS, ANCHORS = 8192, 2048

_LEAST = np.iinfo(np.int64).min
_SIGN = np.uint64(1 << 63)
#: anchor id, anchor row, descending score, kind (0 positive, 1 negative), id of the other row
_KEY = np.dtype([("anchor", ">u8"), ("row", ">u8"), ("score", ">u8"), ("kind", "u1"), ("other", ">u8")])
_FORMAT = ">QQQBQ"


def pair_keys(anchor: np.ndarray, row: np.ndarray, score: np.ndarray, kind: int, other: np.ndarray) -> pa.Array:
    """Keys whose byte order is the order of the pairs (all but ``kind`` are int64 arrays)."""
    up = lambda x: x.astype(np.int64).view(np.uint64) ^ _SIGN
    keys = np.empty(len(row), _KEY)
    keys["anchor"], keys["row"], keys["other"] = up(anchor), up(row), up(other)
    keys["score"], keys["kind"] = ~up(score), kind
    ends = np.arange(len(row) + 1, dtype=np.int32) * _KEY.itemsize
    return pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(keys.tobytes())])


def pair_of(key: bytes) -> tuple[int, int, int, int, int]:
    """``anchor, row, score, kind, other`` of a key."""
    a, r, s, kind, o = struct.unpack(_FORMAT, key)
    half = 1 << 63
    return a - half, r - half, (~s & (2 * half - 1)) - half, kind, o - half


def _matrix(vectors: pa.ChunkedArray, scale: int) -> np.ndarray:
    flat = vectors.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).reshape(len(flat), -1) if len(values) else np.zeros((len(flat), 0))


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    top = lambda x: float(np.abs(x).max(initial=0.0))
    if top(a) * top(b) * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    return exact.astype(np.int64)  # OverflowError where a score does not fit


def _first(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first ``k`` allowed scores of each row, greatest first, ties by column."""
    n = scores.shape[1]
    among = allowed
    if n > k:
        s = np.where(allowed, scores, _LEAST)
        among = allowed & (s >= np.partition(s, n - k, axis=1)[:, n - k, None])
    row, col = np.nonzero(among)
    order = np.lexsort((col, ~scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return row[place < k], col[place < k]


def _cell(rows: pa.Table, anchors: pa.Table, scale: int):
    """Per chunk of a cell's anchors: their ids, labels and rows, the scores, and the other rows in order of id."""
    order = np.lexsort((rows["rid"].to_numpy(), rows["vec_id"].to_numpy()))
    ids, labels, places = (rows[c].to_numpy()[order] for c in ("vec_id", "label", "rid"))
    b = _matrix(rows["embedding"], scale)[order]
    a = _matrix(anchors["embedding"], scale)
    chunk = max(1, (1 << 20) // max(1, len(ids)))
    for i in range(0, len(a), chunk):
        mine = [anchors[c].to_numpy()[i : i + chunk] for c in ("vec_id", "label", "rid")]
        same = mine[1][:, None] == labels[None, :]
        yield i, mine, _scores(a[i : i + chunk], b), same, mine[2][:, None] != places[None, :], ids


_PAIR = pa.schema([("row", pa.int64()), ("key", pa.binary())])


def _pairs(parts: list) -> pa.Table:
    return pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array(r), k], schema=_PAIR) for r, k in parts], _PAIR)


def _met(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], task) -> DataFrame:
    """``row, key`` of what ``task`` finds in each cell of the grid."""
    n_rows, n_anchors = blocks
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumns({"rb": F.pmod(F.xxhash64("rid"), F.lit(n_rows)).cast("int"), "ab": upto(n_anchors)})
    right = anchors.withColumns({"ab": F.pmod(F.xxhash64("rid"), F.lit(n_anchors)).cast("int"), "rb": upto(n_rows)})
    cell = ["rb", "ab", "dim"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(task, "row bigint, key binary")


def _sorted(pairs: DataFrame) -> DataFrame:
    """The secondary sort: an anchor's pairs in one partition, in the order of their keys."""
    return pairs.repartition("row").sortWithinPartitions("key").select("key")


def anchor_positives(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], k: int, scale: int, low: int, high: int) -> DataFrame:
    """``rid, ids, scores, lows, highs``: the first ``k`` other rows of an anchor's label, and the
    least and greatest score of a negative of each."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if len(left) and len(right):
            for _, (a, _label, r), s, same, other, ids in _cell(left, right, scale):
                i, j = _first(s, same & other, k)
                parts.append((r[i], pair_keys(a[i], r[i], s[i, j], 0, ids[j])))
        return _pairs(parts)

    names = ["rid", "ids", "scores", "lows", "highs"]
    types = [pa.int64(), *[pa.list_(pa.int64())] * 4]

    def batch(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = []
        for b in batches:
            for key in b.column(0).to_pylist():
                _, row, score, _, other = pair_of(key)
                if not found or found[-1][0] != row:
                    if len(found) > 4096:
                        yield batch(found)
                        found = []
                    found.append((row, [], [], [], []))
                if len(found[-1][1]) < k:
                    for part, x in zip(found[-1][1:], (other, score, -(-low * score // 100), high * score // 100)):
                        part.append(x)
        if found:
            yield batch(found)

    schema = "rid bigint, ids array<bigint>, scores array<bigint>, lows array<bigint>, highs array<bigint>"
    return _sorted(_met(rows, anchors, blocks, task)).mapInArrow(run, schema)


def window_negatives(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], k: int, scale: int) -> DataFrame:
    """``row, key`` of the pairs that may be in the result: each positive, and the first ``k``
    rows of a cell inside a positive's window. ``anchors`` have the columns of ``anchor_positives``."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if len(left) and len(right):
            lows, highs = right["lows"].to_pylist(), right["highs"].to_pylist()
            for at, (a, _label, r), s, same, _, ids in _cell(left, right, scale):
                some = set()
                for w in range(max(map(len, lows[at : at + len(a)]))):
                    # an anchor with fewer positives has an empty window here
                    lo = np.array([x[w] if w < len(x) else 0 for x in lows[at : at + len(a)]], np.int64)
                    hi = np.array([x[w] if w < len(x) else -1 for x in highs[at : at + len(a)]], np.int64)
                    i, j = _first(s, ~same & (s >= lo[:, None]) & (s <= hi[:, None]), k)
                    some.update(zip(i.tolist(), j.tolist()))
                if some:
                    i, j = np.array(sorted(some), np.int64).T
                    parts.append((r[i], pair_keys(a[i], r[i], s[i, j], 1, ids[j])))
        return _pairs(parts)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for a, r, ids, scores in zip(*(c.to_pylist() for c in b.columns)):
                n = len(ids)
                parts.append((np.full(n, r), pair_keys(np.full(n, a), np.full(n, r), np.array(scores), 0, np.array(ids))))
            yield from _pairs(parts).to_batches()

    opening = anchors.select("vec_id", "rid", "ids", "scores").mapInArrow(own, "row bigint, key binary")
    return _met(rows, anchors.drop("ids", "scores"), blocks, task).union(opening)


def emitted_negatives(pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``row, key``."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, windows = None, []
        for b in batches:
            out = []
            for key in b.column(0).to_pylist():
                anchor, r, score, kind, other = pair_of(key)
                if r != row:
                    row, windows = r, []
                if kind == 0:
                    windows.append([other, score, 0])
                    continue
                for w in windows:
                    if w[2] < k and low * w[1] <= 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], other, w[1], score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return _sorted(pairs).mapInArrow(run, schema)


def hard_negatives(
    vectors: DataFrame,
    anchor: str,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id`` and ``label`` (integers) and ``embedding`` (an array of numbers);
    ``anchor`` is SQL over ``vec_id`` that says which rows are anchors. A component ``x`` counts
    as ``floor(scale * x)``, a score is the inner product of two rows. Each anchor's first ``positives``
    rows of its label get the first ``negatives`` rows of other labels that score between
    ``low`` and ``high`` per cent of them. Order is by score, then by smaller id.
    """
    if not 0 <= low < high <= 100:
        raise ValueError("windows lie below their positive: 0 <= low < high <= 100")
    spark = vectors.sparkSession
    slim = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding")
    if slim.schema["embedding"].dataType.simpleString() != "array<float>":
        slim = slim.withColumn("embedding", F.col("embedding").cast("array<double>"))
    fine = "x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) * {} < 2147483648D".format(scale)
    slim = slim.where(f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> {fine})")
    slim = slim.withColumns({"rid": F.monotonically_increasing_id(), "dim": F.size("embedding"), "is_anchor": F.expr(anchor)})
    rows = stored(slim, "negatives-rows")
    n, m = rows.agg(F.count("*"), F.count(F.when(F.col("is_anchor"), 1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n // ROWS), min(tasks, n // 256)), max(1, -(-m // ANCHORS))
    anchors = rows.where("is_anchor").drop("is_anchor")
    rows = rows.drop("is_anchor")
    found = stored(anchor_positives(rows, anchors, blocks, positives, scale, low, high), "negatives-positives")
    known = stored(anchors.join(found, "rid"), "negatives-anchors")
    return emitted_negatives(window_negatives(rows, known, blocks, negatives, scale), negatives, low, high)


def q_negatives(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    label = F.expr("IF(vec_id % 7 = 0, (CAST(label AS BIGINT) + 1) % 10, label)")
    return hard_negatives(v.withColumn("label", label), "vec_id % 50 = 0")

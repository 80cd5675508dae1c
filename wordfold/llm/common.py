"""Helpers shared by the operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordfold.session import new_output_path

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back (cuts the lineage).

    A table read back is also a plain scan, so a later shuffle join on it keeps
    both exchanges under AQE's control and a hot key can be split.
    """
    spark = df.sparkSession
    path = new_output_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` as a struct ``row``, beside the named columns: whatever names the caller's other
    columns have, they meet no helper's."""
    return docs.select(F.struct(*[_quoted(c) for c in docs.columns]).alias("row"), *columns)


def unpacked(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` from ``row``, but for those that ``changed`` gives anew."""
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


#: log2 of the rows of a page.
_PAGE = 15


def row_table(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` as ``row, at, page``, written once: ``at`` tells each row, and a page is up to 2^15
    rows of one task. The table is bucketed by page, and a task writes each of its pages to one
    file, so nothing is shuffled to write it, nor to join it by page (``only``).
    """
    spark, known = docs.sparkSession, f"llm_{name}_{uuid.uuid4().hex}"
    rows = packed(docs).withColumn("at", F.monotonically_increasing_id()).withColumn("page", F.shiftright("at", _PAGE))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "page").option("path", new_output_path(spark, known)).saveAsTable(known)
    found = spark.table(known)
    found.schema  # noqa: B018  resolved now, so that the catalog need not keep the name; the files stay
    spark.sql(f"DROP TABLE {known}")
    return found


def only(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of a ``row_table`` whose ``at`` is in ``kept``. What moves is a bit for each row, in bitmaps by page."""
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bit = F.col("at").bitwiseAND((1 << _PAGE) - 1)
    pages = kept.groupBy(F.shiftright("at", _PAGE).alias("_page")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    pages = pages.repartition(buckets, "_page")
    found = rows.join(pages.hint("shuffle_hash"), F.col("page") == F.col("_page"))
    byte = f"CAST(conv(hex(substring(bits, CAST(shiftright(at & {(1 << _PAGE) - 1}, 3) AS INT) + 1, 1)), 16, 10) AS INT)"
    return found.where(f"shiftright({byte}, CAST(at & 7 AS INT)) & 1 = 1").drop("_page", "bits")


def arrow_column(run, kind: str):
    """A column function over Arrow arrays. It counts as non-deterministic only so that the planner never runs it twice."""
    return F.arrow_udf(run, kind).asNondeterministic()


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Few small rows that stand for much work, dealt over all tasks. The number is given, so
    that AQE does not put them together again by their size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def text_bytes(column: str = "text"):
    """The text's UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def with_class_min(rows: DataFrame, keys: list[str], value: str, out: str, name: str) -> DataFrame:
    """``rows`` plus the smallest ``value`` of all rows with equal ``keys``.

    The minimum is combined in the map tasks, so a key with most of the rows
    moves one row per task. It is stored before the join back: both sides of
    the join are then plain shuffles, whose hot partitions AQE splits.
    ``rows`` should itself be a stored table, since it is read twice.
    """
    least = stored(rows.groupBy(*keys).agg(F.min(value).alias(out)), name)
    renamed = least.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)], out)
    on = None
    for i, k in enumerate(keys):
        c = rows[k].eqNullSafe(renamed[f"_k_{i}"])
        on = c if on is None else on & c
    return rows.join(renamed, on, "left").drop(*[f"_k_{i}" for i in range(len(keys))])


# --- hashing of symbol sequences inside a task -------------------------------

_MULT = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> _U(31))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(29))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def window_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` symbols (uint64), by doubling; n - k + 1 values.

    The symbols should already be scrambled (``mix64``), so that the polynomial
    in the odd multiplier does not meet structured input.
    """
    n = len(symbols)
    if n < k:
        return np.empty(0, np.uint64)
    done, have, cur, width, mult = None, 0, symbols, 1, _MULT
    left = k
    while left:
        if left & 1:
            if done is None:
                done, have = cur, width
            else:
                m = min(len(done), len(cur) - have)
                done, have = done[:m] * _U(mult) + cur[have : have + m], have + width
        left >>= 1
        if left:
            cur = cur[: len(cur) - width] * _U(mult) + cur[width:]
            width, mult = width * 2, (mult * mult) & _MASK
    return mix64(done[: n - k + 1])


#: A scrambled value for each byte, and what bytes separate words.
BYTE_SYMBOLS = mix64(np.arange(1, 257, dtype=np.uint64) * _U(_MULT))
WORD_BREAK = np.zeros(256, bool)
WORD_BREAK[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier, and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, 2 * n)
        _POWERS[:] = [np.r_[_U(1), np.cumprod(np.full(size, x, np.uint64))] for x in (_MULT, pow(_MULT, -1, 2**64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def stretch_hashes(symbols: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch ``symbols[start:stop]``: equal stretches anywhere have equal
    hashes (a polynomial from running sums, moved to the stretch's start)."""
    up, down = powers(len(symbols) + 1)
    run = np.empty(len(symbols) + 1, np.uint64)
    run[0] = 0
    np.cumsum(symbols * up[:-1], dtype=np.uint64, out=run[1:])
    return mix64((run[stop] - run[start]) * down[start] + (stop - start).astype(np.uint64))


def word_symbols(data: bytes) -> np.ndarray:
    """A 64-bit symbol for each word (a run of anything but ASCII white space) of a text."""
    raw = np.frombuffer(data, np.uint8)
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = WORD_BREAK[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return stretch_hashes(BYTE_SYMBOLS[raw], edge[0::2], edge[1::2])


#: Bytes of text whose words are hashed at once: what is held for each byte then stays in the processor's cache.
_PIECE = 1 << 16
_PLAIN = bytes(0x20 if WORD_BREAK[i] else i for i in range(256)).lower()


def lower_word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``word_symbols`` of all texts with A-Z lowered, one text after the other, and how many each text has."""
    symbols, counts, at = [np.empty(0, np.uint64)], np.zeros(len(texts), np.int64), 0
    while at < len(texts):
        to, held = at + 1, len(texts[at])
        while to < len(texts) and held + 1 + len(texts[to]) <= _PIECE:
            to, held = to + 1, held + 1 + len(texts[to])
        raw = np.frombuffer(b" ".join(texts[at:to]).translate(_PLAIN), np.uint8)
        gap = np.ones(len(raw) + 2, bool)
        np.equal(raw, 0x20, out=gap[1:-1])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        symbols.append(stretch_hashes(BYTE_SYMBOLS[raw], edge[0::2], edge[1::2]))
        following = np.cumsum([len(t) + 1 for t in texts[at:to]])
        counts[at:to] = np.diff(np.searchsorted(edge[0::2], following), prepend=0)
        at = to
    return np.concatenate(symbols), counts


_POS = _U(0xFFFFF)


def window_anchors(hashes: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The position of the smallest hash in every run of ``w`` hashes, as
    ``(anchor, first window, end window)`` runs of windows with one anchor.

    Ties go to one of the tied positions, which have equal hashes, so the hash at
    the anchor depends on the run's content only: equal runs anywhere choose it.
    """
    n = len(hashes)
    if n < w:
        e = np.empty(0, np.int64)
        return e, e, e
    pos = np.arange(n, dtype=np.uint64)
    cur = (hashes & ~_POS) | ((_POS - (pos & _POS)) & _POS)
    width = 1
    while width * 2 <= w:
        cur = np.minimum(cur[:-width], cur[width:])
        width *= 2
    if width < w:
        cur = np.minimum(cur[: n - w + 1], cur[w - width : w - width + n - w + 1])
    low = (_POS - (cur & _POS)).astype(np.int64)
    start = np.arange(n - w + 1, dtype=np.int64)
    at = start + ((low - start) & int(_POS))
    first = np.flatnonzero(np.r_[True, np.diff(at) != 0])
    return at[first], first, np.r_[first[1:], len(at)]

"""Quality rules with adaptive thresholds.

Fixed cutoffs are replaced by thresholds that each (language, source) group
sets for itself. Every document is reduced to four integer metrics. A group's
metrics are summed up in mergeable quantile sketches: counts in log-linear
buckets (exact below 64, then 32 buckets per power of two, so a quantile is off
by at most 1/32). Sketches merge by adding counts, so the map tasks combine
them before the shuffle.

A group is judged by its own sketch and ``PRIOR`` documents spread like those of its language,
which in turn takes in ``PRIOR`` spread like all documents: few documents say little
against the coarser sketch, many outweigh it, and nothing switches at a size.

The limit of a metric is a quantile in the upper tail of its group, plus
``SPREADS`` times its distance from the median. Where most texts lack what a metric counts
both are 0; there the limit is a quantile of the values over 0 of all documents:
a low one for symbols, whose presence alone tells, a high one for repetitions,
which good texts have too. So no limit has a constant in it, and a limit moves with its source.
The limits are joined to the documents, which are filtered by them.

Defined results: a null or empty text has no words and fails; null languages
and sources are groups of their own; an empty table gives no rows; repeated
rows are judged one by one; extra columns are ignored by ``quality_features``
and ``quality_verdicts`` and kept, whatever their names, by ``quality_filter``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.llm.common import arrow_column, packed, stored, table, text_bytes, unpacked

# Symbols that junk is full of and prose is not (fixed by the query's contract).
SYMBOLS = b"#*$%&|<>"
WORD_BREAKS = b"\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

#: metric -> (SQL over the features, per cent of a group at its tail's quantile,
#: per cent of all values over 0 at the least limit)
METRICS = {
    "symbols": ("n_symbols * 1000 DIV greatest(word_chars, 1)", 85, 5),
    "dup_lines": ("n_dup_lines * 1000 DIV greatest(n_words, 1)", 99, 95),
    "repeats": ("n_repeat_words * 1000 DIV greatest(n_words, 1)", 99, 95),
    "word_length": ("word_chars * 100 DIV greatest(n_words, 1)", 95, 0),
}
#: Metrics that are also too small when far below the rest of the group.
TWO_SIDED = {"word_length"}
#: A limit lies so many times the distance from the median beyond the tail's quantile.
SPREADS = 3
#: Documents that a group takes in from the coarser sketch.
PRIOR = 50

_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated_words(words: list[bytes]) -> int:
    """Words in runs of ``WINDOW`` words that occur twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    width = 1
    while width < WINDOW:  # exact ranks of runs of 2, 4 and 8 words
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank = np.unique(pair, return_inverse=True)[1].ravel()
        width *= 2
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge[:n])))


def text_features(data: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one UTF-8 text."""
    words = data.split()
    inside = data.translate(None, WORD_BREAKS)
    chars = len(inside.decode("utf-8", "replace"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated_words(words)


_FAILED = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"


def _feature_structs(texts: pa.Array) -> pa.Array:
    rows = np.array([text_features(x.as_py()) for x in texts], np.int64).reshape(-1, len(_FEATURES))
    return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(_FEATURES))], names=_FEATURES)


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``) and the features and ``base_failed``."""
    kind = "struct<" + ",".join(f"{c}:bigint" for c in _FEATURES) + ">"
    kept = [F.col(c) for c in docs.columns]
    found = docs.select(*kept, arrow_column(_feature_structs, kind)(text_bytes()).alias("_features")).select(*kept, "_features.*")
    return found.withColumn("base_failed", F.expr(_FAILED))


def quality_features(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text, lang, source``) as ``doc_id, lang, source`` and the features."""
    return with_features(docs.select("doc_id", "lang", "source", "text")).drop("text")


def _bucket(value: str) -> str:
    shift = f"(length(bin({value})) - 6)"
    return f"CAST(IF({value} < 64, {value}, 32 * {shift} + shiftright({value}, CAST({shift} AS INT))) AS INT)"


def _bucket_top(b: str) -> str:
    """The largest value of bucket ``b``."""
    shift = f"CAST({b} DIV 32 - 1 AS INT)"
    return f"IF({b} < 64, CAST({b} AS BIGINT), shiftleft(CAST({b} % 32 + 33 AS BIGINT), {shift}) - 1)"


def _bucket_bottom(b: str) -> str:
    """The smallest value of bucket ``b``."""
    shift = f"CAST({b} DIV 32 - 1 AS INT)"
    return f"IF({b} < 64, CAST({b} AS BIGINT), shiftleft(CAST({b} % 32 + 32 AS BIGINT), {shift}))"


def quality_sketches(features: DataFrame) -> DataFrame:
    """``lang, source, metric, bucket, n``: a quantile sketch per group and metric,
    over documents that pass the base rules."""
    m = F.explode(
        F.create_map(*[x for k, (sql, *_) in METRICS.items() for x in (F.lit(k), F.expr(f"CAST({sql} AS BIGINT)"))])
    ).alias("metric", "value")
    values = features.where("NOT base_failed").select("lang", "source", m)
    return values.groupBy("lang", "source", "metric", F.expr(_bucket("value")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def _quantiles(sketch: DataFrame, keys: list[str], percents: tuple[int, ...] = (25, 75)) -> DataFrame:
    """``keys, metric``, and ``q25`` and so on from the sketches merged to ``keys``: the largest value of the
    quantile's bucket, as ``b25`` its smallest."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    by = ", ".join([*keys, "metric"])
    ranked = merged.select(
        *keys, "metric", "bucket",
        F.expr(f"sum(n) OVER (PARTITION BY {by} ORDER BY bucket)").alias("upto"),
        F.expr(f"sum(n) OVER (PARTITION BY {by})").alias("total"),
    )
    # counts may be parts of documents, whose sums are a little off
    at = lambda p: F.min(F.expr(f"IF(100 * upto >= ({p} - 1e-9D) * total, bucket, NULL)")).alias(f"_{p}")
    found = ranked.groupBy(*keys, "metric").agg(*[at(p) for p in percents])
    ends = [F.expr(f"{value(f'_{p}')} AS {name}{p}") for p in percents for name, value in (("q", _bucket_top), ("b", _bucket_bottom))]
    return found.select(*keys, "metric", *ends)


def with_prior(sketch: DataFrame, keys: list[str], coarse: DataFrame, coarse_keys: list[str]) -> DataFrame:
    """``keys, metric, bucket, n``: the sketches merged to ``keys``, each with ``PRIOR`` documents
    spread like ``coarse``, a sketch of ``coarse_keys``, which are some of ``keys``."""
    own = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").cast("double").alias("n"))
    of = [f"_{k}" for k in coarse_keys]
    by = ", ".join([*coarse_keys, "metric"])
    share = coarse.select(
        *[F.col(k).alias(f"_{k}") for k in coarse_keys], F.col("metric").alias("_metric"), "bucket",
        F.expr(f"{PRIOR} * n / sum(n) OVER (PARTITION BY {by})").alias("n"),
    )
    groups = own.select(*keys, "metric").distinct()
    on = F.col("metric") == F.col("_metric")
    for k in coarse_keys:
        on &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    prior = groups.join(share, on).drop("_metric", *of)
    return own.unionByName(prior).groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quality_thresholds(sketches: DataFrame) -> DataFrame:
    """One row per ``lang, source``: the least and greatest value that each metric may take.

    ``sketches`` should be a stored table; it has a bounded number of rows per group.
    """
    whole = sketches.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))
    by_lang = with_prior(sketches, ["lang"], whole, [])
    fine = with_prior(sketches, ["lang", "source"], by_lang, ["lang"])
    tails = sorted({q for _, tail, _ in METRICS.values() for q in (tail, 100 - tail)} | {50})
    floors = sorted({low for _, _, low in METRICS.values() if low})
    q = _quantiles(fine, ["lang", "source"], tuple(tails))
    least = _quantiles(whole.where("bucket > 0"), [], tuple(floors))
    least = least.select(F.col("metric").alias("_metric"), *[F.col(f"q{p}").alias(f"low{p}") for p in floors])
    j = q.join(least, F.col("metric") == F.col("_metric"), "left")
    limits = []
    for k, (_, tail, low) in METRICS.items():
        floor = f"coalesce(low{low}, 0L)" if low else "0L"
        top = F.expr(f"IF(metric = '{k}', greatest(q{tail} + {SPREADS} * (q{tail} - q50), {floor}), NULL)")
        limits.append(F.max(top).alias(f"max_{k}"))
        if k in TWO_SIDED:
            bottom = F.expr(f"IF(metric = '{k}', b{100 - tail} - {SPREADS} * (q50 - b{100 - tail}), NULL)")
            limits.append(F.max(bottom).alias(f"min_{k}"))
    return j.groupBy("lang", "source").agg(*limits)


def _limits(feats: DataFrame) -> DataFrame:
    return stored(quality_thresholds(stored(quality_sketches(feats), "quality-sketches")), "quality-thresholds")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the features, ``base_failed`` and ``kept``.

    ``kept`` is false where the base rules fail or a metric lies beyond the
    thresholds of the document's group.
    """
    feats = stored(quality_features(docs), "quality-features")
    return _judged(feats, _limits(feats))


def _judged(feats: DataFrame, limits: DataFrame) -> DataFrame:
    """``feats`` with ``kept``. The limits are a row for each group: Spark sizes that join."""
    lim = limits.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        *[F.col(c).alias(f"_{c}") for c in limits.columns[2:]],
    )
    ok = "NOT base_failed"
    for k, (sql, *_) in METRICS.items():
        ok += f" AND coalesce({sql} <= _max_{k}, true)"
        if k in TWO_SIDED:
            ok += f" AND coalesce({sql} >= _min_{k}, true)"
    on = feats.lang.eqNullSafe(F.col("_lang")) & feats.source.eqNullSafe(F.col("_source"))
    joined = feats.join(lim, on, "left").withColumn("kept", F.expr(ok))
    return joined.drop(*[c for c in joined.columns if c in lim.columns])


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Each row is judged by its own
    features, which are found a second time beside the text: no text is copied or moved for its verdict."""
    limits = _limits(quality_features(docs))
    rows = with_features(packed(docs, "lang", "source", "text"))
    return unpacked(_judged(rows, limits).where("kept"), docs)


def q_quality(spark, sf_dir):
    v = quality_verdicts(table(spark, sf_dir, "documents"))
    return v.select("doc_id", *_FEATURES, "base_failed", "kept")

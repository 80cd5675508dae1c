"""Word operators: tokenize, pair, count per word, swap, top-k, report.

Plan of the composed job (``tokenize -> word_count -> top_words``)::

    Scan (text column only) -> Generate explode(lines) -> Generate explode(words)
      -> HashAggregate(partial_count)          map-side combine, in codegen
      -> Exchange hashpartitioning(word)       the one shuffle
      -> HashAggregate(count)
      -> TakeOrderedAndProject(k)              bounded top-k per partition, no sort

A word that holds a third of all tokens is no hot spot: the partial aggregate
folds it to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.functions.text import report_line, split_words

# Fixed value: the number of words the report ranks.
DEFAULT_K = 100


def tokenize(lines: DataFrame, line_col: str = "value", word_col: str = "word") -> DataFrame:
    """One row per word of each line (single-space split with Java rules)."""
    return lines.select(F.explode(split_words(line_col)).alias(word_col))


def word_pairs(words: DataFrame, word_col: str = "word") -> DataFrame:
    """``word -> (word, 1)``: the pair form that a keyed sum reduces."""
    return words.select(F.col(word_col).alias("word"), F.lit(1).alias("one"))


def word_count(words: DataFrame, word_col: str = "word") -> DataFrame:
    """``word string, n bigint``: occurrences per word (partial + final hash aggregate)."""
    return words.groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("n"))


def sum_pairs(pairs: DataFrame) -> DataFrame:
    """Keyed sum of ``(word, one)`` pairs; the same result as ``word_count``."""
    return pairs.groupBy("word").agg(F.sum("one").cast("bigint").alias("n"))


def count_word(counts: DataFrame) -> DataFrame:
    """Swap to ``n, word``."""
    return counts.select("n", "word")


def top_words(counts: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The ``k`` most frequent words, ``n bigint, word string``, ranked.

    Count descending; equal counts are ordered by word (binary order), so the
    cut at rank k is the same for any partitioning. ``orderBy + limit`` plans as
    ``TakeOrderedAndProject``: each task keeps only its best k rows and one task
    merges k rows per partition, so no global sort of the counts happens.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(k).select("n", "word")


def report(ranked: DataFrame) -> DataFrame:
    """Ranked ``n, word`` rows as report lines ``value = "<n> <word>"``.

    The projection keeps row order; on a ``top_words`` result it folds into the
    same ``TakeOrderedAndProject``.
    """
    return ranked.select(report_line("n", "word").alias("value"))

"""Composed jobs: the top-words report from text sources to the text sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wordfold.operators.words import DEFAULT_K, report, tokenize, top_words, word_count
from wordfold.sinks.text import write_text
from wordfold.sources.text import read_text_lines


def top_words_of_lines(lines: DataFrame, k: int = DEFAULT_K, line_col: str = "value") -> DataFrame:
    """``n, word``: the k most frequent words of a line DataFrame."""
    return top_words(word_count(tokenize(lines, line_col)), k)


def top_words_of_files(spark: SparkSession, paths: Sequence[str], k: int = DEFAULT_K) -> DataFrame:
    """Top words over the union of text files (one scan each)."""
    return top_words_of_lines(read_text_lines(spark, paths), k)


def write_top_words_report(
    spark: SparkSession, paths: Sequence[str], out_path: str, k: int = DEFAULT_K
) -> str:
    """Read text files, rank their top k words and write ``"<n> <word>"`` lines.

    One job of two stages: scan + tokenize + partial count, then final count +
    bounded top-k; the k report lines are written by one task in rank order.
    """
    return write_text(report(top_words_of_files(spark, paths, k)), out_path)

"""Text-line sources: files, text held in a table column, and bag union."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordfold.functions.text import split_lines


def read_text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row (``value string``) per line of one or more text files.

    ``spark.read.text`` splits files into input partitions by
    ``spark.sql.files.maxPartitionBytes`` and breaks lines on LF, CR and CRLF,
    so each executor reads its own byte range. Every path is a scan of its own
    and the result is their bag union: a path given twice counts twice, and
    ``key=value`` folders add no column.
    """
    if isinstance(paths, str):
        paths = [paths]
    return union_all(*[spark.read.text(p).select("value") for p in paths])


def lines_from_column(
    df: DataFrame, text_col: str = "text", keep: Iterable[str] = (), line_col: str = "line"
) -> DataFrame:
    """One row per line of the text in ``text_col`` (file line rules).

    ``keep`` columns are carried onto every line. This is a narrow ``explode``:
    no shuffle, and a long text stays in the task that read it.
    """
    cols = [F.col(c) for c in keep]
    return df.select(*cols, F.explode(split_lines(text_col)).alias(line_col))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union (UNION ALL) by column name; duplicates are kept.

    Union only concatenates the inputs' partitions; nothing is shuffled.
    """
    if not dfs:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), dfs)

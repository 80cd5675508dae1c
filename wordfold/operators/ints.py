"""Integer operators over a ``x int`` input: sum, wrapped sum, even filter, count.

Each is a single stage: per-partition partial aggregates, then one final
aggregate over one row per partition. Nothing but those rows is exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.functions.ints import is_even, sum_wrap32


def int_sum(df: DataFrame, col: str = "x") -> DataFrame:
    """``total bigint``: the 64-bit sum (no 32-bit wrap); NULLs skipped, no rows -> NULL."""
    return df.agg(F.sum(F.col(col).cast("bigint")).alias("total"))


def int_sum_wrap32(df: DataFrame, col: str = "x") -> DataFrame:
    """``total int``: the sum wrapped to 32 bits, exactly as an ``int`` reduce gives."""
    return df.agg(sum_wrap32(col).alias("total"))


def even_rows(df: DataFrame, col: str = "x") -> DataFrame:
    """Rows whose ``col`` is even (negative evens and 0 included, NULL excluded)."""
    return df.where(is_even(col))


def count_rows(df: DataFrame) -> DataFrame:
    """``n bigint``: the number of rows (0 for none)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def even_count(df: DataFrame, col: str = "x") -> DataFrame:
    """``n bigint``: how many values of ``col`` are even."""
    return count_rows(even_rows(df, col))

"""Integer sources: a driver-side list, or an int column of a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INT_SCHEMA = "x int"


def ints_from_list(spark: SparkSession, values: Iterable[int | None]) -> DataFrame:
    """A ``x int`` DataFrame from values held on the driver.

    Like ``parallelize`` this ships the values from the driver (the local scan
    is sliced over the default parallelism), so it is for small inputs only;
    large inputs should come from a table (``int_column``).
    """
    return spark.createDataFrame([(v,) for v in values], INT_SCHEMA)


def int_column(df: DataFrame, col: str) -> DataFrame:
    """Any int column of a table as the ``x int`` input of the int operators.

    A narrow projection: only ``col`` is read from a columnar scan.
    """
    return df.select(F.col(col).cast("int").alias("x"))

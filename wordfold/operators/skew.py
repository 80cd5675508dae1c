"""Detecting keys that hold a large share of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.session import new_output_path


def hot_keys(
    df: DataFrame,
    key_col: str,
    min_share: float | None = None,
    sample_fraction: float = 0.01,
    seed: int = 17,
) -> DataFrame:
    """``key``: the values of ``key_col`` that hold at least ``min_share`` of ``df``'s rows.

    Shares are taken from a seeded sample and compared with its total, so the
    rule is the same at every size. Shares sum to 1, so at most ``1 / min_share``
    keys qualify: the result has a proven size bound and may be broadcast.
    The default share is a quarter of an even shuffle partition's. NULL is
    never hot (it matches nothing).

    The sample is counted once and stored in the shared folder, so that every
    use of the result sees the same keys. A key that the sample misses is handled
    exactly, only without the skew split.
    """
    spark = df.sparkSession
    if min_share is None:
        min_share = 1 / (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = new_output_path(spark, "hot-keys")
    sampled = df.where(F.col(key_col).isNotNull()).sample(fraction=sample_fraction, seed=seed)
    sampled.groupBy(F.col(key_col).alias("key")).agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return counts.where(F.col("n") >= max(1, min_share * total)).select("key")

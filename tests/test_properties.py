"""Property and skew-shaped tests: results never depend on partitioning or hot keys."""

from __future__ import annotations

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordfold.operators import list_children, path_status, tokenize, top_words, word_count

LINE = st.text(alphabet=[" ", "a", "b", "\t", "é", " "], max_size=10)


def java_split_space(line: str) -> list[str]:
    """Model of Java ``line.split(" ")``: no match -> the line; else trailing empties dropped."""
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=20, deadline=None, derandomize=True)
@given(st.lists(LINE, max_size=25), st.integers(min_value=1, max_value=6))
def test_word_count_matches_model_for_any_partitioning(spark, lines, parts):
    df = spark.createDataFrame([(s,) for s in lines], "value string").repartition(parts)
    got = {r.word: r.n for r in word_count(tokenize(df)).collect()}
    want = Counter(w for line in lines for w in java_split_space(line))
    assert got == dict(want)


def test_hot_word_holding_a_third_of_tokens(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), (F.col("id") % 997).cast("string"))).alias("value")
    )
    ranked = top_words(word_count(tokenize(df.repartition(7))), 3).collect()
    assert ranked[0].word == "hot" and ranked[0].n == n // 3
    total = word_count(tokenize(df)).agg(F.sum("n")).collect()[0][0]
    assert total == n


def test_hot_directory_and_hot_manifest_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        n = 6000
        # a third of all keys sit in one directory
        inv = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot/f"), F.col("id").cast("string")))
            .otherwise(F.concat(F.lit("d"), (F.col("id") % 50).cast("string"), F.lit("/f"), F.col("id").cast("string")))
            .alias("key"),
            (F.col("id") % 7).alias("size"),
        )
        root = {r.name: r for r in list_children(inv, "").collect()}
        assert len(root) == 51 and root["hot"].is_dir
        assert list_children(inv, "hot").count() == n // 3
        # a manifest where one key repeats for a third of the rows
        man = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .when(F.col("id") % 3 == 1, F.concat(F.lit("hot/f"), (F.col("id") - 1).cast("string")))
            .otherwise(F.concat(F.lit("nope"), F.col("id").cast("string")))
            .alias("key")
        )
        rows = path_status(man, inv).groupBy("status").count().collect()
        got = {r.status: r["count"] for r in rows}
        assert got == {"dir": n // 3, "file": n // 3, "missing": n - 2 * (n // 3)}
    finally:
        for k in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        ):
            spark.conf.unset(k)


def test_hot_key_split_gives_the_same_rows(spark):
    n = 3000
    inv = spark.range(n).select(
        F.concat(F.lit("d"), (F.col("id") % 20).cast("string"), F.lit("/f"), F.col("id").cast("string")).alias("key"),
        (F.col("id") % 5).alias("size"),
    )
    # hot: an existing file, a directory, a missing key and the root; plus unique keys
    man = spark.range(4 * n).select(
        F.when(F.col("id") % 6 == 0, F.lit("d1/f1"))
        .when(F.col("id") % 6 == 1, F.lit("d2"))
        .when(F.col("id") % 6 == 2, F.lit("nope"))
        .when(F.col("id") % 6 == 3, F.lit(""))
        .otherwise(F.concat(F.lit("d3/f"), F.col("id").cast("string")))
        .alias("key"),
        F.col("id"),
    )
    split = path_status(man, inv, hot_sample_fraction=1.0, hot_share=0.1)
    plain = path_status(man, inv, split_hot_keys=False)
    a = sorted(tuple(r) for r in split.collect())
    b = sorted(tuple(r) for r in plain.collect())
    assert a == b and len(a) == 4 * n
    counts = dict(Counter(r[2] for r in a))
    assert counts["file"] >= 2 * n // 3 and counts["dir"] >= 2 * n // 3


def _reducer_rows(spark, df) -> list[int]:
    """Rows of each task after the join, with fixed partitions and no broadcast."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return [r["count"] for r in df().groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_and_hot_keys_are_spread_over_the_reducers(spark):
    n = 40_000
    inv = spark.range(100).select(F.concat(F.lit("d/"), F.col("id").cast("string")).alias("key"), F.lit(1).alias("size"))
    hot = F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 4 == 1, F.lit("d")).otherwise(
        F.concat(F.lit("x"), F.col("id").cast("string"))
    )
    man = spark.range(0, n, 1, 64).select(hot.cast("string").alias("key"))
    rows = _reducer_rows(spark, lambda: path_status(man, inv, hot_sample_fraction=1.0))
    assert sum(rows) == n and max(rows) < n / 4  # half of the rows are null, a quarter is one key
    plain = path_status(man, inv, split_hot_keys=False)
    split = path_status(man, inv, hot_sample_fraction=1.0)
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_every_hot_key_is_split_and_hot_keys_may_be_unknown(spark):
    from wordfold.operators.skew import hot_keys

    n = 30_000
    man = spark.range(0, n, 1, 32).select(F.concat(F.lit("k"), (F.col("id") % 1500).cast("string")).alias("key"))
    assert hot_keys(man, "key", min_share=1 / 3000, sample_fraction=1.0).count() == 1500
    assert hot_keys(man, "key", min_share=1 / 1000, sample_fraction=1.0).count() == 0
    inv = spark.createDataFrame([("k1", 5)], "key string, size bigint")  # all others are not in it
    got = Counter(r.status for r in path_status(man, inv, hot_share=1 / 3000, hot_sample_fraction=1.0).collect())
    assert got == {"file": n // 1500, "missing": n - n // 1500}

"""Rows without an id, or that share one, are each judged by their own text."""

from __future__ import annotations

import random
from collections import Counter

from wordfold.llm import decontaminate, mixing, quality, simhash

DOCS = "doc_id long, text string, lang string, source string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(3, 7))) for _ in range(n))


def bag(df) -> Counter:
    return Counter(df.collect())


def test_quality_judges_each_row(spark):
    rows = [(None, prose(1, 40), "en", "a"), (None, "too short", "en", "a"), (5, prose(2, 40), "en", "a"), (5, "short too", "en", "a")]
    df = spark.createDataFrame(rows, DOCS).repartition(2)
    assert Counter(tuple(r) for r in quality.quality_filter(df).collect()) == Counter([rows[0], rows[2]])


def test_decontamination_drops_only_what_holds_an_item(spark):
    item = prose(3, 40)
    rows = [(None, prose(4, 60), "en", "a"), (None, "x " + item + " y", "en", "a"), (7, prose(5, 50), "en", "a"), (7, item, "en", "a")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.decontaminate(spark.createDataFrame(rows, DOCS).repartition(2), bench)
    assert got.columns == ["doc_id", "text", "lang", "source"]
    assert Counter(tuple(r) for r in got.collect()) == Counter([rows[0], rows[2]])


def test_simhash_keeps_one_row_a_component(spark):
    a, b, c = (prose(i, 80) for i in (6, 7, 8))
    rows = [(None, a, "en", "1"), (None, a, "en", "2"), (None, b, "en", "3"), (9, b, "en", "4"), (9, c, "en", "5"), (9, c, "en", "6")]
    got = simhash.simhash_dedup(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(None, a), (9, b), (9, c)])


def test_mix_gives_each_row_its_own_counts(spark):
    rows = [(None, prose(i, 50 + i), "en", "a") for i in range(20)] + [(1, prose(30 + i, 64), "en", "b") for i in range(20)]
    got = mixing.mix_documents(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert Counter(r.text for r in got) == Counter(r[1] for r in rows)
    assert all(r.size == len(r.text.split()) and 0 <= r.taken <= 2 * r.size for r in got)
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.05 * mine[0].target + mixing.BLOCK

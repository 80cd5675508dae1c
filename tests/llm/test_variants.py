"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from wordfold.llm import variants


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(counts: Counter, min_count: int = 3) -> set:
    words = {w: n for w, n in counts.items() if n >= min_count}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    form, n_near = {}, {}
    for w, n in words.items():
        found = [o for k in (-1, 0, 1) for o in by_length[len(w) + k] if near(w, o)]
        best = min(found, key=lambda o: (-words[o], o), default=None)
        form[w], n_near[w] = best if best is not None and words[best] >= 2 * n else None, len(found)

    def root(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, n_near[w], words.get(form[w])) for w, n in words.items()}


def slow_runs(docs: list, garbled: int = 97) -> Counter:
    total: Counter = Counter()
    for i, t in docs:
        for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            x = "".join(c.lower() if "A" <= c <= "Z" else c for c in x)
            h = zlib.crc32(f"{'' if i is None else i}:{x}".encode())
            if h % garbled == 0:
                x = x[: h % len(x)] + x[h % len(x) + 1 :]
            total[x] += len(x) >= 5
    return +total


def answer(df) -> set:
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, counts: Counter):
    return spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], "word string, n long, id string, nodes int").repartition(3)


@pytest.mark.parametrize("partitions", ["1", "8", "60"])
def test_random_words(spark, partitions):
    r = random.Random(int(partitions))
    counts = Counter()
    for letters, least, most, n in (("ab", 1, 7, 150), ("abcé\U0001f600", 3, 6, 300), ("xyz", 5, 9, 200), ("a", 1, 12, 30)):
        for _ in range(n):
            counts["".join(r.choices(letters, k=r.randint(least, most)))] = int(r.paretovariate(0.5))
    counts["a" * 3000 + "b"], counts["a" * 3000 + "c"], counts["a" * 3000] = 9, 3, 40
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert answer(variants.spelling_variants(frame(spark, counts))) == slow(counts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_long_chains_of_forms(spark):
    counts = Counter({"b" * i + "a" * (40 - i): 3 * 2**i for i in range(40)})
    got = answer(variants.spelling_variants(frame(spark, counts)))
    assert got == slow(counts) and {r[2] for r in got} == {"b" * 39 + "a"}


def test_words_given_twice_and_nulls(spark):
    df = spark.createDataFrame([("spell", 2), ("spell", 2), ("spelt", 9), (None, 50), ("empty", None), ("", 7), ("x", 3)], "word string, n long")
    assert answer(variants.spelling_variants(df)) == slow(Counter({"spell": 4, "spelt": 9, "": 7, "x": 3}))
    assert variants.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.spelling_variants(df, times=1)


def test_runs_of_documents(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD", 50)
    r = random.Random(4)
    words = ["".join(r.choices("abÀéÿ×z", k=r.randint(3, 8))) for _ in range(60)]
    docs = [(i if i % 5 else None, " ".join(r.choice([w, w.title(), w.upper()]) + r.choice([" ", "-", "1", "Ā", "\n"]) for w in r.choices(words, k=200))) for i in range(60)]
    docs += [(7, None), (None, ""), (8, "x" * 100_000), (8, "!" * 1000), (9, docs[1][1]), (9, docs[1][1])]
    df = spark.createDataFrame([(*d, "q") for d in docs], "doc_id long, text string, word string").repartition(4)
    got = {r.word: r.n for r in variants.letter_runs(df, garbled=7).collect()}
    assert got == slow_runs(docs, 7)
    assert answer(variants.spelling_variants(variants.letter_runs(df, garbled=7))) == slow(slow_runs(docs, 7))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert answer(variants.q_variants(spark, sf)) == slow(slow_runs(docs))

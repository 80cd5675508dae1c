"""Merkle fingerprints against a plain tree, and edits that are found where they were made."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from wordfold.llm import merkle

DOCS = "doc_id long, text string, _key string, _part string, root string, fingerprint string"


def md5(s: str) -> str:
    return hashlib.md5(s.encode()).hexdigest()


def slow_tree(text: str):
    """``root, sections`` with each section a list of ``(paragraph hash, leaves)``."""
    lines = text.split("\n")
    sections, now = [], []
    for i, line in enumerate(lines):
        leaves = [md5(m.group()) for m in re.finditer(r"[^.!?]{1,96}[.!?]*[ \t\n\x0b\f\r]*|[.!?]+[ \t\n\x0b\f\r]*", line)]
        h = md5("p" + "".join(leaves))
        now.append((h, leaves))
        if i == len(lines) - 1 or line == "" or h[0] < "4":
            sections.append(now)
            now = []
    root = hashlib.sha256(("r" + "".join(md5("s" + "".join(h for h, _ in s)) for s in sections)).encode()).hexdigest()
    return root, sections


def slow_print(text: str) -> str:
    root, sections = slow_tree(text)
    return root + ":" + ";".join(",".join("".join(x[:8] for x in leaves) for _, leaves in s) for s in sections)


def slow_likeness(a: str, b: str) -> float:
    x, y = (set(re.findall("[0-9a-f]{8}", p.split(":")[1])) for p in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return "".join("".join(r.choices("abcdé\U0001f600", k=r.randint(1, 9))) + r.choice([" ", " ", ". ", "\n", "!? ", "\n\n"]) for _ in range(n))


TEXTS = [
    "", None, "\n", "\n\n", " ", ".", "...\t..", "a", "a" * 1000, "é" * 97 + "." + "x" * 96 + "!  \x0b y", "\U0001f600" * 200, "one. two.\nthree",
    "a.b.c" * 500, "\r\n\r\n x", prose(1, 30), prose(2, 300), prose(3, 20000), "\n" * 3000, "z" * 200_000,
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], DOCS).repartition(3)


def slow_pairs(rows):
    """Each row with its next one's text; ties of both id and text are equal rows."""
    import xxhash

    h = lambda t: (lambda v: v - 2**64 if v >= 2**63 else v)(xxhash.xxh64_intdigest(t.encode(), 42))
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -h(r[1])))
    out = Counter()
    for (i, t), (_, other) in zip(order, order[1:] + order[:1]):
        k = len(t) // 2
        edited = t[: len(t) - k] + other[:k]
        a, b, c = slow_print(t), slow_print(edited), slow_print(other)
        out[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, slow_likeness(a, b), slow_likeness(a, c)] += 1
    return out


def answer(spark, df, tmp_path):
    df.drop("_key").write.parquet(str(tmp_path / "documents.parquet"))
    return Counter(map(tuple, merkle.q_fingerprints(spark, str(tmp_path)).collect()))


@pytest.mark.parametrize("partitions", ["1", "3", "50"])
def test_query_on_odd_texts(spark, tmp_path, partitions):
    rows = list(enumerate(TEXTS)) + [(None, "n"), (None, "m"), (None, None), (3, "x"), (3, "y"), (3, "y"), (-9, "é")]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert answer(spark, frame(spark, rows), tmp_path) == slow_pairs(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_document_and_none(spark, tmp_path):
    for n in (1, 0):
        rows = [(4, "a.b c")][:n]
        assert answer(spark, frame(spark, [(4, "a.b c")]).limit(n), tmp_path / str(n)) == slow_pairs(rows)


def test_many_rows_without_an_id_are_cut_into_ranges(spark):
    from pyspark.sql import functions as F

    rows = [(None, f"t{i}") for i in range(400)] + [(i, f"u{i}") for i in range(400)]
    got = merkle.with_next(frame(spark, rows).select("doc_id", "text"), {"next": "text"}).withColumn("task", F.spark_partition_id())
    n = got.groupBy("task").count().agg(F.max("count")).first()[0]
    assert got.count() == 800 and n < 400
    follow = {r.text: r.next for r in got.collect()}
    at, seen = "u399", set()
    while at not in seen:  # one circle through all
        seen.add(at)
        at = follow[at]
    assert len(seen) == 800 and follow["u7"] == "u6"


def test_equal_roots_are_equal_texts(spark):
    texts = [prose(i % 7, 40) for i in range(20)] + ["a\n\nb", "a\nb", "ab", "a", "a\n", "\na", "a ", "a. b", "a.b", ""]
    df = merkle.document_trees(frame(spark, list(enumerate(texts))))
    roots = {r.doc_id: r.root for r in df.collect()}
    for i, a in enumerate(texts):
        assert all((roots[i] == roots[j]) == (a == b) for j, b in enumerate(texts))


def test_trees_tell_where_paragraphs_are(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for r in merkle.document_trees(frame(spark, rows)).collect():
        text = rows[r.doc_id][1] or ""
        root, sections = slow_tree(text)
        assert (r.root, r.n_chars) == (root, len(text))
        assert [[p.hash for p in s.paragraphs] for s in r.sections] == [[h for h, _ in s] for s in sections]
        parts = [text[p.first : p.first + p.n_chars] for s in r.sections for p in s.paragraphs]
        assert "\n".join(parts) == text and [p.place for s in r.sections for p in s.paragraphs] == list(range(len(parts)))


def test_edits_are_located(spark):
    r = random.Random(8)
    old, new, want = [], [], Counter()
    for d in range(30):
        lines = [f"{d} line {i}. " + prose(1000 * d + i, 12).replace("\n", " ") for i in range(25)]
        other = list(lines)
        at = r.randrange(25)
        if d % 3 == 0:
            other[at] += " changed"
        elif d % 3 == 1:
            other.insert(at, "wholly new")
        elif d % 3 == 2:
            del other[at]
        old.append((d, "\n".join(lines)))
        new.append((d, "\n".join(other)))
        for what, mine, its in (("removed", lines, other), ("added", other, lines)):
            first = 0
            for p, x in enumerate(mine):
                if x not in its:
                    want[d, what, p, first, len(x)] += 1
                first += len(x) + 1
    old.append((99, "only old"))
    new += [(98, None)]
    old.append((98, ""))
    got = merkle.tree_edits(frame(spark, old), frame(spark, new))
    assert Counter(map(tuple, got.collect())) == want
    assert merkle.tree_edits(frame(spark, old), frame(spark, old)).count() == 0


def test_plan_is_sql_only(spark):
    from wordfold.plans.inspect import plan_text

    plan = plan_text(merkle.q_fingerprints(spark, "/root/testdata/sf0.001"))
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan

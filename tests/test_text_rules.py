"""Line and word rules (FIXTURES.md F2), checked against fixed cases, the JVM's
own ``Pattern.split`` and the file reader."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from wordfold.functions.text import split_lines, split_words
from wordfold.sources.text import lines_from_column, read_text_lines

NBSP = "\u00a0"

WORD_CASES = [
    ("", [""]),
    (" ", []),
    ("   ", []),
    ("a", ["a"]),
    ("a ", ["a"]),
    ("a  ", ["a"]),
    (" a", ["", "a"]),
    ("a  b", ["a", "", "b"]),
    ("  a b  ", ["", "", "a", "b"]),
    ("\t", ["\t"]),
    ("a\t", ["a\t"]),
    ("a\tb", ["a\tb"]),
    (" \t ", ["", "\t"]),
    ("a \t", ["a", "\t"]),
    ("a" + NBSP + " b", ["a" + NBSP, "b"]),
    ("Word, word. WORD", ["Word,", "word.", "WORD"]),
]


def _words(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    rows = df.select("i", split_words("s").alias("w")).collect()
    return {r["i"]: list(r["w"]) for r in rows}


def test_word_split_fixed_cases(spark):
    got = _words(spark, [c for c, _ in WORD_CASES])
    for i, (line, want) in enumerate(WORD_CASES):
        assert got[i] == want, repr(line)


def test_word_split_matches_java_split(spark):
    rng = random.Random(7)
    alphabet = [" ", "\t", "a", "é"]
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(400)]
    got = _words(spark, lines)
    pattern = spark.sparkContext._jvm.java.util.regex.Pattern.compile(" ")
    for i, line in enumerate(lines):
        assert got[i] == list(pattern.split(line)), repr(line)


COLUMN_LINE_CASES = [
    ("a\n\n", ["a", ""]),
    ("a\r\n", ["a"]),
    ("\n", [""]),
    ("a\n\r\n", ["a", ""]),
    ("a", ["a"]),
    ("", []),
    ("a\r\nb\rc\n\nd", ["a", "b", "c", "", "d"]),
    ("a\rb\r", ["a", "b"]),
    ("x y\x0bz\x0c\u0085w", ["x y\x0bz\x0c\u0085w"]),
]


def test_lines_from_column_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(COLUMN_LINE_CASES)], "i int, text string")
    got = {r["i"]: list(r["l"]) for r in df.select("i", split_lines("text").alias("l")).collect()}
    for i, (text, want) in enumerate(COLUMN_LINE_CASES):
        assert got[i] == want, repr(text)


def test_lines_from_column_null_text_has_no_lines(spark):
    df = spark.createDataFrame([(1, None), (2, "a\nb")], "id int, text string")
    rows = lines_from_column(df, "text", keep=("id",)).collect()
    assert [(r["id"], r["line"]) for r in rows] == [(2, "a"), (2, "b")]


FILE_CASES = [
    (b"a\r\nb\rc\n\nd", ["a", "b", "c", "", "d"]),
    (b"\xef\xbb\xbfx y\n", ["x y"]),
    (b"", []),
    (b"\n", [""]),
    (b"a\n\n", ["a", ""]),
    (b"\xff\xfe a\n", ["\ufffd\ufffd a"]),
    ("x y\x0bz\x0c\u0085w\n".encode(), ["x y\x0bz\x0c\u0085w"]),
]


@pytest.mark.parametrize("data,want", FILE_CASES)
def test_text_file_lines(spark, tmp_path, data, want):
    p = tmp_path / "f.txt"
    p.write_bytes(data)
    got = [r["value"] for r in read_text_lines(spark, str(p)).collect()]
    assert got == want


def test_file_lines_equal_column_lines(spark, tmp_path):
    """The in-column rule gives the same lines as the file reader."""
    rng = random.Random(11)
    alphabet = ["a", " ", "\n", "\r", "b"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    for i, t in enumerate(texts):
        (tmp_path / f"t{i:03d}.txt").write_bytes(t.encode())
    files = (
        read_text_lines(spark, str(tmp_path))
        .select(F.regexp_extract(F.input_file_name(), r"t(\d+)\.txt$", 1).cast("int").alias("i"), "value")
        .collect()
    )
    by_file: dict[int, list[str]] = {i: [] for i in range(len(texts))}
    for r in files:
        by_file[r["i"]].append(r["value"])
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    col = {r["i"]: list(r["l"]) for r in df.select("i", split_lines("text").alias("l")).collect()}
    for i, t in enumerate(texts):
        assert col[i] == by_file[i], repr(t)


def test_word_split_matches_java_on_every_document_line(spark):
    """Whole sf0.001 documents table: every line split by Spark equals the JVM's split."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = lines_from_column(docs, "text").select("line", split_words("line").alias("w")).collect()
    pattern = spark.sparkContext._jvm.java.util.regex.Pattern.compile(" ")
    assert rows
    for r in rows:
        assert list(r["w"]) == list(pattern.split(r["line"])), repr(r["line"][:80])


def test_column_lines_match_java_line_reader(spark):
    """Every sf0.001 text split into lines equals java.io.BufferedReader.readLine's lines."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: list(r["l"]) for r in docs.select("doc_id", split_lines("text").alias("l")).collect()}
    jvm = spark.sparkContext._jvm
    for r in docs.collect():
        reader = jvm.java.io.BufferedReader(jvm.java.io.StringReader(r["text"]))
        want = []
        line = reader.readLine()
        while line is not None:
            want.append(line)
            line = reader.readLine()
        assert got[r["doc_id"]] == want, r["doc_id"]

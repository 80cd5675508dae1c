"""The command line runs the jobs on the active session."""

from __future__ import annotations

import json

import pytest

from wordfold.cli import main


def run(capsys, spark, argv):
    assert main(argv, spark=spark) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_top_words_from_files(spark, tmp_path, capsys):
    (tmp_path / "first.txt").write_text("b a b\n", encoding="utf-8")
    (tmp_path / "second.txt").write_text("b c\n", encoding="utf-8")
    out = str(tmp_path / "report")
    argv = ["top-words", "--input", str(tmp_path / "first.txt"), "--input", str(tmp_path / "second.txt")]
    got = run(capsys, spark, argv + ["--output", out, "--k", "2"])
    assert got == {"report": out}
    assert [r.value for r in spark.read.text(out).collect()] == ["3 b", "1 a"]


def test_int_jobs(spark, tmp_path, capsys):
    path = str(tmp_path / "ints")
    spark.createDataFrame([(2147483647,), (5,), (-2,), (None,)], "x int").write.parquet(path)
    assert run(capsys, spark, ["int-sum", "--table", path, "--column", "x"]) == {"int_sum": 2147483650}
    assert run(capsys, spark, ["int-sum", "--table", path, "--column", "x", "--wrap32"]) == {"int_sum_wrap32": -2147483646}
    assert run(capsys, spark, ["even-count", "--table", path, "--column", "x"]) == {"even_count": 1}


def test_list_and_status(spark, tmp_path, capsys):
    inv = str(tmp_path / "inv")
    man = str(tmp_path / "man")
    spark.createDataFrame([("a/b", 3), ("c", 1)], "key string, size bigint").write.parquet(inv)
    spark.createDataFrame([("a",), ("c",), ("z",)], "key string").write.parquet(man)
    out = str(tmp_path / "listing")
    run(capsys, spark, ["list", "--inventory", inv, "--output", out])
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("a", True, 0, "a"), ("c", False, 1, "c")]
    with pytest.raises(SystemExit):  # a listing is never cut to what fits a screen
        main(["list", "--inventory", inv], spark=spark)
    out = str(tmp_path / "status")
    run(capsys, spark, ["status", "--inventory", inv, "--manifest", man, "--output", out])
    got = {r.key: r.status for r in spark.read.parquet(out).collect()}
    assert got == {"a": "dir", "c": "file", "z": "missing"}

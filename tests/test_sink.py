"""Text sink: rank order survives the write; overwrite replaces."""

from __future__ import annotations

import os

import pytest

from wordfold.plans.jobs import write_top_words_report
from wordfold.plans.queries import QUERIES
from wordfold.session import new_output_path, shared_dir
from wordfold.sinks import write_text

SF01 = "/root/testdata/sf0.01"


def part_files(path):
    return sorted(f for f in os.listdir(path) if f.startswith("part-"))


def test_report_written_as_one_ordered_part_file(spark):
    path = new_output_path(spark, "report")
    write_text(QUERIES["top_words_report"](spark, SF01), path)
    parts = part_files(path.replace("file:", ""))
    assert len(parts) == 1
    with open(os.path.join(path.replace("file:", ""), parts[0]), encoding="utf-8") as fh:
        lines = fh.read().split("\n")
    assert lines[-1] == "" and len(lines) == 101
    ranked = [(int(line.split(" ", 1)[0]), line.split(" ", 1)[1]) for line in lines[:-1]]
    assert ranked == sorted(ranked, key=lambda t: (-t[0], t[1].encode("utf-8")))


def test_roundtrip_equals_report(spark):
    back = [r.value for r in QUERIES["report_roundtrip"](spark, SF01).collect()]
    direct = [r.value for r in QUERIES["top_words_report"](spark, SF01).collect()]
    assert back == direct


def test_overwrite_replaces(spark):
    path = new_output_path(spark, "overwrite")
    write_text(spark.createDataFrame([("old",)] * 3, "value string"), path)
    write_text(spark.createDataFrame([("new",)], "value string"), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["new"]


def test_sink_needs_one_column(spark):
    with pytest.raises(ValueError):
        write_text(spark.createDataFrame([(1, "a")], "n int, w string"), new_output_path(spark, "x"))


def test_files_job_end_to_end(spark, tmp_path):
    (tmp_path / "first.txt").write_text("the cat\nthe dog\n", encoding="utf-8")
    (tmp_path / "second.txt").write_text("a cat  the\n", encoding="utf-8")
    out = write_top_words_report(
        spark, [str(tmp_path / "first.txt"), str(tmp_path / "second.txt")], new_output_path(spark, "texts")
    )
    assert [r.value for r in spark.read.text(out).collect()] == ["3 the", "2 cat", "1 ", "1 a", "1 dog"]


def test_shared_dir_comes_from_session(spark):
    assert shared_dir(spark).startswith(("file:", "/")) and "checkpoints" in shared_dir(spark)


def test_shared_dir_is_never_a_local_fallback_on_a_cluster():
    from wordfold import session as ws

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError):
        ws.shared_dir(Session())

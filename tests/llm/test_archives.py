"""Archives whose records are long or damaged, and ids that are no integers."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from wordfold.llm import warc

PAGES = "page_id long, url string, html string"


def noise(seed: int, n: int) -> str:
    r = random.Random(seed)
    return "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=n))


@pytest.mark.parametrize("size", [700, 1 << 16, 1 << 22])
def test_headers_of_any_length(spark, size):
    urls = {1: "http://a/", 2: "http://b/" + noise(1, 4_000_000), 3: "http://c/" + "x" * 1_500_000, 4: None, 5: "é" * 400_000}
    rows = [(i, u, f"<p>{i % 2}</p>") for i, u in urls.items()]
    files = warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(2))
    if size < 4096:  # so many small ranges are for small files
        files = files.where("size < 100000")
        rows = [r for r in rows if r[0] in {x.page_id for x in warc.read_warc(files).collect()}]
    got = warc.read_warc(files, size)
    assert Counter(r.page_id for r in got.collect()) == Counter(r[0] for r in rows)
    assert warc.short_archives(files, got).count() == 0
    if size > 4096:
        assert {r.page_id: r.url for r in got.collect()}[2] == urls[2]
        less = got.where("page_id <> 2")
        assert [(r.records - r.found) for r in warc.short_archives(files, less).collect()] == [1]


def test_ids_of_other_types(spark):
    rows = [("a b", "u", "x"), ("", "u", "x"), (None, "u", "y"), ("ü:<>%/1", "u", "y"), ("zz", "u", "x")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = warc.read_warc(warc.write_warc(df), id_type="string").select("page_id", "record_type", "refers_to").collect()
    want = [("", "response", None), ("a b", "revisit", ""), ("zz", "revisit", ""), ("ü:<>%/1", "response", None), (None, "revisit", "ü:<>%/1")]
    assert Counter(map(tuple, got)) == Counter(want)
    dates = df.selectExpr("date_add(DATE'2020-01-01', length(html)) AS page_id", "url", "html")
    got = warc.read_warc(warc.write_warc(dates.limit(2)), id_type="date").collect()
    assert {str(r.page_id) for r in got} == {"2020-01-02"}


def test_damage_is_an_error(spark):
    files = warc.write_warc(spark.createDataFrame([(i, "u", noise(i, 5000)) for i in range(3)], PAGES).coalesce(1))
    path = files.first().path
    fs, inside = warc.filesystem(path)
    data = fs.open_input_file(inside).read()
    for name, bad in (("cut", data[:-900]), ("flipped", data[:2500] + bytes([data[2500] ^ 255]) + data[2501:])):
        other = f"{path}.{name}"
        with fs.open_output_stream(f"{inside}.{name}", compression=None) as out:
            out.write(bad)
        df = spark.createDataFrame([(other, len(bad), 3)], "path string, size long, records long")
        with pytest.raises(Exception, match="damaged"):
            warc.read_warc(df).collect()


def test_other_members_are_passed_over(spark):
    import gzip

    files = warc.write_warc(spark.createDataFrame([(i, "u", f"page {i}") for i in range(3)], PAGES).coalesce(1))
    path = files.first().path
    fs, inside = warc.filesystem(path)
    data = gzip.compress(b"not an archive") + b"\x1f\x8b\x08" + fs.open_input_file(inside).read() + gzip.compress(b"WAR") + b"\x1f\x8b\x08\x00"
    with fs.open_output_stream(f"{inside}.odd", compression=None) as out:
        out.write(data)
    df = spark.createDataFrame([(f"{path}.odd", len(data), 3)], "path string, size long, records long")
    for size in (50, 1 << 20):
        assert sorted(r.page_id for r in warc.read_warc(df, size).collect()) == [0, 1, 2]

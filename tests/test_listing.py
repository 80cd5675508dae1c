"""Listing and manifest status over a key inventory (FIXTURES.md F3)."""

from __future__ import annotations

import pytest

from wordfold.operators import list_children, path_key, path_status
from wordfold.plans.inspect import read_schemas
from wordfold.sources import keys_from_files, object_inventory

INVENTORY = [
    ("a/b.txt", 10),
    ("a/c/", 0),
    ("d/", 0),
    ("d/x", 5),
    ("e/", 7),
    ("f_$folder$", 0),
    ("f/g", 1),
    ("h", 0),
]

STATUS = {
    "": ("dir", None),
    "a": ("dir", None),
    "a/b.txt": ("file", 10),
    "a/c": ("empty_dir", None),
    "d": ("empty_dir", None),
    "e": ("file", 7),
    "f": ("dir", None),
    "h": ("file", 0),
    "zzz": ("missing", None),
    "a/": ("dir", None),
    "a/c/": ("empty_dir", None),
    "d/x/": ("missing", None),
}


@pytest.fixture()
def inv(spark):
    return spark.createDataFrame(INVENTORY, "key string, size bigint")


def listing(df):
    return sorted((r.name, r.is_dir, r.length) for r in df.collect())


def test_path_status(spark, inv):
    manifest = spark.createDataFrame([(k,) for k in STATUS], "key string")
    got = {r.key: (r.status, r.length) for r in path_status(manifest, inv).collect()}
    assert got == STATUS


def test_path_status_keeps_manifest_rows_and_columns(spark, inv):
    manifest = spark.createDataFrame([("a", 1), ("a", 2), ("zzz", 3)], "key string, tag int")
    got = sorted((r.tag, r.key, r.status) for r in path_status(manifest, inv).collect())
    assert got == [(1, "a", "dir"), (2, "a", "dir"), (3, "zzz", "missing")]


def test_status_of_empty_inventory(spark):
    empty = spark.createDataFrame([], "key string, size bigint")
    manifest = spark.createDataFrame([("",), ("a",)], "key string")
    got = {r.key: r.status for r in path_status(manifest, empty).collect()}
    assert got == {"": "missing", "a": "missing"}


def test_root_listing(inv):
    assert listing(list_children(inv, "")) == [
        ("a", True, 0),
        ("d", True, 0),
        ("e", True, 0),
        ("f", True, 0),
        ("h", False, 0),
    ]


def test_dir_listings(inv):
    assert listing(list_children(inv, "a")) == [("b.txt", False, 10), ("c", True, 0)]
    assert listing(list_children(inv, "a/")) == [("b.txt", False, 10), ("c", True, 0)]
    assert listing(list_children(inv, "/d/")) == [("x", False, 5)]
    assert listing(list_children(inv, "a/c")) == []


def test_listing_a_file_gives_the_file(inv):
    assert listing(list_children(inv, "a/b.txt")) == [("b.txt", False, 10)]
    assert listing(list_children(inv, "h")) == [("h", False, 0)]
    # a non-empty "e/" object is a file named e
    assert listing(list_children(inv, "e")) == [("e", False, 7)]


def test_missing_lists_nothing(inv):
    assert listing(list_children(inv, "zzz")) == []


def test_exact_file_wins_over_children(spark):
    inv = spark.createDataFrame([("p", 3), ("p/q", 4)], "key string, size bigint")
    assert listing(list_children(inv, "p")) == [("p", False, 3)]
    assert listing(list_children(inv, "")) == [("p", False, 3), ("p", True, 0)]


def test_empty_names_and_newlines(spark):
    inv = spark.createDataFrame([("a//b", 1), ("a/c", 2), ("/x", 3), ("n\n", 4), ("n\n/z", 5)], "key string, size bigint")
    assert listing(list_children(inv, "a")) == [("c", False, 2)]
    assert listing(list_children(inv, "")) == [("a", True, 0), ("n\n", False, 4), ("n\n", True, 0)]
    assert listing(list_children(inv, "n\n")) == [("n\n", False, 4)]
    assert [r.key for r in list_children(inv, "a").collect()] == ["a/c"]


def test_path_key():
    assert path_key("") == "" and path_key("/") == ""
    assert path_key("/a//b/") == "a/b"


def test_object_inventory_reads_metadata_only(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "one.txt").write_bytes(b"12345")
    (tmp_path / "two.txt").write_bytes(b"1")
    files = object_inventory(spark, str(tmp_path))
    assert all("content" not in schema for schema in read_schemas(files))
    inv = keys_from_files(files)
    assert inv.columns == ["key", "size", "mtime"]
    keys = sorted((r.key, r.size) for r in inv.collect())
    root = str(tmp_path).lstrip("/")
    assert keys == [(f"{root}/two.txt", 1), (f"{root}/x/one.txt", 5)]
    # a listing over the real files: files carry their modification time
    rows = sorted(list_children(inv, str(tmp_path)).collect())
    assert [r[:3] for r in rows] == [("two.txt", False, 1), ("x", True, 0)]
    assert rows[0].mtime is not None and rows[1].mtime is None


def test_mtime_is_carried_for_files_only(spark):
    import datetime as dt

    t = [dt.datetime(2024, 1, 2, h) for h in range(8)]
    inv = spark.createDataFrame(
        [(k, s, t[i]) for i, (k, s) in enumerate(INVENTORY)], "key string, size bigint, mtime timestamp"
    )
    root = {r.name: (r.is_dir, r.length, r.mtime) for r in list_children(inv, "").collect()}
    assert root["h"] == (False, 0, t[7]) and root["a"] == (True, 0, None)
    assert [tuple(r) for r in list_children(inv, "e").collect()] == [("e", False, 7, "e", t[4])]
    manifest = spark.createDataFrame([("a/b.txt",), ("e",), ("d",), ("a",)], "key string")
    got = {r.key: (r.status, r.length, r.mtime) for r in path_status(manifest, inv).collect()}
    assert got == {
        "a/b.txt": ("file", 10, t[0]),
        "e": ("file", 7, t[4]),
        "d": ("empty_dir", None, None),
        "a": ("dir", None, None),
    }


def test_strict_listing_raises_for_a_missing_path(inv):
    from wordfold.operators import path_exists

    assert path_exists(inv, "") and path_exists(inv, "a") and path_exists(inv, "h") and path_exists(inv, "d")
    assert not path_exists(inv, "zzz") and not path_exists(inv, "a/b")
    with pytest.raises(FileNotFoundError):
        list_children(inv, "zzz", strict=True)
    assert listing(list_children(inv, "a", strict=True)) == [("b.txt", False, 10), ("c", True, 0)]


def test_path_status_keeps_odd_manifest_column_names(spark, inv):
    manifest = spark.createDataFrame([("a", 1)], "key string, `tag.id` int")
    rows = path_status(manifest, inv).collect()
    assert rows[0]["tag.id"] == 1 and rows[0]["status"] == "dir"


def test_repeated_inventory_keys_fold_like_a_dedupe(spark, inv):
    doubled = inv.unionByName(spark.createDataFrame([("a/b.txt", 3), ("h", 0), ("e/", 2)], "key string, size bigint"))
    deduped = doubled.groupBy("key").agg({"size": "max"}).withColumnRenamed("max(size)", "size")
    for path in ("", "a", "e"):
        assert listing(list_children(doubled, path)) == listing(list_children(deduped, path))
    manifest = spark.createDataFrame([(k,) for k in STATUS], "key string")
    a = sorted(tuple(r) for r in path_status(manifest, doubled).collect())
    b = sorted(tuple(r) for r in path_status(manifest, deduped).collect())
    assert a == b


# every name that path_status or key_facts gives a column of its own
HELPERS = """row stem hot salt s k key n size parts j kind mtime plain_found plain_size plain_mtime slashed_found slashed_size
slashed_mtime has_children root_has_keys _stem _hot _salt _s status length""".split()


@pytest.mark.parametrize("split", [True, False])
def test_path_status_with_any_manifest_column_names(spark, inv, split):
    keys = ["a", "a/b.txt", "missing", None, "", "d/"]
    names = [*HELPERS, "a.b", "a b", "we`ird"]
    manifest = spark.createDataFrame([(k, *[f"{c} {i}" for c in names]) for i, k in enumerate(keys)], ["path", *names])
    got = path_status(manifest, inv, "path", split_hot_keys=split, hot_sample_fraction=1.0)
    kept = [c for c in names if c not in ("status", "length")]
    assert got.columns == ["path", *kept, "status", "length"]
    plain = path_status(manifest.select("path"), inv, "path", split_hot_keys=False)
    by_key = {r.path: (r.status, r.length) for r in plain.collect()}
    want = {(k, *[f"{c} {i}" for c in kept], *by_key[k]) for i, k in enumerate(keys)}
    assert {tuple(r) for r in got.collect()} == want


def test_path_status_replaces_its_result_columns_in_any_case(spark, inv):
    got = path_status(spark.createDataFrame([("a", "x", "y")], ["path", "Status", "LENGTH"]), inv, "path")
    assert got.columns == ["path", "status", "length"] and got.first().status == "dir"


@pytest.mark.parametrize("name", ["stem", "we`ird"])
def test_path_status_with_any_key_column_name(spark, inv, name):
    keys = ["a", "a/b.txt", "missing", None, ""]
    plain = path_status(spark.createDataFrame([(k,) for k in keys], ["path"]), inv, "path")
    got = path_status(spark.createDataFrame([(k,) for k in keys], [name]), inv, name)
    assert got.columns[0] == name and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)

"""path_status and list_children against a brute-force model on random inventories.

The model follows the lookup order of a bucket client: exact object, then the
``key/`` marker object, then "is anything stored under ``key/``?"; a listing
first asks for the path's status and then walks the keys under it with ``/`` as
the delimiter.
"""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from wordfold.operators import list_children, path_key, path_status

SEGMENT = st.sampled_from(["a", "b", "c", "", "a\n", "a_$folder$"])
KEY = st.builds(
    lambda segs, slash: "/".join(segs) + ("/" if slash else ""),
    st.lists(SEGMENT, min_size=1, max_size=3),
    st.booleans(),
)
INVENTORY = st.dictionaries(KEY, st.sampled_from([0, 0, 1, 7]), max_size=8)


def model_status(inv: dict[str, int], key: str) -> tuple[str, int | None]:
    if key != "":
        if key in inv:
            if key.endswith("/") and inv[key] == 0:
                return "empty_dir", None
            return "file", inv[key]
        if not key.endswith("/") and key + "/" in inv:
            size = inv[key + "/"]
            return ("empty_dir", None) if size == 0 else ("file", size)
    prefix = key if key == "" or key.endswith("/") else key + "/"
    if any(k.startswith(prefix) for k in inv):
        return "dir", None
    return "missing", None


def model_listing(inv: dict[str, int], path: str) -> list[tuple[str, bool, int, str]]:
    key = path_key(path)
    status, size = model_status(inv, key)
    if status == "missing":
        return []
    if status == "file":
        return [(key.rsplit("/", 1)[-1], False, size, key)]
    prefix = key + "/" if key else ""
    out = set()
    for k, sz in inv.items():
        if not k.startswith(prefix) or k == prefix:
            continue
        rest = k[len(prefix) :]
        name = rest.split("/", 1)[0]
        if name == "":
            continue  # "a//b" under "a" is "a" itself again
        if "/" in rest:
            out.add((name, True, 0, prefix + name))
        elif not rest.endswith("_$folder$"):
            out.add((name, False, sz, prefix + name))
    return sorted(out)


def manifest_keys(inv: dict[str, int]) -> list[str]:
    keys = {""}
    for k in inv:
        for i in range(1, len(k) + 1):
            keys.add(k[:i])
        keys.add(k + "x")
    return sorted(keys)


@settings(max_examples=15, deadline=None, derandomize=True)
@given(INVENTORY)
def test_path_status_matches_model(spark, inv):
    df = spark.createDataFrame(list(inv.items()), "key string, size bigint")
    keys = manifest_keys(inv)
    manifest = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r.key: (r.status, r.length) for r in path_status(manifest, df, split_hot_keys=False).collect()}
    assert got == {k: model_status(inv, k) for k in keys}


@settings(max_examples=10, deadline=None, derandomize=True)
@given(INVENTORY, st.sampled_from(["", "a", "b", "a/b", "a/c", "a\n", "a_$folder$"]))
def test_list_children_matches_model(spark, inv, path):
    df = spark.createDataFrame(list(inv.items()), "key string, size bigint")
    got = sorted(tuple(r) for r in list_children(df, path).collect())
    assert got == model_listing(inv, path)

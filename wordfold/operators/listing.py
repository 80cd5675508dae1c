"""Object-store metadata questions as table jobs over a key inventory.

The inventory is ``key string, size bigint`` and optionally ``mtime timestamp``
(one row per object key, see ``wordfold.sources.inventory``; a key that
repeats counts once, with its largest size and mtime, so an inventory need not
be deduplicated first). Keys use ``/``
as the directory delimiter. A key ending in ``/`` with size 0 is a directory
marker. When the inventory has ``mtime``, file rows of the results carry it
(directories have none).

* ``list_children`` answers a delimiter listing of one directory.
* ``path_status`` answers "file, empty_dir, dir or missing?" for a whole
  manifest of keys with one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordfold.operators.skew import hot_keys

# Fixed values of the listing rules.
DELIMITER = "/"
# Object keys with this suffix are folder placeholders and are never listed.
FOLDER_SUFFIX = "_$folder$"
STATUS_FILE = "file"
STATUS_EMPTY_DIR = "empty_dir"
STATUS_DIR = "dir"
STATUS_MISSING = "missing"

MTIME = "mtime"

# A key with one trailing delimiter removed (its "stem").
_STEM_SQL = "CASE WHEN endswith({c}, '/') THEN substring({c}, 1, length({c}) - 1) ELSE {c} END"

_MAX_LEN = 2**31 - 1


def _has_mtime(inventory: DataFrame) -> bool:
    return MTIME in inventory.columns


def path_key(path: str) -> str:
    """Key form of a path: no leading, trailing or repeated delimiters; root is ``''``."""
    return DELIMITER.join(p for p in path.split(DELIMITER) if p)


def _file_status_of(inventory: DataFrame, key: str) -> DataFrame:
    """``parent, length``: one row if ``key`` is a file, else none.

    A file is the exact key, or a ``key/`` object of non-zero size. Both
    candidate keys group to ``key``, so the result has at most one row.
    """
    k = F.col("key")
    size = F.col("size").cast("bigint")
    marker = key + DELIMITER
    has_exact = F.col("has_exact")
    aggs = [
        F.bool_or(k == key).alias("has_exact"),
        F.max(F.when(k == key, size)).alias("exact"),
        F.max(F.when(k == marker, size)).alias("marker"),
    ]
    out = [F.when(has_exact, F.col("exact")).otherwise(F.col("marker")).alias("length")]
    if _has_mtime(inventory):
        aggs += [
            F.max(F.when(k == key, F.col(MTIME))).alias("exact_mtime"),
            F.max(F.when(k == marker, F.col(MTIME))).alias("marker_mtime"),
        ]
        out.append(F.when(has_exact, F.col("exact_mtime")).otherwise(F.col("marker_mtime")).alias(MTIME))
    return (
        inventory.where(k.isin(key, marker))
        .groupBy(F.expr(_STEM_SQL.format(c="key")).alias("parent"))
        .agg(*aggs)
        .where(has_exact | (F.col("marker") > 0))
        .select("parent", *out)
    )


def path_exists(inventory: DataFrame, path: str) -> bool:
    """Whether ``path`` is a file or a directory (runs one bounded job: ``limit(1)``).

    The root exists when the inventory has any key.
    """
    key = path_key(path)
    k = F.col("key")
    if not key:
        hits = inventory
    else:
        hits = inventory.where((k == key) | k.startswith(key + DELIMITER))
    return len(hits.select("key").limit(1).collect()) > 0


def list_children(inventory: DataFrame, path: str = "", strict: bool = False) -> DataFrame:
    """Delimiter listing of ``path``: ``name string, is_dir boolean, length bigint, key string``.

    ``key`` is the child's own key (``path/name``), so that listings of several
    directories can be put together.

    * an object one level below is a file with its size;
    * anything deeper collapses into its first component, a directory of
      length 0 (a child's own ``c/`` marker folds into the same entry);
    * the directory's own marker and ``*_$folder$`` objects are skipped, and so is
      a child with an empty name (``a//b`` under ``a``: it is ``a`` itself again);
    * if ``path`` names a file (the exact key, or a ``path/`` object of non-zero
      size), the listing is that one file;
    * a missing path lists nothing, or with ``strict=True`` raises
      ``FileNotFoundError`` (checked eagerly by ``path_exists``).

    The prefix filter is a ``startsWith`` pushed into the scan. Children are one
    hash aggregate on ``(name, is_dir)`` with a map-side partial step, so a
    directory with a huge share of the keys is combined before the shuffle.
    The "is it a file?" side has at most one row and is broadcast into a hash
    anti join on the map side; the children are never shuffled for it.
    """
    key = path_key(path)
    if strict and not path_exists(inventory, key):
        raise FileNotFoundError(f"No such file or directory: {path!r}")
    k = F.col("key")
    with_mtime = _has_mtime(inventory)
    mtime = [F.col(MTIME)] if with_mtime else []
    prefix = key + DELIMITER if key else ""
    scoped = inventory.where(k.startswith(prefix)) if key else inventory

    if key:
        # ``parent`` is computed from each key (not a folded constant), so the
        # anti join below is a broadcast hash equi-join.
        status = _file_status_of(inventory, key)
        scoped = scoped.withColumn("parent", F.substring(k, 1, len(key))).join(
            F.broadcast(status.select("parent")), "parent", "left_anti"
        )

    rest = F.substring(k, len(prefix) + 1, _MAX_LEN)
    children = (
        scoped.select(
            rest.alias("rest"),
            F.col("size").cast("bigint").alias("size"),
            *mtime,
        )
        .select(
            F.substring_index("rest", DELIMITER, 1).alias("name"),
            (F.instr("rest", DELIMITER) > 0).alias("is_dir"),
            "rest",
            "size",
            *mtime,
        )
        .where((F.col("name") != "") & (F.col("is_dir") | ~F.col("rest").endswith(FOLDER_SUFFIX)))
        .groupBy("name", "is_dir")
        .agg(F.max("size").alias("size"), *[F.max(c).alias(MTIME) for c in mtime])
        .select(
            "name",
            "is_dir",
            F.when(F.col("is_dir"), F.lit(0).cast("bigint")).otherwise(F.col("size")).alias("length"),
            F.concat(F.lit(prefix), "name").alias("key"),
            *[F.when(~F.col("is_dir"), F.col(MTIME)).alias(MTIME) for _ in mtime],
        )
    )
    if not key:
        return children
    name = key.rsplit(DELIMITER, 1)[-1]
    return children.unionByName(
        status.select(F.lit(name).alias("name"), F.lit(False).alias("is_dir"), "length", F.lit(key).alias("key"), *mtime)
    )


# Facts are keyed by a key's "stem": the key with one trailing '/' removed.
# The object ``x`` (kind 0), the object ``x/`` (kind 1) and "some key lies under
# the prefix ``x/``" (kind 2) all land on stem ``x``, and a manifest key finds
# every fact it needs under its own stem. The root gets its own kind (3),
# because the prefix '/' also has the stem ''.
#
# Each inventory key with d delimiters is exploded over j = 0 .. d + 1:
# j = 0 the key's own object, j = 1 the root, j >= 2 its ancestor prefix j - 1.
_FACT_KEY_SQL = (
    "CASE WHEN j = 0 THEN " + _STEM_SQL.format(c="key") + " WHEN j = 1 THEN '' "
    "ELSE array_join(slice(parts, 1, greatest(j - 1, 1)), '/') END"
)
_FACT_KIND_SQL = "CASE WHEN j = 0 THEN IF(endswith(key, '/'), 1, 0) WHEN j = 1 THEN 3 ELSE 2 END"
_FACT_AGGS = [
    "bool_or(kind = 0) AS plain_found",
    "max(CASE WHEN kind = 0 THEN size END) AS plain_size",
    "bool_or(kind = 1) AS slashed_found",
    "max(CASE WHEN kind = 1 THEN size END) AS slashed_size",
    "bool_or(kind = 2) AS has_children",
    "bool_or(kind = 3) AS root_has_keys",
]
_FACT_MTIME_AGGS = [
    "max(CASE WHEN kind = 0 THEN mtime END) AS plain_mtime",
    "max(CASE WHEN kind = 1 THEN mtime END) AS slashed_mtime",
]


def key_facts(inventory: DataFrame) -> DataFrame:
    """Everything the inventory says about any key stem, one row per stem ``k``.

    * ``plain_found, plain_size``: object ``k`` exists (and its size);
    * ``slashed_found, slashed_size``: object ``k + '/'`` exists (and its size);
    * ``has_children``: some key starts with ``k + '/'``;
    * ``root_has_keys`` (only for ``k = ''``): the inventory is not empty;
    * ``plain_mtime, slashed_mtime`` when the inventory has ``mtime``.

    Each inventory key of depth d is exploded (one ``Generate``, in codegen) into
    2 + d facts: its own object, the root and one per ancestor directory. The
    facts are then grouped by stem. Ancestors repeat across keys (the root is in
    every key), so the map-side partial aggregate folds them before the shuffle.
    """
    mtime = [MTIME] if _has_mtime(inventory) else []
    facts = inventory.selectExpr(
        "key",
        "CAST(size AS BIGINT) AS size",
        *mtime,
        "split(key, '/') AS parts",
        "explode(sequence(0, size(split(key, '/')))) AS j",
    ).selectExpr(f"{_FACT_KEY_SQL} AS k", f"{_FACT_KIND_SQL} AS kind", "size", *mtime)
    aggs = _FACT_AGGS + (_FACT_MTIME_AGGS if mtime else [])
    return facts.groupBy("k").agg(*[F.expr(a) for a in aggs])


def _status_sql(k: str) -> tuple[str, str, str]:
    """SQL for ``status``, ``length`` and ``mtime`` of the manifest key ``k`` (SQL)
    over the ``key_facts`` of its stem (NULL facts: nothing is known about it).

    A key ending in ``/`` is looked up as the object ``stem/`` and then as a
    directory; any other key as the object, then its ``key/`` marker, then as a
    directory; the root only as a directory.
    """
    plain = f"(NOT endswith({k}, '/') AND plain_found)"
    status = (
        f"CASE WHEN {k} = '' THEN IF(root_has_keys, '{STATUS_DIR}', '{STATUS_MISSING}') "
        f"WHEN {plain} THEN '{STATUS_FILE}' "
        f"WHEN slashed_found THEN IF(slashed_size = 0, '{STATUS_EMPTY_DIR}', '{STATUS_FILE}') "
        f"WHEN has_children THEN '{STATUS_DIR}' "
        f"ELSE '{STATUS_MISSING}' END"
    )

    def of_file(plain_col: str, slashed_col: str) -> str:
        return (
            f"CASE WHEN {k} = '' THEN NULL WHEN {plain} THEN {plain_col} "
            f"WHEN slashed_found AND slashed_size <> 0 THEN {slashed_col} END"
        )

    return status, f"CAST({of_file('plain_size', 'slashed_size')} AS BIGINT)", of_file("plain_mtime", "slashed_mtime")


def path_status(
    manifest: DataFrame,
    inventory: DataFrame,
    key_col: str = "key",
    split_hot_keys: bool = True,
    hot_share: float | None = None,
    hot_sample_fraction: float = 0.01,
    salts: int = 64,
) -> DataFrame:
    """Status of every manifest key: manifest columns + ``status string, length bigint``.

    Manifest columns may have any names. Those named like a result column
    (``status``, ``length`` and, if the inventory has it, ``mtime``) are replaced by it.

    First match wins (root ``''`` skips the two object lookups):

    1. object ``key`` exists -> ``file`` with its size (``empty_dir`` if the key
       itself is a size-0 ``.../`` marker);
    2. object ``key + '/'`` exists (key not ending in ``/``) -> ``empty_dir`` if
       its size is 0, even when the directory has children, else ``file``;
    3. some key lies under ``key + '/'`` (any key, for the root) -> ``dir``;
    4. else ``missing``.

    ``length`` (and ``mtime`` if the inventory has it) is set for files only.

    Plan: all facts come from ``key_facts`` (grouped by key stem, so at most one
    row per manifest key) and every manifest row meets them in one left join on
    its stem. Spark sizes that join: a small fact table is broadcast, a large
    one meets the manifest in a shuffle join.

    Skew: a manifest key that repeats for a large share of the rows would put
    all of them into one join task. So the join key is stem and salt. The stems
    found by ``hot_keys`` (at most ``1 / hot_share``, so they may be broadcast) have
    their facts once for each of ``salts`` salts, and their manifest rows take the salt of
    the map task they come from: the same on any retry of that task. Other stems
    have salt 0. NULL keys match nothing; they are spread over the reducers by
    their map task under salt -1. Every row is joined once; the sample only
    decides which stems are salted. A caller whose manifest has one row per key
    (e.g. after ``distinct``) may pass ``split_hot_keys=False`` to skip the detection.
    """
    facts = key_facts(inventory)
    # the manifest's row travels as one struct, so its column names meet no others
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in manifest.columns}
    key = quoted.get(key_col, "`" + key_col.replace("`", "``") + "`")
    packed = manifest.select(
        F.struct(*[F.col(q) for q in quoted.values()]).alias("row"),
        F.expr(_STEM_SQL.format(c=key)).alias("stem"),
    )
    if split_hot_keys:
        hot = hot_keys(packed, "stem", hot_share, hot_sample_fraction).select(F.col("key").alias("hot"))
        task = F.spark_partition_id()
        tagged = packed.join(F.broadcast(hot), F.col("stem") == F.col("hot"), "left").select(
            "row",
            F.coalesce(F.col("stem"), task.cast("string")).alias("stem"),
            F.when(F.col("stem").isNull(), F.lit(-1))
            .when(F.col("hot").isNotNull(), F.pmod(task, F.lit(salts)))
            .otherwise(F.lit(0))
            .alias("salt"),
        )
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        salted = facts.join(F.broadcast(hot), F.col("k") == F.col("hot"), "left").select(
            *facts.columns, F.explode(F.when(F.col("hot").isNotNull(), every).otherwise(F.array(F.lit(0)))).alias("s")
        )
        resolved = tagged.join(salted, (F.col("stem") == F.col("k")) & (F.col("salt") == F.col("s")), "left")
    else:
        resolved = packed.join(facts, F.col("stem") == F.col("k"), "left")

    status, length, mtime = _status_sql(f"row.{key}")
    out = [F.expr(status).alias("status"), F.expr(length).alias("length")]
    if _has_mtime(inventory):
        out.append(F.expr(mtime).alias(MTIME))
    replaced = {"status", "length", MTIME} if _has_mtime(inventory) else {"status", "length"}
    kept = [F.expr(f"row.{q}").alias(c) for c, q in quoted.items() if c.lower() not in replaced]
    return resolved.select(*kept, *out)

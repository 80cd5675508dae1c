"""Object-key inventories: ``key string, size bigint`` tables.

An inventory is what a bucket listing returns, one row per object. It can be
made by listing a file tree (``object_inventory`` + ``keys_from_files``) or
taken from any table that holds object keys (``keys_from_urls``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
# Scheme and authority of a qualified path ("s3a://bucket/", "file:/").
_SCHEME_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/"
# Scheme of a web URL, removed to turn the URL into an object key.
_WEB_SCHEME = r"^https?://"


def object_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file under ``root`` (recursive): ``path, length, modificationTime``.

    The ``binaryFile`` source lists the tree (in parallel on the executors once
    it is large, see ``spark.sql.sources.parallelPartitionDiscovery.threshold``);
    only the three metadata columns are selected, so file contents are pruned
    from the read schema and never opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def keys_from_files(files: DataFrame) -> DataFrame:
    """``path, length[, modificationTime]`` rows to an inventory ``key, size[, mtime]``:
    the key is the path without scheme, authority (bucket) and leading slash."""
    cols = [
        F.regexp_replace("path", _SCHEME_AUTHORITY, "").alias("key"),
        F.col("length").cast("bigint").alias("size"),
    ]
    if "modificationTime" in files.columns:
        cols.append(F.col("modificationTime").alias("mtime"))
    return files.select(*cols)


def keys_from_urls(
    df: DataFrame, url_col: str = "url", body_col: str = "html", dedupe: bool = True
) -> DataFrame:
    """Web pages as objects: key = URL without ``http(s)://``, size = body length.

    With ``dedupe`` a key seen more than once keeps its largest size (one object
    per key): a hash aggregate with a map-side partial step, so a key that holds
    a large share of the rows is combined before the shuffle. ``list_children``
    and ``path_status`` already fold repeated keys the same way in their own
    aggregates, so they can take ``dedupe=False`` and save that shuffle.
    """
    keys = df.select(
        F.regexp_replace(url_col, _WEB_SCHEME, "").alias("key"),
        F.length(body_col).cast("bigint").alias("size"),
    )
    return keys.groupBy("key").agg(F.max("size").alias("size")) if dedupe else keys

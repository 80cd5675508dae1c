"""The input tables read by the registered queries, with declared schemas.

Declaring the schema means the reader does not run a job to infer it from file
footers, and a file whose schema drifts fails loudly instead of silently
changing types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The schemas of the driver's parquet tables (one file per table).
SCHEMAS: dict[str, str] = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "pages": "page_id bigint, url string, html string",
}


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """``<base_dir>/<name>.parquet``; declared schema when known, else inferred."""
    path = f"{base_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)

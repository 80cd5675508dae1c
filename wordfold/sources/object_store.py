"""Object-store (S3-compatible) connection options for text sources and sinks.

The stock Hadoop ``s3a://`` filesystem is used; this module only builds the
``spark.hadoop.fs.s3a.*`` options. Credentials are never literals in code: they
come from the caller or the environment's credential provider chain.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Option names of the Hadoop S3A filesystem.
ENDPOINT = "fs.s3a.endpoint"
ACCESS_KEY = "fs.s3a.access.key"
SECRET_KEY = "fs.s3a.secret.key"
SSL_ENABLED = "fs.s3a.connection.ssl.enabled"
PATH_STYLE = "fs.s3a.path.style.access"
BLOCK_SIZE = "fs.s3a.block.size"
PAGING_MAXIMUM = "fs.s3a.paging.maximum"
# Defaults for the split size (32 MiB) and the listing page.
DEFAULT_BLOCK_SIZE = 32 * 1024 * 1024
DEFAULT_PAGING_MAXIMUM = 5000


def s3a_options(
    endpoint: str,
    *,
    access_key: str | None = None,
    secret_key: str | None = None,
    ssl: bool = False,
    path_style: bool = True,
    block_size: int = DEFAULT_BLOCK_SIZE,
    paging_maximum: int = DEFAULT_PAGING_MAXIMUM,
) -> dict[str, str]:
    """Hadoop options for an S3-compatible store at ``endpoint``.

    Path-style access is on (S3-compatible servers rarely do virtual hosts).
    ``block_size`` is the split size S3A reports for text files; for DataFrame
    sources ``spark.sql.files.maxPartitionBytes`` sets the input partition size.
    Keys are added only when given; otherwise S3A's provider chain is used.
    """
    opts = {
        ENDPOINT: endpoint,
        SSL_ENABLED: str(ssl).lower(),
        PATH_STYLE: str(path_style).lower(),
        BLOCK_SIZE: str(block_size),
        PAGING_MAXIMUM: str(paging_maximum),
    }
    if access_key is not None and secret_key is not None:
        opts[ACCESS_KEY] = access_key
        opts[SECRET_KEY] = secret_key
    return opts


def as_spark_conf(options: dict[str, str]) -> dict[str, str]:
    """The same options as ``spark.hadoop.*`` keys for a session builder or spark-submit."""
    return {f"spark.hadoop.{k}": v for k, v in options.items()}


def apply_to_session(spark: SparkSession, options: dict[str, str]) -> None:
    """Set the options on the running session's Hadoop configuration.

    Per-bucket settings can also be passed as ``fs.s3a.bucket.<name>.*`` keys.
    """
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in options.items():
        hconf.set(k, v)

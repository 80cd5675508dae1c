"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings for a cluster run over very large inputs. AQE re-plans at runtime:
# it coalesces small shuffle partitions, splits skewed join partitions and
# turns a shuffle join into a broadcast one when a side proves small.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.filterPushdown.string.startsWith": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Added on a cluster: size partitions by bytes (not by core count) so that a
# 100 TB input gives ~128 MB tasks, and start shuffles wide enough for the
# largest stage; AQE then coalesces the small ones but never splits big ones, so
# set spark.sql.shuffle.partitions to about (largest shuffle bytes) / 200 MB,
# e.g. 50000 for a 10 TB word-count shuffle of a very large vocabulary.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}


def cluster_conf() -> dict[str, str]:
    """Settings to pass to ``spark-submit --conf`` for a large cluster run."""
    return {**SCALE_CONF, **CLUSTER_CONF}


def submitted_conf() -> dict[str, str]:
    """Settings that a launcher (``spark-submit --conf``, its properties file) has given this process."""
    from pyspark import SparkConf, SparkContext

    SparkContext._ensure_initialized()
    return dict(SparkConf().getAll())


def defaults(master: str | None = None, given: dict[str, str] | None = None) -> dict[str, str]:
    """The library's settings for a session on ``master``, without any that the user has set.

    A cluster master gets ``cluster_conf``, a local one ``SCALE_CONF``.
    """
    given = submitted_conf() if given is None else given
    master = master or given.get("spark.master") or "local[*]"
    conf = SCALE_CONF if master.startswith("local") else cluster_conf()
    return {k: v for k, v in conf.items() if k not in given}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wordfold") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WORDFOLD_DRIVER_MEMORY", "8g"))
    )
    java_opts = os.environ.get("WORDFOLD_DRIVER_JAVA_OPTIONS")
    if java_opts:
        builder = builder.config("spark.driver.extraJavaOptions", java_opts)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and written tables.

    Read from the session (``SparkContext.setCheckpointDir`` or
    ``spark.checkpoint.dir``). Only where it is unset in a local-mode session
    is a folder set: one below the warehouse folder, which such a session already
    writes to. On a cluster an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on the client (Spark Connect)
        sc = None
    if sc is not None:
        d = sc.getCheckpointDir() or d or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            # a folder on the driver's disk is not shared with the executors
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/wordfold-shared"
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    return d


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never reused, so runs do not collide)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"

"""Object-store options and session settings."""

from __future__ import annotations

from wordfold.session import CLUSTER_CONF, SCALE_CONF, cluster_conf, defaults
from wordfold.sources.object_store import as_spark_conf, s3a_options


def test_s3a_options_without_keys_use_the_provider_chain():
    opts = s3a_options("store.local:9000")
    assert opts["fs.s3a.endpoint"] == "store.local:9000"
    assert opts["fs.s3a.path.style.access"] == "true"
    assert opts["fs.s3a.connection.ssl.enabled"] == "false"
    assert opts["fs.s3a.block.size"] == str(32 * 1024 * 1024)
    assert "fs.s3a.access.key" not in opts and "fs.s3a.secret.key" not in opts


def test_s3a_options_as_spark_conf():
    conf = as_spark_conf(s3a_options("e:1", access_key="k", secret_key="s", ssl=True))
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert all(k.startswith("spark.hadoop.fs.s3a.") for k in conf)


def test_cluster_conf_keeps_aqe_and_ui_off():
    conf = cluster_conf()
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.ui.enabled"] == "false"
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_defaults_never_override_what_the_user_set():
    given = {"spark.sql.files.maxPartitionBytes": "1m", "spark.master": "local[2]"}
    assert "spark.sql.files.maxPartitionBytes" not in defaults(given=given)
    assert set(defaults(given=given)) == set(SCALE_CONF) - set(given)
    cluster = defaults("yarn", given={"spark.sql.shuffle.partitions": "7"})
    assert set(cluster) == (set(SCALE_CONF) | set(CLUSTER_CONF)) - {"spark.sql.shuffle.partitions"}


def test_apply_to_session_sets_hadoop_options(spark):
    from wordfold.sources.object_store import apply_to_session

    apply_to_session(spark, s3a_options("store.test:9000"))
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    assert hconf.get("fs.s3a.endpoint") == "store.test:9000"
    assert hconf.get("fs.s3a.path.style.access") == "true"

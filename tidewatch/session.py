"""Session construction and the shared working folder.

``session()`` is what jobs call; tests and ``bench.py`` call it with a local
master. Object-store access is a profile of plain Hadoop S3A settings whose
credentials come from the environment names the caller passes in.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.showConsoleProgress": "false",
}


def object_store_conf(
    endpoint: str | None = None,
    access_key_env: str = "S3_ACCESS_KEY",
    secret_key_env: str = "S3_SECRET_KEY",
    endpoint_env: str = "S3_BUCKET_ENDPOINT",
    ssl: bool = False,
    max_threads: int = 10,
    commit_v2: bool = False,
) -> dict[str, str]:
    """S3A settings for a path-style object store with a disk upload buffer.
    ``commit_v2`` asks for the faster commit whose partial task output can stay
    visible after a failure."""
    conf = {
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.fast.upload": "true",
        "spark.hadoop.fs.s3a.fast.upload.buffer": "disk",
        "spark.hadoop.fs.s3a.threads.max": str(max_threads),
        "spark.hadoop.fs.s3a.connection.maximum": str(max_threads),
    }
    if commit_v2:
        conf["spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version"] = "2"
    for key, env in (
        ("spark.hadoop.fs.s3a.access.key", access_key_env),
        ("spark.hadoop.fs.s3a.secret.key", secret_key_env),
    ):
        if os.environ.get(env):
            conf[key] = os.environ[env]
    ep = endpoint or os.environ.get(endpoint_env)
    if ep:
        conf["spark.hadoop.fs.s3a.endpoint"] = ep
    return conf


def session(
    app: str = "tidewatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    object_store: bool = False,
    driver_memory: str = "6g",
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.bindAddress", "127.0.0.1")
        builder = builder.config("spark.driver.host", "127.0.0.1")
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", driver_memory)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if object_store:
        conf.update(object_store_conf())
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). A folder
    of our own is made only where neither is set *and* the master is ``local``
    (tests, one machine); on a cluster that would put every executor's part
    files on its own disk, so it raises instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder that the driver "
                f"and all executors share (master {sc.master})"
            )
        conf_dir = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables,
    stream checkpoints and sink output."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tidewatch", *parts, uuid.uuid4().hex])


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path, for listing and renaming on any store Spark can reach."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged copy made under ``work_path`` once nothing reads it."""
    if "/tidewatch/" not in path:
        raise ValueError(f"not a staged path: {path}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

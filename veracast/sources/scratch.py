"""Shared folder for intermediate results that must outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_runs: list[str] = []
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only on a local master.

    Executors of a cluster don't share the driver's disk, so without the setting this raises.
    """
    context = spark.sparkContext
    configured = spark.conf.get(SETTING, None) or context.getConf().get(SETTING)
    if not configured:
        master = context.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {SETTING} to a folder that all executors of {master} share")
        application = context.applicationId
        if application not in _local:
            _local[application] = tempfile.mkdtemp(prefix="veracast-")
        configured = _local[application]
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    base = _runs[-1] if _runs else shared_folder(spark)
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside goes to one folder, which is removed at the end of the run.

    Only for runs that write their results elsewhere before they end.
    """
    path = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    _runs.append(path)
    try:
        yield path
    finally:
        _runs.remove(path)
        jvm, configuration = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(configuration).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several branches read to the shared folder and read it back.

    Columnar, so each branch still scans only its own columns. Runs a job and cuts the lineage.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_in_buckets(df: DataFrame, label: str, buckets: int, *columns: str) -> DataFrame:
    """Like ``stage``, laid out by ``columns``: groupings, windows and joins that hold them don't shuffle.

    A bucket is one file and one task where ``df`` is partitioned alike. The files' layout is known
    to a table only, so one names them while they are opened; dropping it leaves them where they are.
    Spark joins in place by more columns than the layout has only if it is told so; unless the session
    has a setting of its own, this tells it.
    """
    spark = df.sparkSession
    if _ALL_KEYS not in spark.conf.getAll:
        spark.conf.set(_ALL_KEYS, "false")
    path, name = fresh_path(spark, label), f"staged_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *columns).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")

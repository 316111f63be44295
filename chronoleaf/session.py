"""Session helpers: a tuned local session for tests/bench and a shared scratch root.

Scratch data (feature tables, stream checkpoints, derived source files) always
lives below the folder the cluster names in ``spark.checkpoint.dir``.  A path
of our own is set only when the session has none (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_APP = "chronoleaf"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster use the session the platform hands out."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(_APP)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.  Only a local-mode session
    (tests, laptops) without one gets a temporary folder of its own."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # getCheckpointDir() returns an app-specific child; use its parent folder
        return root.rstrip("/").rsplit("/", 1)[0]
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            # a machine-local folder would vanish with its executor: never on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared, durable folder")
        root = tempfile.mkdtemp(prefix="chronoleaf-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{_APP}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df, purpose: str = "materialized"):
    """Write ``df`` as parquet below the shared checkpoint folder and read it back:
    cuts the lineage (re-running a lost task re-reads files instead of
    recomputing upstream joins) and feeds several passes from one computation."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete through the Hadoop FileSystem of the session."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    return bool(fs.delete(hpath, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))

"""Session helpers: a sensible local session for tests/bench and the shared
scratch location every job that materialises files must use."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "touchline") -> SparkSession:
    """Local session used by tests and bench. On a cluster the submitter's
    configuration wins: ``getOrCreate`` keeps an existing session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location is read from the session (``spark.checkpoint.dir``, or the
    SparkContext checkpoint dir). Only when neither is set *and* Spark runs
    in local mode do we create one, as tests do; on a cluster a missing
    setting is an error rather than a silent machine-local folder.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="touchline-ckpt-")
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/touchline/{name}-{uuid.uuid4().hex[:12]}"


def input_version(spark: SparkSession, sf_dir: str) -> str:
    """``sf_dir`` with the names, sizes and modification times of the files
    in it: what was derived from other files is not used again."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for st in fs.listStatus(root):
        for f in fs.listStatus(st.getPath()) if st.isDirectory() else [st]:
            found.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return sf_dir + "|" + ",".join(sorted(found))

"""Session helpers.

The pipeline only needs a handful of session-level settings to be
deterministic: UTC session time (text timestamps carry no zone, and a
literal ``'Z'`` is not a zone in Spark patterns), AQE on, zstd parquet.
Everything else (memory, executors, shuffle partitions at scale) belongs to
the deployment and is left alone here.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on for correct, reproducible results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that are good defaults but may be overridden by the deployment.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# The parsers' fused stage has methods above 8,000 bytecodes, which HotSpot
# leaves to the interpreter; beyond this limit Spark plans them as separate
# projections, which are split and compiled (about 30 % less time).
CODEGEN_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(master: str | None = None, app: str = "emberlog",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**DEFAULT_CONF, **REQUIRED_CONF, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, and the codegen limit (runtime confs only)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in CODEGEN_CONF.items():
        if spark.conf.get(k, None) is None:  # a deployment's own setting stays
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this is a
    shared, fault-tolerant file system).  Only a local master without it gets
    a temporary folder, registered as the session's checkpoint dir so later
    calls share it; on a cluster each machine would write a disk of its own,
    so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="emberlog-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path

"""Session helpers: a local session for tests/bench and the shared scratch folder.

Scratch space (staged layers, landing simulations, write round trips) always lives under the
folder the cluster names in ``spark.checkpoint.dir``; it is read from the session. Only a local
session without that setting gets a temp folder of its own; on a cluster its lack is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session used by tests and ``bench.py``; clusters bring their own session."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings we recommend for a large cluster (100 TB-class inputs). They are applied only where
# the session has no value of its own — the cluster's configuration always wins.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_cluster_defaults(spark: SparkSession) -> dict[str, str]:
    """Set each recommended runtime SQL setting that the session leaves unset; returns what was
    set."""
    changed = {}
    for k, v in CLUSTER_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
            changed[k] = v
    return changed


def now_iso() -> str:
    """Wall-clock UTC instant in ISO-8601 (``…Z``) for run stamps when a caller wants one."""
    import datetime as _dt
    return _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="milliseconds").replace(
        "+00:00", "Z")


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. A local session without one gets a fresh temp
    dir; elsewhere executors would each write to their own disk, so it must be configured."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set(CHECKPOINT_CONF, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root (never reused, never cleared)."""
    return f"{scratch_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"

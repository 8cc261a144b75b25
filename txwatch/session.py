"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every txwatch plan relies on.  They are runtime SQL confs, so they can be
# applied to a session somebody else built (the driver, a notebook) as well.
RUNTIME_CONF = {
    # The payload's trailing 'Z' is literal text: the session zone decides the
    # instant, so it has to be UTC.  Report dates and hours are UTC too.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition columns date=YYYY-MM-DD / hour=HH stay strings on read.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Re-running one warehouse window replaces only the partitions it touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # RocksDB state commits write a changelog, not a full snapshot, per micro-batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``txwatch`` importable in Python workers (stateful processors run there).

    On a cluster the launcher usually ships it with ``--py-files``; this does the same
    at run time, once per application: the package is zipped and added with
    ``addPyFile``, which distributes it to every executor and worker.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - remote sessions ship code their own way
        return
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="txwatch-pyfiles-")
    archive = os.path.join(out_dir, "txwatch.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings txwatch needs to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Settings for the large deployment (about 100 TB of stored transactions on ~1000
# executors).  Static settings belong on the launcher's command line; they are listed
# here so the sizing decisions live next to the code that depends on them.
CLUSTER_CONF = {
    # many reducers, merged at run time by AQE to ~256 MB each; skewed partitions split
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    # scan splits of 256 MB: a task reads a few row groups, not a whole file set
    "spark.sql.files.maxPartitionBytes": "256m",
    # broadcast only what the planner or AQE has measured below 64 MB
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # executor loss: migrate shuffle and cached blocks off a leaving executor, retry
    # tasks elsewhere; lost shuffle output is recomputed from lineage
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "txwatch", profile: str = "local") -> SparkSession:
    """Session for local runs and tests; on a cluster the launcher supplies master
    and ``profile="cluster"`` applies ``CLUSTER_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.streaming.metricsEnabled", "true")
        # Large keyed state (open travel windows) lives in RocksDB, not on the heap.
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    if profile == "cluster":
        for key, value in CLUSTER_CONF.items():
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local master
    without that setting (tests) gets a temp folder, once per application; on a cluster
    its absence is an error, because the executors could not see a driver's folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        kept = sc._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            root = kept.get()
        elif sc.master.startswith("local") and "cluster" not in sc.master:
            root = tempfile.mkdtemp(prefix="txwatch-ckpt-")
            sc.setCheckpointDir(root)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "/".join([root.rstrip("/"), *parts, uuid.uuid4().hex])

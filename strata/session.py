"""Session construction and the shared scratch location.

The session is owned by the caller: library functions never start or stop
one.  `build_session` only gathers the settings the pipeline relies on.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the library assumes.  They are all runtime-safe
# defaults for a large cluster: AQE re-plans joins and coalesces shuffle
# output from real sizes, skewed join partitions are split, and partitions
# are overwritten per value instead of per table.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Spark broadcasts a join side only when its measured size is below
    # this bound; nothing in the library forces a broadcast.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # Whole-stage code larger than the JVM's JIT limit (8000 bytes of
    # bytecode) would run interpreted; above it Spark falls back to
    # per-operator code, which is compiled.  Wide silver projections hit it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "strata", master: str | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Return a session with the library's defaults; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster the setting points at shared storage and is only read here.
    When it is unset on a local master (tests) a folder of our own is created
    and registered, so lineage cuts and scratch tables still have a home; on a
    cluster that would be a folder of one machine, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local_master(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def _is_local_master(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders once nothing reads them any more; all of this
    library's under the checkpoint folder when no path is given."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths or (f"{checkpoint_dir(spark).rstrip('/')}/strata",):
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/strata/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"

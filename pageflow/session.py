"""SparkSession defaults and the shared scratch folder.

Nothing here hand-schedules work: the settings only make Catalyst/AQE's job
easier (UTC so file-name hours are wall-clock hours, AQE for runtime
coalescing and skew splitting, zstd Parquet, dynamic partition overwrite so a
replayed source hour replaces only its own partition).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only if its size in bytes is within the bound: the files'
    # size times a factor for what compression hides, or AQE's measured shuffle size.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "pageflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster leave ``master`` None and size ``shuffle_partitions`` so a
    shuffle partition holds ~128-256 MB at the target scale.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Read from the session first; only when nothing is configured (local tests)
    a fresh folder is made and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(staging, checkpoints and fixtures are written there)")
        # local mode only (tests): driver and executors share this machine
        conf_dir = tempfile.mkdtemp(prefix="pageflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    d = sc.getCheckpointDir() or conf_dir
    return d.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists; an unreachable or unknown file system raises."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table at ``path``, or an empty one if nothing is there; other errors are not hidden."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a scratch or partition folder, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/pageflow-{name}-{uuid.uuid4().hex[:12]}"

"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder that jobs use to cut lineage or materialise tables.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS / object
store).  It is read from the session; only when it is unset (local tests)
a fresh scratch folder is created and registered.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Session settings for local runs.  Library code never changes shuffle sizing
# on a user session: AQE coalesces partitions at runtime on the cluster.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app: str = "starledger", cpus: int | None = None,
              shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    master = f"local[{cpus}]" if cpus else "local[*]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only if unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application uuid folder: use its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # unset (local tests): register a scratch folder; spark.checkpoint.dir is a
    # core setting and cannot be changed on a running session, so only the
    # context's checkpoint folder is set (its parent is returned next time)
    scratch = tempfile.mkdtemp(prefix="starledger-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]


#: what a build session reads in one task, and gathers for one
SLICE = "8m"
#: bytes of input files for one shuffle partition of a build session
SHARE = 4 << 20
#: what a build session sets besides: a build's shuffles serve its one write and go with it, its files are compact, and a
#: skewed join is split even where what follows could have used its partitions
BUILD_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": SLICE,
    "spark.sql.files.maxPartitionBytes": SLICE,
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session beside the caller's, whose settings stay as they are, for a job
    over ``input_bytes`` of files: as many shuffle partitions as that asks for,
    tasks of ``SLICE``.  A task's sorts then hold some 100 MB however large the
    input is, where the usual 64 and 128 MB (a few million narrow rows) spill.
    What the caller has set stays, but never fewer partitions than needed."""
    own = spark.newSession()
    held = spark.conf.getAll
    for k, v in held.items():
        if not k.startswith("spark.") or spark.conf.isModifiable(k):
            own.conf.set(k, v)
    width = "spark.sql.shuffle.partitions"
    own.conf.set(width, str(max(int(spark.conf.get(width)), -(-input_bytes // SHARE))))
    for k, v in BUILD_CONF.items():
        if k not in held:
            own.conf.set(k, v)
    return own


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root, *[p.strip("/") for p in parts]])


__all__ = ["build_session", "get_spark", "ensure_checkpoint_dir", "work_path", "LOCAL_CONF"]

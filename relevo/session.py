"""Session helpers: building a session for local runs and cutting lineage safely.

Library code never creates its own session; callers pass one in. ``local_session`` exists for
tests, the bench and the command-line flows only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Runtime settings the jobs rely on to split a hot key. With a chain of joins on the same key
# (pairs ⋈ part ⋈ descriptions on product_uid) the later join reuses the earlier one's
# partitioning, so AQE only splits a skewed partition if it may add the shuffle that splitting
# then needs ("force"); it adds it only when it actually finds a skewed partition.
SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Bounds on what the driver tracks per shuffle: reduce partitions, and map tasks of a scan.
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SCAN_SPLITS = 100_000
#: Largest table (measured bytes) that is broadcast to every executor.
BROADCAST_LIMIT_BYTES = 64 << 20
#: Partitions that a table of few row groups is spread over.
SPREAD_PARTITIONS = 8


def apply_skew_conf(spark: SparkSession) -> None:
    """Turn on AQE skew-join splitting for this session (runtime SQL settings)."""
    for key, value in SKEW_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def local_session(cpus: int | str = "*", app: str = "relevo", shuffle_partitions: int | None = None,
                  driver_memory: str = "8g", conf: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cpus]`` session with AQE on, UI off and a scratch checkpoint folder."""
    parts = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 1 << 30) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume and the number of executor cores.

    * shuffle partitions: enough that the largest shuffle (about the input volume: the pairs carry
      the text they are compared with) lands near ``target_partition_bytes`` per task, and never
      fewer than 3 waves of tasks; AQE coalesces partitions that turn out small. Map outputs are
      tracked on the driver as one entry per map task and reduce partition, so both grow slowly:
      scan splits of 128 MB up to 1 GB, and at most ``MAX_SHUFFLE_PARTITIONS`` partitions;
    * AQE with skew splitting (``SKEW_CONF``), skewed partitions split at 5x the median and above
      256 MB;
    * no broadcast from static estimates (they come from compressed file sizes and a 20-byte guess
      per string, far below the real size of long text); AQE broadcasts a join side only after its
      shuffle stage has run and its measured size is under 64 MB.
    """
    partitions = max(3 * total_cores, min(-(-input_bytes // target_partition_bytes), MAX_SHUFFLE_PARTITIONS))
    split = min(max(128 << 20, -(-input_bytes // MAX_SCAN_SPLITS)), 1 << 30)
    return {
        **SKEW_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        # checkpoint files of frames that are no longer referenced are removed from the shared folder
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def apply_cluster_conf(spark: SparkSession, input_bytes: int | None = None) -> None:
    """Apply ``cluster_conf`` to a session that runs on a cluster; a local session keeps its own.

    Static settings (the cleaner) must come with the submit command; the SQL ones are set here.
    """
    if not spark.sparkContext.master.startswith("local") and input_bytes:
        for key, value in cluster_conf(input_bytes, spark.sparkContext.defaultParallelism).items():
            if key.startswith("spark.sql."):
                spark.conf.set(key, value)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrives in fewer partitions than wanted.

    ``min_partitions`` defaults to ``SPREAD_PARTITIONS``, a fixed small number: a large table scans
    as more splits and is returned unchanged, on a cluster of any size. A table stored as a few big
    row groups would otherwise run every following narrow step (regex, tokenizing, exploding) in one
    task. The round-robin exchange carries no key, so joins further down still get their own
    exchange (and AQE skew splitting).
    """
    target = min_partitions or SPREAD_PARTITIONS
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a local-mode session (tests, the bench) without one gets a scratch folder; on a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error.
    """
    found = checkpoint_dir(spark)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS, S3, ...) for cluster runs")
    scratch = tempfile.mkdtemp(prefix="relevo-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage before an iterative consumer (model fitting).

    The rows are written to the shared checkpoint folder (a reliable checkpoint: it survives the
    loss of any executor, and later passes re-read files instead of recomputing the plan).
    ``localCheckpoint`` is never used.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for intermediate tables other jobs must read."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts])


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write a per-key table as Parquet in the shared folder and read it back.

    Used for the output of an aggregate that is then joined to a large, possibly skewed table:
    read back from files, the table enters the join through its own exchange, which AQE can split
    for a hot key (a join fed straight by an aggregate or a user repartition cannot be split).
    Catalyst also sees the real file size, so a small table is still broadcast. It cuts lineage
    too: a lost executor re-reads files instead of recomputing the aggregate.
    """
    path = shared_path(df.sparkSession, "relevo-tables", df.sparkSession.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_if_small(table: DataFrame, *text_cols: str, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """A materialised table marked for broadcast when the measured size of its text is under the limit.

    Above the limit the table itself is returned, and joins on it shuffle.
    """
    size = table.agg(F.sum(F.lit(24) + sum((F.octet_length(c) for c in text_cols), F.lit(0)))).first()[0] or 0
    return F.broadcast(table) if size <= limit_bytes else table


def remove_shared_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote in the shared folder.

    Call it when no DataFrame that reads them is used any more (the command lines do at their end).
    """
    for kind in ("relevo-tables", "relevo-csv"):
        path = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, kind, spark.sparkContext.applicationId))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

"""SparkSession helpers.

The library never creates a session implicitly: every public function takes
DataFrames (or a session) from the caller.  ``local_session`` is for tests and
``bench.py`` only.  ``checkpoint_dir`` resolves the shared folder that
iterative operators use to cut lineage: the cluster's own
``spark.checkpoint.dir`` wins; a scratch folder is set only when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "turnstile") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.  A scratch one is made only for a
    local master; on a cluster ``spark.checkpoint.dir`` has to name one that
    all executors share."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(_CHECKPOINT_CONF, None) or sc.getConf().get(_CHECKPOINT_CONF, None)
    if not conf:
        if not str(sc.master).startswith("local") or str(sc.master).startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="turnstile-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written
    intermediate tables (never a machine-local folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: for a table that several parts of one query
    read, so that none is computed twice and a lost executor costs no recomputation.  Files live until
    the session ends: ``drop_snapshots`` removes what is no longer read."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    _SNAPSHOTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


_SNAPSHOTS: list[str] = []


def drop_snapshots(spark: SparkSession) -> int:
    """Delete the tables that ``snapshot`` has written; the frames that read them end with it."""
    gone = 0
    while _SNAPSHOTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SNAPSHOTS.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume: enough initial
    shuffle partitions that each holds about ``target_partition_bytes`` of the
    input (at least 3 waves of tasks), AQE to coalesce small partitions and
    split skewed ones, and scan splits of 256 MB.  Apply with
    ``SparkSession.builder.config(map=...)``; ``spark.checkpoint.dir`` must
    name a shared folder and is left to the cluster."""
    slots = max(1, executors * cores_per_executor)
    partitions = max(3 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
    }

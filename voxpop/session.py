"""Session construction and lineage helpers.

Library functions never create sessions; they take the caller's ``spark``.
``build_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Shuffle sizing: on a cluster AQE coalesces small partitions, so the static
# value is an upper bound that must be large enough for the biggest stage
# (~128 MiB per partition at the target scale); locally it matches the cores.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot submissions (one key can hold a third of all comments) are split by
    # AQE's skew-join handling at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Runtime SQL settings for the ~100 TB target (1000 executors). Applied with
# ``apply_cluster_conf`` to an existing session; they only change planning.
CLUSTER_SQL_CONF = {
    # Upper bound for shuffle width: 100 TB of comments / ~128 MiB per task.
    # AQE coalesces small stages down, so the bound costs nothing on small ones.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A thread holding a third of all comments is split into many tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Broadcast only what statistics or run-time sizes show to be small.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}

# Static settings for spark-submit (they cannot change on a live session):
# survive lost executors (decommissioning migrates shuffle and cached blocks,
# tasks are retried), and name a shared checkpoint folder.
CLUSTER_SUBMIT_CONF = {
    "spark.executor.cores": "5",
    "spark.executor.memory": "28g",
    "spark.executor.memoryOverhead": "4g",
    "spark.task.maxFailures": "8",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.checkpoint.dir": "<shared folder, e.g. an object-store or HDFS path>",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Set the runtime SQL settings of ``CLUSTER_SQL_CONF`` on a live session."""
    for key, value in {**CLUSTER_SQL_CONF, **(overrides or {})}.items():
        spark.conf.set(key, value)


def build_session(
    master: str | None = None,
    app_name: str = "voxpop",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE, skew-join splitting and UTC time."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf.setdefault("spark.driver.memory", "16g")
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    it is read from the session and used as is. Only when it is unset (local
    tests) a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="voxpop-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and cut its lineage.

    Lost executors then re-read the checkpoint files instead of recomputing the
    whole upstream plan (join, cleaning, vectorising, scoring).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder of the reliable checkpoint
    directory and return the re-read table: lineage is cut, and later readers
    get column pruning, filter pushdown and, by ``partition_by``, partition pruning.
    ``schema`` names types that are stored as plain structures."""
    import uuid

    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(schema or df.schema).parquet(path)
    out._scratch = path.rsplit("/", 1)[1]
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``materialize`` returned and that nothing reads any more."""
    remove_scratch(df.sparkSession, df._scratch)


def table_kept(df: DataFrame) -> bool:
    """Whether a table that ``materialize`` returned is still in the checkpoint directory."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{df._scratch}")
    return path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).exists(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so once the
    driver's collector finds them unused, which a large heap puts off."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove_scratch(spark: SparkSession, name: str) -> None:
    """Delete the folder ``name`` of the checkpoint directory, in whatever store it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

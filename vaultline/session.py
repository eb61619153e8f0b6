"""Session construction and shared-storage locations.

On a cluster the session is built by the caller; these helpers only read its
settings. ``local_session`` exists for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "vaultline.warehouse.dir"

# Settings every vaultline job relies on. AQE measures each shuffle's real
# output, so joins against dimensions are broadcast only when the measured
# side is under the threshold and stay sort-merge (with skew splitting)
# otherwise.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at max(2 x total cores, input / 256 MB) so each
    shuffle partition fits an executor core's memory share. AQE then
    coalesces small partitions toward ``partition_bytes`` and splits skewed
    ones. Files are read in ``partition_bytes`` splits.
    """
    cores = executors * cores_per_executor
    n = max(2 * cores, -(-input_bytes // partition_bytes))
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    })
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "vaultline", extra_conf: dict[str, str] | None = None
                  ) -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by the session (``spark.checkpoint.dir``)
    and make sure the context checkpoints there.

    Only when the session names none (tests on one machine) is a scratch
    folder created and registered.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="vaultline-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_CONF, path)
        except Exception:  # core setting not modifiable at runtime: the context knows it
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def warehouse_root(spark: SparkSession) -> str:
    """Shared folder for written tables: ``vaultline.warehouse.dir`` if set,
    else a stable folder next to the session's checkpoints (not the
    per-application checkpoint subfolder, so tables outlive the job)."""
    path = spark.conf.get(WAREHOUSE_CONF, None)
    if path:
        return path
    return os.path.join(ensure_checkpoint_dir(spark), "vaultline-warehouse")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared warehouse root."""
    return os.path.join(warehouse_root(spark), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` to the shared checkpoint folder (reliable, survives
    executor loss) and return the checkpointed frame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

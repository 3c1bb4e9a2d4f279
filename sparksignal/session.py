"""Session helpers.

Library code never creates a session on its own; these helpers are for tests,
``bench.py`` and scripts.  Cluster deployments pass their own session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "sparksignal", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session tuned for tests/bench (UI off, AQE on, UTC)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or os.environ.get("SPARK_MASTER") or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(executors: int, cores_per_executor: int,
                 input_bytes: int | None = None) -> dict[str, str]:
    """Suggested settings for a large cluster run (pass to ``SparkSession.builder.config``).

    Shuffle partitions start at ~3 per core (or input / 256 MB when the input size
    is known) and AQE coalesces them to ~128 MB each at run time; skewed sort-merge
    join partitions are split; scan splits are 256 MB.  Broadcasts stay under the
    default 10 MB threshold, decided from runtime sizes.
    """
    cores = executors * cores_per_executor
    parts = 3 * cores
    if input_bytes:
        parts = max(parts, input_bytes // (256 << 20))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.reuseSubquery": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is used as is.
    Only when it is unset (local tests) do we create a scratch folder and set it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()  # already in use (Spark adds a unique sub-folder)
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparksignal-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> int:
    """Delete this session's written intermediate tables; call it when no result that reads them is needed any more."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/tables")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    n = len(fs.listStatus(folder)) if fs.exists(folder) else 0
    fs.delete(folder, True)
    return n

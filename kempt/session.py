"""Session helpers: a local session for tests/bench, and the shared folder for lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kempt", driver_memory: str = "16g",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session used by tests and the benchmark (UI off, AQE on, UTC)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.driver.memory", driver_memory))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    The session's setting always wins.  Only when it is unset *and* Spark runs
    in local mode (tests) is a private folder created; on a cluster an unset
    value is an error, because a machine-local folder would not survive the
    loss of the executor that wrote it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect: the server owns the checkpoint folder
        if configured:
            return configured.rstrip("/")
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors") from None
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="kempt-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return f"{shared_dir(spark)}/kempt-scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (reliable, survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int | None:
    """Tasks that the cluster runs at once; None where it is not known."""
    try:
        return spark.sparkContext.defaultParallelism
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect has no context
        return None


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread an under-partitioned input before CPU-heavy per-row work.

    A source with fewer partitions than the cluster's default parallelism (a
    single large row group, a few big files) would leave most cores idle
    during regex and replace work on whole texts.  Only then are its rows dealt
    round-robin across the default parallelism; inputs that already have enough
    splits -- any real 100 TB table -- pass through untouched, with no shuffle
    added.  The rows are the same either way.
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect has no RDD view
        return df
    return df if have >= want else df.repartition(want)

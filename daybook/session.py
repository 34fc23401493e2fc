"""Session settings and the shared scratch location.

On a cluster the session comes configured (shuffle partitions, checkpoint
directory, memory).  ``tune`` only fills in what is unset, so it never
overrides cluster or runtime settings.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs want, as (Spark's default, wanted value).  A key is changed
# only while it still holds Spark's default and the cluster configuration does
# not name it, so explicit settings (cluster or runtime) always win.  The jobs
# also rely on adaptive execution with skew-join splitting and partition
# coalescing, which are on by default and are not touched here.  (No time
# zone either: the jobs do zone math explicitly on timestamp_ntz values.)
_DEFAULTS = {
    # Larger post-shuffle partitions for big inputs; AQE still coalesces.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("64MB", "128m"),
    # base64() must not wrap lines (attachments and tokens are single-line).
    "spark.sql.chunkBase64String.enabled": ("true", "false"),
}


def _explicit_keys(spark: SparkSession) -> set[str]:
    try:
        return {k for k, _ in spark.sparkContext.getConf().getAll()}
    except Exception:  # a remote (Connect) session has no local context
        return set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the job defaults that nobody has set."""
    explicit = _explicit_keys(spark)
    for key, (spark_default, wanted) in _DEFAULTS.items():
        if key not in explicit and str(spark.conf.get(key, spark_default)).lower() == spark_default.lower():
            spark.conf.set(key, wanted)
    return spark


# Fixed values of a large job's shuffles: bytes of its input files per hash
# partition, and of shuffled data per task after AQE has merged partitions.
INPUT_PER_PARTITION = 8 << 20
MERGED_PARTITION = "16m"


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """For a job run inside: enough shuffle partitions for its input, so that
    what one task sorts and hashes does not grow with the input.  A larger
    number is kept; the merged size is changed only where nobody set one."""
    count, merged = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    wanted = {count: str(max(int(spark.conf.get(count)), -(-input_bytes // INPUT_PER_PARTITION)))}
    if merged not in _explicit_keys(spark) and str(spark.conf.get(merged)).lower() in [v.lower() for v in _DEFAULTS[merged]]:
        wanted[merged] = MERGED_PARTITION
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    """A local session for tests and the bench (not used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # catalog tables of tests and benches go to scratch, not the cwd
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="daybook-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    directory).  Only in local mode, when nothing is configured, a fresh scratch
    folder is created and registered as the checkpoint directory; on a cluster
    a folder of one machine would be incomplete, so that is an error.
    """
    sc = spark.sparkContext
    root = None
    try:
        root = sc.getCheckpointDir()
    except Exception:
        root = None
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            root = None
    if not root:
        if not str(sc.master).split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="daybook-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root (never reused, never cleared)."""
    root = shared_root(spark)
    return f"{root}/daybook/{name}-{uuid.uuid4().hex[:12]}"

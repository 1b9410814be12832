"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings every geofleet job relies on. UTC keeps NTZ <-> instant casts at
# the edges stable; the operators themselves are written zone-free.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A stream's keyed state on the executors' disks, not their heaps; restored from its checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A repeated member of a JSON payload: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str | None = None, app_name: str = "geofleet",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with geofleet's defaults.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions`` so a
    shuffle partition stays around 128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One JVM on this machine; ``local-cluster`` has executors of its own and isn't."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session that names none gets a temporary folder if it is local (it is
    removed at exit); on any other master that is an error, as executors
    would write to disks that nobody else can read.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:                     # Spark Connect: no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="geofleet-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The application's own scratch folder. Results that are read lazily lie there until it ends; then it can go
    (``sources.files.delete_folders``)."""
    return f"{checkpoint_root(spark)}/geofleet/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application for one run."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``: their listing only, no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on ``total_cores`` cores.

    Input splits of ``partition_bytes`` keep every scan task's working set
    small. Shuffles start from as many partitions (at least two waves of the
    cluster), whatever the input, and AQE coalesces them to the advisory
    size. For the largest inputs raise ``partition_bytes``: shuffle
    bookkeeping grows with map x reduce tasks. Partitions several times the
    advisory size are split by the skew handling.
    """
    initial = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def size_for(spark: SparkSession, path: str) -> None:
    """Apply ``scale_settings`` for the files under ``path`` to this session."""
    for key, value in scale_settings(input_bytes(spark, path), spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)

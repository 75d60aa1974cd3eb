"""Session settings the operators are written for, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only what the results or the skew handling depend on. Sizes (memory, cores,
# shuffle partitions) belong to whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # What a finished query has shuffled is deleted at its end, not when the driver's heap is next collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Call sites for every column expression cost several round trips to the JVM each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Stream state larger than the heap: keep it in RocksDB and checkpoint only the changes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sessions of a stream are merged in each task first, so a frequent key is not shuffled record by record.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


# Options of the state store are no registered settings: Spark calls them unmodifiable, but each stream reads them at its start.
_STORE_OPTIONS = "spark.sql.streaming.stateStore.rocksdb."

_local_dirs: dict[str, str] = {}


def build_session(app: str = "rollcall", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in SETTINGS.items():
        if spark.conf.isModifiable(name) or name.startswith(_STORE_OPTIONS):
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the cluster names none and the master is local is a temporary
    folder taken instead.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="rollcall-")
    return _local_dirs[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"

"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that every job of this package relies on. Shuffle width and memory are left to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Look-ups by key hand their keys to the scan, where Bloom filters are asked; beyond this number only their range would go.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Shuffle files go when the query that wrote them has ended, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # State of stream joins lies beside the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "rtmart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, under the shared folder named in ``spark.checkpoint.dir``.

    Tables and checkpoints lie there, so without that setting only a session whose executors are this process may go on,
    with a local folder. ``remove_folder`` takes a finished run's folder away.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="rtmart-")
    return f"{base.rstrip('/')}/rtmart/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder made by :func:`run_folder`, with the file system that its path names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """Change one session setting for the length of a block; ``None`` changes nothing."""
    old = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None and old is not None:
            spark.conf.set(key, old)
        elif value is not None:
            spark.conf.unset(key)

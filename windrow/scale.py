"""Small helpers that decide how data is spread, shared and broadcast."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side, in rows, that the library asks Spark to broadcast.
BROADCAST_ROWS = 1_000_000


# Input splits up to which a scan counts as small and may be dealt out again.
SMALL_SPLITS = 8


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan of a few splits (at most about 1 GB at the default split size).

    Text work is CPU-bound, and one small file must not become one task. Anything larger is
    returned as it is, whatever the number of cores; there the split size is a setting
    (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``). Pass a plain scan only.
    """
    if scan.isStreaming or scan.rdd.getNumPartitions() > SMALL_SPLITS:
        return scan
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism, *keys)


def share(df: DataFrame) -> DataFrame:
    """Keep a frame that several branches of one plan read; recomputed if lost.

    For frames of bounded size: the serializer holds the last hundred cached batches of a task, of up to 4 MB
    each, which no memory manager counts. What grows with the texts is ``stored``.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# Bytes of a row group of a stored frame, the most that a task that writes one holds.
STORED_GROUP = 16 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame of the size of the input to the shared folder and read it back, a few MB per task at a time."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", STORED_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once per application."""
    sc = spark.sparkContext
    with _shipping:  # fits run in threads
        if sc.applicationId in _shipped:
            return
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="windrow-code-")) / "windrow_code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, Path(root.name) / f.relative_to(root))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint when the proven row bound allows it; otherwise let Spark decide."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a private one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="windrow-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def local_session(app: str = "windrow", cores: str | int = "*") -> SparkSession:
    """Session for tests and benches on one machine."""
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
    parts = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )

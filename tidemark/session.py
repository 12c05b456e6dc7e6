"""Session-level helpers: where to put reliable intermediate data."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _context(spark: SparkSession):
    """The SparkContext, or None for a remote (Spark Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no local context
        return None


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster-shared folder named by ``spark.checkpoint.dir``.

    The setting belongs to the cluster. Only a local-mode session without it
    (tests, laptops) gets a folder of its own; a cluster session without it
    is an error, because a machine-local folder would not survive executor
    loss and is not visible to other executors.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        master = (sc.master if sc is not None else "") or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) before running tidemark jobs on a cluster"
            )
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, for one job's output."""
    base = shared_dir(spark)
    if base.startswith("file:"):  # file:/x, file:///x -> /x (also usable by local tools)
        base = urlparse(base).path
    return os.path.join(base, "tidemark", f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are removed when it ends.

    Otherwise they stay until the driver's garbage collector finds them, and a
    run of many steps holds the files of several at once. The session's own
    setting is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def recommended_conf(
    input_bytes: int,
    partition_bytes: int = 256 << 20,
    broadcast_bytes: int = 64 << 20,
) -> dict[str, str]:
    """SQL settings sized for a job reading about ``input_bytes``.

    Initial shuffle partitions are an upper bound (about one per GiB of
    input, at least 200); adaptive execution coalesces them to about
    ``partition_bytes`` each and splits skewed join partitions. Dimensions up
    to ``broadcast_bytes`` (Spark's own size check, static and at run time)
    are broadcast, so a hot fact key never meets a sort-merge join there.
    Apply with ``spark.conf.set`` before building the marts.
    """
    shuffle = max(200, -(-int(input_bytes) // (1 << 30)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }

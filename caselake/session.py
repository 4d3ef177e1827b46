"""Session construction and shared-storage helpers.

Library code never assumes local mode: the only settings applied here are
semantic (ANSI, UTC, partition-type inference off) or adaptive-execution
switches that are safe at any scale. Sizes (shuffle partitions, file split
size) are left to the caller's cluster config unless explicitly passed.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession

# Settings every caselake job relies on for correct results.
SEMANTIC_CONF = {
    # Non-numeric casts must fail loudly; operators use try_cast where the
    # reference maps bad input to 0 (divergence D4/D11).
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # court ids such as "007" must stay strings when read back from
    # court=<id>/ directories.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Adaptive execution: runtime broadcast conversion, partition coalescing and
# skew splitting for joins and rebalances.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Arrow batches to Python workers are bounded by rows and by bytes, so a worker's memory does
# not grow with a task's rows, and a run of very long texts never makes one huge batch.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}


def release_memory() -> None:
    """Give freed memory back; a Python worker does so after a task, as it stays for later ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps the memory
        ctypes.CDLL(None).malloc_trim(0)


_SHIPPED: set[str] = set()
_PACKAGE_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> None:
    """Make ``caselake`` importable in the Python workers (the ``--py-files`` way).

    The package is zipped once per driver process and added to each
    SparkContext once; executors fetch it like any ``addPyFile`` dependency,
    so UDFs and ``mapInPandas`` kernels defined here unpickle anywhere.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    if not _PACKAGE_ZIP:
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        out = os.path.join(tempfile.mkdtemp(prefix="caselake-pyfiles-"), "caselake.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
            for folder, _, files in os.walk(pkg):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        zf.write(full, os.path.relpath(full, root))
        _PACKAGE_ZIP.append(out)
    sc.addPyFile(_PACKAGE_ZIP[0])
    _SHIPPED.add(sc.applicationId)


def get_session(
    master: str | None = None,
    app_name: str = "caselake",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or fetch) a session with caselake's semantic settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **ADAPTIVE_CONF, **ARROW_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def size_shuffles(spark: SparkSession, input_path: str, bytes_each: int = 8 * 1024 * 1024) -> None:
    """Let a shuffle begin with a partition for each ``bytes_each`` of the files under ``input_path``, and
    with ``spark.sql.shuffle.partitions`` at least. Adaptive execution joins small ones, so a task's
    share, and the memory of its sorts, does not grow with the input."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(input_path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bytes_each))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))


def recommended_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Sizing for a run over ``input_bytes`` of input (e.g. 100 TB on a large cluster).

    Shuffle partitions are sized so each holds about ``partition_bytes`` of
    input before adaptive coalescing; AQE then merges small partitions and
    splits skewed ones at run time, so partitions fit executor memory.
    """
    parts = max(200, min(1_000_000, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        **ARROW_CONF,
    }


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialized stages.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this names
    storage every executor can reach). Only when it is unset and the master is
    local, as in tests on a single machine, a temporary folder is created once
    per application and registered as the context's checkpoint directory; on a
    cluster an unset folder is an error, as executors would write to their own
    disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_CKPT:
        chosen = spark.sparkContext.getCheckpointDir()  # set by the caller's code
        if not chosen and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not chosen:
            chosen = tempfile.mkdtemp(prefix="caselake-ckpt-")
            spark.sparkContext.setCheckpointDir(chosen)
        _LOCAL_CKPT[app] = chosen.rstrip("/")
    return _LOCAL_CKPT[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")

"""Reads of the Parquet lake (S4-S6, S9, S11). Earlier stages (S4) are plain
``spark.read.parquet`` reads, or ``materialize_stage`` when written on demand."""

from __future__ import annotations

import os
import threading
import warnings
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_done(spark: SparkSession, path: str) -> bool:
    """A stage at ``path`` finished when its committer wrote ``_SUCCESS``."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))


def has_data(spark: SparkSession, path: str) -> bool:
    """A table folder holds data: any entry that is not hidden, whoever wrote it (a streaming or
    append writer may leave no ``_SUCCESS``)."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "[^_.]*"))
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return len(fs.globStatus(glob) or []) > 0


def stage_path(root: str, name: str, snapshot: str, tag: str | None = None) -> str:
    """Stage location keyed by snapshot date (and year tag when filtered)."""
    leaf = f"{name}_{snapshot}" + (f"_{tag}" if tag else "")
    return os.path.join(root, leaf)


_STAGE_LOCKS: dict[str, threading.Lock] = {}
_SCHEMAS: dict[str, object] = {}


def read_immutable_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet that cannot change while the application runs (read-only
    inputs, per-application stages), inferring its schema only once: every
    inference otherwise launches a small footer-reading job."""
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)



def materialize_stage(spark: SparkSession, name: str, inputs, build, params: dict | None = None) -> DataFrame:
    """Write stage ``name`` of the given input paths and parameters once (Parquet in the shared
    checkpoint folder) and read it back; a finished stage is reused.

    The folder is named by a digest of the inputs' listing and of the parameters, so another
    parameter or a changed file never gets an old stage. Later stages read a table whose size was
    counted as it was written, and a lost executor only recomputes from here. The cache is scoped
    to the running application, whose code does not change; reuse across runs is
    ``stages.reuse_or_build``.
    """
    import hashlib
    import json

    from caselake.session import checkpoint_dir
    from caselake.sources.stages import input_digest, read_manifest, write_measured

    inputs = [inputs] if isinstance(inputs, str) else list(inputs)
    key = json.dumps([spark.sparkContext.applicationId, input_digest(spark, inputs), params or {}], sort_keys=True, default=str)
    path = os.path.join(checkpoint_dir(spark), "stages", hashlib.md5(key.encode("utf-8")).hexdigest()[:16], name)
    with _STAGE_LOCKS.setdefault(path, threading.Lock()):
        if read_manifest(spark, path) is None:
            write_measured(build(), path)
    return read_immutable_parquet(spark, path)


def court_folders(spark: SparkSession, root: str) -> set[str]:
    """The courts that have a folder in the lake at ``root``."""
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "court=*"))
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {unquote(s.getPath().getName().removeprefix("court=")) for s in fs.globStatus(glob) or []}


def missing_courts(spark: SparkSession, root: str, courts) -> list[str]:
    """Those of ``courts`` that the lake has no folder for."""
    from caselake.operators.sinks import published_path

    found = court_folders(spark, published_path(spark, root))
    return sorted(c for c in courts if c not in found)


def scan_courts(spark: SparkSession, root: str, courts=None) -> DataFrame:
    """Opinions of the given courts from ``root/court=<id>/``.

    A filter on the partition column is pruned to those directories
    (``PartitionFilters`` in the plan). A court without a directory is warned of and
    skipped; if none has one, that is an error. Court ids stay strings (type
    inference is off). Of a published lake (K6) the current version is read.
    """
    from caselake.operators.sinks import published_path

    root = published_path(spark, root)
    if courts is not None:
        courts = list(courts)
        if not courts:
            raise ValueError("no courts selected")
        missing = missing_courts(spark, root, courts)
        if len(missing) == len(set(courts)):
            raise FileNotFoundError(f"the lake at {root} has none of the courts {', '.join(missing)}")
        if missing:
            warnings.warn(f"the lake at {root} has no court {', '.join(missing)}", stacklevel=2)
    df = spark.read.option("basePath", root).parquet(root)
    return df if courts is None else df.where(F.col("court").isin(courts))


def query_opinions(df: DataFrame, courts=None, start_year: int | None = None,
                   end_year: int | None = None, keep_unknown: bool = False,
                   order: bool = True) -> DataFrame:
    """S6 (+P6, O1): optional court set and closed year range, ordered by id as text.

    Year 0 (unknown) is dropped by a lower bound unless ``keep_unknown`` (D5).
    """
    if courts is not None:
        df = df.where(F.col("court").isin(list(courts)))
    df = filter_year_range(df, start_year, end_year, keep_unknown)
    return df.orderBy(F.col("opinion_id").cast("string")) if order else df


def filter_year_range(df: DataFrame, start_year: int | None = None, end_year: int | None = None,
                      keep_unknown: bool = False, col: str = "year") -> DataFrame:
    """Optional closed bounds on the year column."""
    cond = F.lit(True)
    if start_year:
        cond = cond & (F.col(col) >= F.lit(start_year))
    if end_year:
        cond = cond & (F.col(col) <= F.lit(end_year))
    if keep_unknown and (start_year or end_year):
        cond = cond | (F.col(col) == F.lit(0))
    return df.where(cond) if (start_year or end_year) else df


def scan_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Ready-made embeddings (Parquet with an array<float> column)."""
    return spark.read.parquet(path)


def attach_vectors(rows: DataFrame, vectors: DataFrame, key: str, text_col: str = "text", vector_col: str = "vector",
                   encoder_factory=None, dim: int = 64) -> DataFrame:
    """Every row with its ready-made vector (``vectors``: key, vector and more columns), or one
    computed from its text; ``missing`` tells which. The encoder is given only the texts without a
    vector."""
    from caselake.operators.vectors import embed

    joined = rows.join(vectors, key, "left").withColumn("missing", F.col(vector_col).isNull())
    text = F.when(F.col("missing"), F.coalesce(F.col(text_col), F.lit("")))
    made = embed(text, encoder_factory, dim, skip_null=True)
    return joined.withColumn(vector_col, F.coalesce(vector_col, made))

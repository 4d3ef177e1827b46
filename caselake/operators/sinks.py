"""Sinks (K1-K9).

Every write goes through Spark's file committer, so a job's output appears
whole at commit (``_SUCCESS``) or not at all. A table that is rewritten while
others read it is published in versions (K6, ``publish_version``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.text import fit, int_or_zero

# Fixed widths (characters) of a sink with sized columns. Nothing is cut unless a caller passes
# them, and a key (court, section_id) never is: cut keys would merge different rows.
OPINION_CHUNK_WIDTHS = {"case_name": 512, "opinion_type": 50, "text": 65535, "citation": 512}
STATUTE_CHUNK_WIDTHS = {"title_name": 256, "short_title": 512, "url": 512, "text": 65535}

OPINION_CHUNK_COLUMNS = (
    "opinion_id", "cluster_id", "case_name", "court", "year", "opinion_type",
    "chunk_index", "text", "citation",
)
STATUTE_CHUNK_COLUMNS = (
    "section_id", "title_num", "title_name", "chapter_num", "short_title",
    "chunk_index", "chunk_total", "url", "text",
)


def write_stage(df: DataFrame, path: str) -> None:
    """K1: overwrite a Parquet stage; a rebalance lets adaptive execution size the files. Its rows and
    bytes are counted by the write and kept with it."""
    from caselake.sources.stages import write_measured

    write_measured(df.hint("rebalance"), path)


def write_by_court(df: DataFrame, path: str, salt_buckets: int | None = None, mode: str = "overwrite") -> None:
    """K2: one directory per court, files sorted by year.

    A court can hold a third of all rows, so rows are not hash-partitioned on
    court alone: by default a rebalance on court lets adaptive execution split
    oversized courts; with ``salt_buckets`` each court spreads over that many
    tasks by a hash of the opinion id.
    """
    if salt_buckets:
        salt = F.pmod(F.xxhash64("opinion_id"), F.lit(salt_buckets))
        # an explicit count keeps adaptive coalescing from re-merging the salts
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartition(max(n, salt_buckets), "court", salt)
    else:
        out = df.hint("rebalance", "court")
    out.sortWithinPartitions("court", "year").write.mode(mode).partitionBy("court").parquet(path)


POINTER = "_CURRENT"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, p, p.getFileSystem(conf), conf


def publish_version(spark: SparkSession, root: str, write, keep: int = 2) -> str:
    """K6: ``write(folder)`` a whole new version of the table at ``root``, then make it the current one.

    The pointer beside the versions is replaced by one rename, last. Whoever resolved it before
    (``published_path``) goes on reading the old version whole, whoever resolves it after reads the
    new one; a job that dies before leaves the old one current. The ``keep`` newest versions stay,
    so readers have that many publications' time to finish. Returns the new folder."""
    import time
    import uuid

    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(f"{root}/{name}")
    jvm, new, fs, conf = _hadoop(spark, f"{root}/{POINTER}.{name}")
    out = fs.create(new, True)
    out.write(bytearray(name.encode("ascii")))
    out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(new, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), options)
    versions = sorted(s.getPath().getName() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v-*")))
    # Versions that came after this one are another writer's; only older ones go.
    for old in [v for v in versions if v <= name][: -keep or None]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{old}"), True)
    return f"{root}/{name}"


def published_path(spark: SparkSession, root: str) -> str:
    """The folder of the current version of ``root``; ``root`` itself if it was never published."""
    jvm, pointer, fs, _ = _hadoop(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return root
    stream = fs.open(pointer)
    name = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("ascii")
    stream.close()
    return f"{root}/{name}"


def write_marker(spark: SparkSession, snapshot: str, path: str) -> None:
    """K3: snapshot date as a one-line text file in its **own** directory."""
    spark.createDataFrame([(snapshot,)], "snapshot_date string").coalesce(1).write.mode("overwrite").text(path)


def opinion_chunk_rows(chunks: DataFrame, widths: dict | None = None) -> DataFrame:
    """K5 projection: sink types for opinion chunks, and ``widths`` where given. The raw
    ``opinion_key``, the status and the ``vector`` follow where the chunks have them."""
    w = widths or {}
    return chunks.select(
        int_or_zero("opinion_id").alias("opinion_id"),
        int_or_zero("cluster_id").alias("cluster_id"),
        fit("case_name", w, "case_name").alias("case_name"),
        "court",
        F.col("year").cast("int").alias("year"),
        fit("opinion_type", w, "opinion_type").alias("opinion_type"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        fit("text", w, "text").alias("text"),
        fit("citation", w, "citation").alias("citation"),
        *[F.col(c) for c in ("opinion_key", "precedential_status", "vector") if c in chunks.columns],
    )


def check_sink_schema(df: DataFrame, required, recreate: bool = False) -> bool:
    """K8: True when ``df`` has every required column.

    Missing columns raise unless ``recreate`` is set, in which case False tells
    the caller to rewrite the sink (the reference dropped and rebuilt it).
    """
    missing = [c for c in required if c not in set(df.columns)]
    if missing and not recreate:
        raise ValueError(f"sink is missing required columns: {missing}")
    return not missing


def write_chunk_vectors(df: DataFrame, path: str, mode: str = "append") -> None:
    """K5: write opinion chunk rows (with vectors) partitioned by court."""
    opinion_chunk_rows(df).write.mode(mode).partitionBy("court").parquet(path)


def write_stats_json(stats: DataFrame, totals: DataFrame, path: str) -> None:
    """K7: per-court stats and a one-row totals file with the scan time."""
    stats.orderBy("court_id").write.mode("overwrite").json(f"{path}/courts")
    totals.withColumn("scanned_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(f"{path}/totals")


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K9: the table as JSON lines (one object per row)."""
    df.write.mode(mode).json(path)

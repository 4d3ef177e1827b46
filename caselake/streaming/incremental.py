"""Resumable incremental runs with Structured Streaming.

A run is a streaming query over the lake (or statute files) with
``trigger(availableNow=True)``: it processes every file not yet recorded in
its checkpoint, then stops. Rerunning with the same checkpoint processes only
new files; a crash mid-run replays the unfinished batch. Each batch leaves out
the natural keys that the sink already holds, so neither a replay nor a lake
that was rewritten in place duplicates rows (idempotent, D10).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from caselake.operators.key_index import drop_key_index
from caselake.operators.sinks import OPINION_CHUNK_COLUMNS
from caselake.plans.chunks import opinion_chunks
from caselake.sources.lake import has_data

# Types of a chunk sink; court and year are its folders.
CHUNK_SCHEMA = ("opinion_id bigint, cluster_id bigint, case_name string, court string, year int, opinion_type string, "
                "chunk_index int, text string, citation string")
SALT_BUCKETS = 8  # files at most for a court and year in one batch


def stream_opinions(spark: SparkSession, lake_path: str, schema: StructType,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """T1/T2 source: new Parquet files of the opinions lake (court=<id>/ directories)."""
    reader = spark.readStream.schema(schema).option("basePath", lake_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(lake_path)


def incremental_chunks(spark: SparkSession, lake_path: str, schema: StructType, sink_path: str,
                       checkpoint_path: str, max_files_per_trigger: int | None = None,
                       native: bool = False, salt_buckets: int = SALT_BUCKETS) -> StreamingQuery:
    """Chunk the opinions of every lake file not processed yet into ``sink_path`` (Parquet by
    court and year), unless the sink holds their raw id (T3): a lake that is rewritten with the
    same rows adds nothing, and neither does a batch that is replayed.

    Returns the started query; ``query.awaitTermination()`` waits for the run,
    ``query.stop()`` stops it (T4) — state is already durable in the checkpoint,
    and ``query.lastProgress`` gives live counters (T5).
    """
    from caselake.plans.ingest import append_opinions

    def write(fresh: DataFrame) -> None:
        # Spread by court and year before chunking, so that files are few and each opinion's chunks
        # stay in one; the salt splits a court and year that hold much of the batch.
        salt = F.pmod(F.xxhash64("opinion_key"), F.lit(salt_buckets))
        rows = fresh.repartition("court", "year", salt)
        opinion_chunks(rows, native=native).write.mode("append").partitionBy("court", "year").parquet(sink_path)

    def append(batch: DataFrame, _: int) -> None:
        with _read_once(batch):
            append_opinions(batch.sparkSession, batch, sink_path, write)

    return (
        stream_opinions(spark, lake_path, schema, max_files_per_trigger)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_chunks(spark: SparkSession, sink_path: str) -> DataFrame:
    """The chunk rows of a T1 sink; no rows before the first run wrote any."""
    if not has_data(spark, sink_path):
        return spark.createDataFrame([], CHUNK_SCHEMA)
    return spark.read.schema(CHUNK_SCHEMA).parquet(sink_path).select(*OPINION_CHUNK_COLUMNS)


def run_incremental_chunks(spark: SparkSession, lake_path: str, schema: StructType, sink_path: str,
                           checkpoint_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run T1 to completion and return the sink as a batch DataFrame."""
    _finish(incremental_chunks(spark, lake_path, schema, sink_path, checkpoint_path, max_files_per_trigger))
    return read_chunks(spark, sink_path)


@contextmanager
def _read_once(batch: DataFrame):
    """A batch's files are read once, however many steps its append takes."""
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        batch.unpersist()


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def reset(spark: SparkSession, sink_path: str, checkpoint_path: str, court: str | None = None,
          year: int | None = None) -> None:
    """Forget the progress of one court, one year, both or (neither given) all of a T1 sink.

    The chunks of that scope, the checkpoint and the key index are deleted. The next run then reads
    every lake file again, but chunks only what the sink lacks; all that is outside the scope stays
    as it is. It makes the index anew from the sink's keys.
    """
    drop_key_index(spark, sink_path)
    folder = sink_path
    if court is not None or year is not None:
        folder = f"{sink_path}/court={'*' if court is None else court}/year={'*' if year is None else year}"
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in (folder, checkpoint_path):
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        for found in fs.globStatus(path) or []:
            fs.delete(found.getPath(), True)


def incremental_statutes(spark: SparkSession, title_root: str, sink_path: str, checkpoint_path: str,
                         max_files_per_trigger: int | None = None, glob: str | None = None) -> StreamingQuery:
    """T1 for statutes: title files not processed yet -> headed statute rows (Parquet).

    ``maxFilesPerTrigger`` gives per-file batches (T2); the checkpoint records
    finished files, so a rerun or a restart after a crash resumes per file.
    Keys that the sink holds are not written again (T3).
    """
    from caselake.plans.ingest import append_statutes
    from caselake.plans.statutes import statute_chunk_rows
    from caselake.sources.statutes import parse_statute_lines

    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = statute_chunk_rows(parse_statute_lines(reader.load(title_root)))

    def append(batch: DataFrame, _: int) -> None:
        with _read_once(batch):
            append_statutes(batch.sparkSession, batch, sink_path, lambda rows: rows.write.mode("append").parquet(sink_path))

    return (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )

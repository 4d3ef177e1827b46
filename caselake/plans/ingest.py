"""Vector ingest jobs: lake opinions or statute files -> chunk rows with vectors.

Both jobs are idempotent on the natural key: rows whose key is already in the
sink are skipped (insert-or-ignore), so a rerun after a crash or with the same
input adds nothing (D9, D10). Keys are looked up in the sink's key index, never
in its rows. Row counts come from ``observe`` during the write, not from a
second pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators.aggregates import with_count_metric
from caselake.operators.dedup import dedup_first
from caselake.operators.key_index import KeyIndex, append_new
from caselake.operators.vectors import embed
from caselake.plans.chunks import opinion_chunks, with_text
from caselake.plans.lake_etl import first_opinions
from caselake.plans.statutes import statute_chunk_rows
from caselake.sources.courts import INGEST_COURTS
from caselake.sources.lake import filter_year_range, has_data, scan_courts
from caselake.sources.statutes import scan_statutes_jsonl, title_file_paths

OPINION_KEY = ("opinion_id", "chunk_index")
STATUTE_KEY = ("section_id", "chunk_index")


def sink_keys(spark: SparkSession, sink_path: str, cols) -> DataFrame | None:
    """Distinct natural keys already in the sink, or None when it holds nothing yet. A sink written
    without ``opinion_key`` is known by its numeric ids, the default id 0 aside."""
    if not has_data(spark, sink_path):
        return None
    rows = spark.read.parquet(sink_path)
    if "opinion_key" in cols and "opinion_key" not in rows.columns:
        rows = rows.where("opinion_id <> 0").withColumn("opinion_key", F.col("opinion_id").cast("string"))
    return rows.select(*cols).distinct()


def opinion_index(spark: SparkSession, sink_path: str) -> KeyIndex:
    """The key index of an opinion sink: raw ids."""
    def held():
        keys = sink_keys(spark, sink_path, ["opinion_key"])
        return None if keys is None else keys.select(F.col("opinion_key").alias("key"))
    return KeyIndex(spark, sink_path, held)


def append_opinions(spark: SparkSession, lake: DataFrame, sink_path: str, write) -> None:
    """Give ``write`` the lake rows to chunk, with their raw ``opinion_key``: the first row of each id that
    the sink does not hold, if it bears text. All chunks of an opinion come from one row, in one
    task and file, so the sink has all or none of them. A row without text is not remembered:
    it is taken up when its text comes."""
    rows = with_text(first_opinions(lake, keep_key=True))
    append_new(rows, F.col("opinion_key"), opinion_index(spark, sink_path), write)


def statute_key() -> Column:
    return F.to_json(F.struct(*STATUTE_KEY))


def append_statutes(spark: SparkSession, rows: DataFrame, sink_path: str, write) -> None:
    """K4: give ``write`` the first row of each (section, chunk) that the sink does not hold."""
    def held():
        keys = sink_keys(spark, sink_path, list(STATUTE_KEY))
        return None if keys is None else keys.select(statute_key().alias("key"))
    append_new(dedup_first(rows, list(STATUTE_KEY)), statute_key(), KeyIndex(spark, sink_path, held), write)


def _write(rows: DataFrame, sink_path: str, partition_by=None) -> int:
    rows, obs = with_count_metric(rows, "inserted")
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(sink_path)
    return int(obs.get["inserted"])


def run_opinion_ingest(spark: SparkSession, lake_root: str, sink_path: str, courts=INGEST_COURTS,
                       start_year: int | None = None, end_year: int | None = None,
                       encoder_factory=None, dim: int = 768, keep_unknown: bool = False) -> int:
    """Embed job: pruned read of the chosen courts and years, skip opinions the
    sink already holds, chunks with headers, vectors from the batched encoder,
    append. Returns the number of chunk rows inserted.

    Skipping happens per raw opinion id before chunking and embedding, so a
    rerun re-embeds nothing, a repeated id is stored once, and ids that are no
    numbers are told apart though the sink shows them as 0.
    """
    lake = filter_year_range(scan_courts(spark, lake_root, courts), start_year, end_year, keep_unknown)
    inserted = []

    def write(rows: DataFrame) -> None:
        chunks = opinion_chunks(rows).withColumn("vector", embed("text", encoder_factory, dim))
        inserted.append(_write(chunks, sink_path, partition_by="court"))

    append_opinions(spark, lake, sink_path, write)
    return sum(inserted)


def run_statute_ingest(spark: SparkSession, title_root: str, sink_path: str,
                       encoder_factory=None, dim: int = 768) -> int:
    """Statute ingest: title files (minus split sets) -> active sections with a
    body -> headed rows -> skip keys already in the sink -> vectors -> append.
    Returns rows inserted."""
    records = scan_statutes_jsonl(spark, title_file_paths(spark, title_root))
    inserted = []

    def write(rows: DataFrame) -> None:
        inserted.append(_write(rows.withColumn("vector", embed("text", encoder_factory, dim)), sink_path))

    append_statutes(spark, statute_chunk_rows(records), sink_path, write)
    return sum(inserted)


def sink_progress(spark: SparkSession, sink_path: str) -> DataFrame:
    """A6 over an opinion chunk sink: opinions processed and chunks written."""
    from caselake.operators.aggregates import ingest_progress

    return ingest_progress(spark.read.parquet(sink_path).select("opinion_id"))

"""Aggregations (A1-A9). All are groupBy/agg plans with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caselake.functions.text import cite_string, citation_parts_present, format_bytes, percent_done, strip

# Fixed storage-model values.
AVG_OPINIONS_PER_DOCKET = 2.2
AVG_CHUNKS_PER_OPINION = 3.0
BYTES_PER_CHUNK = 5000


def aggregate_citations(citations: DataFrame, sep: str = ", ") -> DataFrame:
    """A1 (+P4, F3): per cluster, 'vol reporter page' strings joined by ', '.

    Order is the sorted cite strings (D7) so the result does not depend on
    shuffle arrival order; duplicates are kept.
    """
    cites = citations.where(citation_parts_present("volume", "reporter", "page")).select(
        "cluster_id", cite_string("volume", "reporter", "page").alias("cite")
    )
    return cites.groupBy("cluster_id").agg(
        F.array_join(F.sort_array(F.collect_list("cite")), sep).alias("citation")
    )


def _nonblank_court(col: str = "court_id") -> Column:
    return F.coalesce(strip(F.col(col)) != F.lit(""), F.lit(False))


def court_docket_counts(dockets: DataFrame, court_col: str = "court_id") -> DataFrame:
    """A2 (+P9): dockets per non-blank court id (stripped)."""
    return (
        dockets.where(_nonblank_court(court_col))
        .groupBy(strip(F.col(court_col)).alias("court_id"))
        .agg(F.count(F.lit(1)).alias("dockets"))
    )


def court_storage_estimate(counts: DataFrame) -> DataFrame:
    """A3 (+F17): opinions, chunks and bytes estimated from docket counts."""
    est_opinions = F.floor(F.col("dockets").cast("double") * F.lit(AVG_OPINIONS_PER_DOCKET)).cast("bigint")
    est_chunks = F.floor(F.col("est_opinions").cast("double") * F.lit(AVG_CHUNKS_PER_OPINION)).cast("bigint")
    return (
        counts.withColumn("est_opinions", est_opinions)
        .withColumn("est_chunks", est_chunks)
        .withColumn("est_bytes", F.col("est_chunks") * F.lit(BYTES_PER_CHUNK))
        .withColumn("est_storage", format_bytes(F.col("est_bytes")))
        .select("court_id", F.col("dockets").cast("bigint").alias("dockets"),
                "est_opinions", "est_chunks", "est_bytes", "est_storage")
    )


def grand_totals(dockets: DataFrame, court_col: str = "court_id") -> DataFrame:
    """A4: total dockets (blank courts included) and number of distinct non-blank courts."""
    court = F.when(_nonblank_court(court_col), strip(F.col(court_col)))
    return dockets.agg(
        F.count(F.lit(1)).alias("total_dockets"),
        F.count_distinct(court).alias("total_courts"),
    )


def with_count_metric(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A5: attach a row-count metric that fills in when ``df`` is next executed.

    Replaces a second ``count()`` job after a write: read
    ``observation.get[name]`` after the action.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def ingest_progress(chunks: DataFrame) -> DataFrame:
    """Opinions processed and chunks written, from the chunk output itself."""
    return chunks.agg(
        F.count_distinct("opinion_id").alias("opinions_processed"),
        F.count(F.lit(1)).alias("chunks_written"),
    )


def file_progress(records: DataFrame, done: DataFrame, files: DataFrame | None = None,
                  key: str = "doc_id", order_cols=("title_num", "chunk_index")) -> DataFrame:
    """A7 (+A9): per input file, kept rows, rows done, last done id, status, percent.

    ``records``: kept input rows with a ``file`` column; ``done``: rows already
    in the output (matched on ``key``); ``files``: every input file (files with
    no kept rows show as pending). The total counts kept rows only, so a
    finished file reaches 100 (D19).
    """
    done_keys = done.select(key).distinct().withColumn("_done", F.lit(1))
    r = records.join(done_keys, key, "left")
    is_done = F.col("_done").isNotNull()
    order = F.struct(*[F.col(c).try_cast("bigint").alias(f"o{i}") for i, c in enumerate(order_cols)],
                     F.col(key).alias("okey"))
    per_file = r.groupBy("file").agg(
        F.count(F.lit(1)).alias("chunks_total"),
        F.count("_done").alias("chunks_done"),
        F.max_by(F.when(is_done, F.col(key)), F.when(is_done, order)).alias("last_doc_id"),
    )
    if files is not None:
        per_file = files.select("file").distinct().join(per_file, "file", "left")
    total = F.coalesce(F.col("chunks_total"), F.lit(0)).cast("bigint")
    n_done = F.coalesce(F.col("chunks_done"), F.lit(0)).cast("bigint")
    status = (
        F.when(n_done == F.lit(0), F.lit("pending"))
        .when(n_done >= total, F.lit("complete"))
        .otherwise(F.lit("in_progress"))
    )
    return per_file.select(
        "file", status.alias("status"), n_done.alias("chunks_done"), total.alias("chunks_total"),
        "last_doc_id", percent_done(n_done, total).alias("pct"),
    )


def status_counts(progress: DataFrame) -> DataFrame:
    """Number of files per status."""
    return progress.groupBy("status").agg(F.count(F.lit(1)).alias("files"))

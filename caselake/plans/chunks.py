"""Opinion chunk pipeline: lake opinions -> effective text -> chunks -> headers.

This is the flagship query: every chunk row the vector sink receives, with
the metadata header already prepended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.chunking import CHUNK_OVERLAP, CHUNK_SIZE, legal_chunks, legal_chunks_native
from caselake.functions.enrich import enrich_chunk
from caselake.functions.text import effective_text, fit
from caselake.operators.sinks import opinion_chunk_rows
from caselake.plans.lake_etl import MIN_TEXT_LEN, STATUS
from caselake.sources.courts import court_label

META = ("opinion_id", "cluster_id", "case_name", "court", "year", "opinion_type", "citation")


def _more(opinions: DataFrame) -> tuple[str, ...]:
    """Columns that are carried along where the opinions have them."""
    return tuple(c for c in ("opinion_key", STATUS) if c in opinions.columns)


def _meta(opinions: DataFrame) -> tuple[str, ...]:
    return (*META, *_more(opinions))


def text_bearing(opinions: DataFrame, min_len: int = MIN_TEXT_LEN) -> DataFrame:
    """Opinions with their chunk-rule text (D1) of at least ``min_len`` chars, as ``body``."""
    body = effective_text("plain_text", "html_with_citations", rule="chunk")
    return opinions.select(*_meta(opinions), body.alias("body")).where(F.length("body") >= F.lit(min_len))


def with_text(opinions: DataFrame, min_len: int = MIN_TEXT_LEN) -> DataFrame:
    """The rows that ``text_bearing`` keeps, with all their columns."""
    return opinions.where(F.length(effective_text("plain_text", "html_with_citations", rule="chunk")) >= F.lit(min_len))


def text_rule_anomalies(opinions: DataFrame, min_len: int = MIN_TEXT_LEN) -> DataFrame:
    """Per court, lake rows (kept by the lake text rule) that the chunk text
    rule drops — short non-blank plain text beside long HTML — with the total."""
    body = effective_text("plain_text", "html_with_citations", rule="chunk")
    dropped = F.length(body) < F.lit(min_len)
    return opinions.groupBy("court").agg(
        F.count(F.lit(1)).alias("lake_rows"),
        F.count_if(dropped).alias("dropped_at_chunking"),
    )


def explode_chunks(df: DataFrame, chunks_col, keep) -> DataFrame:
    """W2 + P12: one row per chunk with a 0-based ``chunk_index``; no chunks, no rows."""
    return df.select(*keep, F.posexplode(chunks_col).alias("chunk_index", "chunk"))


def opinion_chunks(opinions: DataFrame, min_len: int = MIN_TEXT_LEN, size: int = CHUNK_SIZE,
                   overlap: int = CHUNK_OVERLAP, native: bool = False, widths: dict | None = None) -> DataFrame:
    """F7(chunk) -> P5 -> F11 -> W2 -> F12 -> K5 projection; an ``opinion_key`` and a status are carried along."""
    chunker = legal_chunks_native if native else legal_chunks
    src = text_bearing(opinions, min_len)
    exploded = explode_chunks(src, chunker("body", size, overlap), _meta(opinions))
    w = widths or {}
    case_name = fit("case_name", w, "case_name")
    otype = fit("opinion_type", w, "opinion_type")
    citation = fit("citation", w, "citation")
    text = enrich_chunk("chunk", case_name, court_label("court"), "year", otype, citation)
    return opinion_chunk_rows(
        exploded.select(
            "opinion_id", "cluster_id", case_name.alias("case_name"), "court", "year",
            otype.alias("opinion_type"), "chunk_index", text.alias("text"), citation.alias("citation"),
            *_more(opinions),
        ),
        w,
    )


def document_chunks(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, native: bool = False) -> DataFrame:
    """F8-F11 + W2 on any text table: (id, chunk_index, chunk, chunk_len)."""
    chunker = legal_chunks_native if native else legal_chunks
    out = explode_chunks(docs, chunker(text_col, size, overlap), [id_col])
    return out.withColumn("chunk_len", F.length("chunk"))


def searchable_chunks(chunks: DataFrame, dim: int = 768, encoder_factory=None, path: str | None = None) -> DataFrame:
    """V6: the chunk rows (with their ``opinion_key``) written once with vectors and an ``item_id`` that
    is theirs alone, ascending by raw opinion id and chunk. Filters belong before it: only what is
    searched is encoded."""
    from caselake.operators.vectors import embed
    from caselake.session import scratch_path

    path = path or scratch_path(chunks.sparkSession, "searchable")
    key = ["opinion_key", "chunk_index"]
    # Partitions follow each other in key order, and so do the numbers.
    numbered = chunks.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("item_id", F.monotonically_increasing_id())
    numbered.withColumn("vector", embed("text", encoder_factory, dim)).write.parquet(path)
    return chunks.sparkSession.read.parquet(path)

"""Statute pipeline: JSONL records -> active, non-trivial sections -> headed chunk rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.enrich import enrich_statute, statute_body
from caselake.functions.text import fit, int_or_zero

MIN_BODY_LEN = 50


def active_statutes(records: DataFrame, min_body: int = MIN_BODY_LEN) -> DataFrame:
    """P7 + P8 (+F14): status active (missing or null counts as active, D12) and
    a stripped body of at least ``min_body`` chars, exposed as ``body``."""
    active = F.coalesce(F.col("status"), F.lit("active")) == F.lit("active")
    body = statute_body("body_text", "text")
    return records.where(active).withColumn("body", body).where(F.length("body") >= F.lit(min_body))


def statute_chunk_rows(records: DataFrame, min_body: int = MIN_BODY_LEN, widths: dict | None = None) -> DataFrame:
    """F13-F16 + K5 projection for statute chunks (one row per kept record)."""
    kept = active_statutes(records, min_body)
    w = widths or {}
    text = enrich_statute("section_id", "title_num", "title_name", "chapter_num", "short_title", "body")
    return kept.select(
        F.coalesce("section_id", F.lit("")).alias("section_id"),
        int_or_zero("title_num").cast("int").alias("title_num"),
        fit(F.coalesce("title_name", F.lit("")), w, "title_name").alias("title_name"),
        int_or_zero("chapter_num").cast("int").alias("chapter_num"),
        fit(F.coalesce("short_title", F.lit("")), w, "short_title").alias("short_title"),
        int_or_zero("chunk_index").cast("int").alias("chunk_index"),
        int_or_zero(F.when(F.col("chunk_total") != F.lit(""), F.col("chunk_total")), default=1).cast("int").alias("chunk_total"),
        fit(F.coalesce("url", F.lit("")), w, "url").alias("url"),
        fit(text, w, "text").alias("text"),
    )

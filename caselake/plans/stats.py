"""Court statistics: docket counts and storage estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from caselake.operators.aggregates import court_docket_counts, court_storage_estimate, grand_totals


def court_stats(dockets_raw: DataFrame, court_col: str = "court_id") -> DataFrame:
    """One row per non-blank court: dockets, est_opinions, est_chunks, est_bytes, est_storage."""
    return court_storage_estimate(court_docket_counts(dockets_raw, court_col))


def court_totals(dockets_raw: DataFrame, court_col: str = "court_id") -> DataFrame:
    """One row: total_dockets (every row), total_courts (distinct non-blank)."""
    return grand_totals(dockets_raw, court_col)

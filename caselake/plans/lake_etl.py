"""Lake ETL: dockets -> clusters (+citations) -> opinions, as three lazy stages.

``run_lake_etl`` materializes each stage as Parquet in order (each later stage
reads the previous one back, so lineage is cut at every stage and a lost
executor only recomputes from the last written stage).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.text import (
    best_case_name,
    default_blank,
    effective_text,
    opinion_type,
    year_of,
)
from caselake.operators.aggregates import aggregate_citations, with_count_metric
from caselake.operators.dedup import dedup_first, first_of_wide
from caselake.operators.joins import (
    CLUSTERS_BROADCAST_ROWS,
    DOCKETS_BROADCAST_ROWS,
    attach_citations,
    clusters_with_court,
    opinions_with_clusters,
    restrict_to_known,
)
from caselake.operators.sinks import publish_version, write_by_court, write_stage
from caselake.sources.courts import LAKE_COURTS

MIN_TEXT_LEN = 150
STATUS = "precedential_status"

OPINION_COLUMNS = (
    "opinion_id", "cluster_id", "case_name", "court", "year", "citation",
    "opinion_type", "plain_text", "html_with_citations",
)


def dockets_stage(dockets_raw: DataFrame, courts=LAKE_COURTS, dedup: bool = True) -> DataFrame:
    """Job 1 (P1-P3, W1): dockets of the court set as (docket_id, court_id).

    The membership filter is written first so it reaches the scan.
    """
    d = (
        dockets_raw.where(F.col("court_id").isin(list(courts)))
        .select(F.col("id").alias("docket_id"), F.col("court_id"))
        .dropna(subset=["docket_id", "court_id"])
    )
    return dedup_first(d, "docket_id", order="court_id") if dedup else d


def clusters_stage(clusters_raw: DataFrame, dockets: DataFrame, citations_raw: DataFrame,
                   max_broadcast_rows: int = DOCKETS_BROADCAST_ROWS) -> DataFrame:
    """Job 2 (F1, F2, J1, J4, A1, J2): clusters of known dockets with court, year, citation, and their
    precedential status where the snapshot has it (P13)."""
    status = [c for c in (STATUS,) if c in clusters_raw.columns]
    c = clusters_raw.select(
        F.col("id").alias("cluster_id"),
        F.col("docket_id"),
        year_of("date_filed").alias("year"),
        best_case_name("case_name", "case_name_short", "case_name_full").alias("case_name"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in status],
    )
    # One row per cluster id before any join (first by docket, year, name). Ids that come once are
    # not sorted; all rows without an id are one cluster.
    order = [F.col(x) for x in c.columns if x != "cluster_id"]
    c = first_of_wide(c.where("cluster_id IS NOT NULL"), "cluster_id", order).unionByName(
        dedup_first(c.where("cluster_id IS NULL"), "cluster_id"))
    joined = clusters_with_court(c, dockets, max_broadcast_rows).select("cluster_id", "case_name", "court", "year", *status)
    # Semi-join first: only citations of selected clusters are aggregated.
    cites = aggregate_citations(restrict_to_known(citations_raw, joined, "cluster_id"))
    return attach_citations(joined, cites).select("cluster_id", "case_name", "court", "year", "citation", *status)


def first_opinions(opinions: DataFrame, keep_key: bool = False) -> DataFrame:
    """W1 on opinions: one row per raw id (``opinion_key``, as text), the first by its narrow columns,
    then by the lengths of its texts, then by a digest of them. A row without an id is known by its
    content instead."""
    texts = ("plain_text", "html_with_citations")
    narrow = [F.col(c) for c in sorted(opinions.columns) if c not in (*texts, "opinion_id")]
    order = [*narrow, *[F.length(c) for c in texts], F.xxhash64(*texts)]
    named = opinions.where("opinion_id IS NOT NULL").withColumn("opinion_key", F.col("opinion_id").cast("string"))
    one = first_of_wide(named, "opinion_key", order)
    nameless = opinions.where("opinion_id IS NULL")
    if not nameless.select("opinion_id").isEmpty():
        content = F.sha2(F.to_json(F.struct("cluster_id", *texts)), 256)
        one = one.unionByName(first_of_wide(nameless.withColumn("opinion_key", F.concat(F.lit("no-id:"), content)), "opinion_key", order))
    return one if keep_key else one.drop("opinion_key")


def opinions_stage(opinions_raw: DataFrame, clusters: DataFrame, min_len: int = MIN_TEXT_LEN,
                   max_broadcast_rows: int = CLUSTERS_BROADCAST_ROWS) -> DataFrame:
    """Job 3 (J3, W1, F5, F4, F6, F7 lake rule, P5, P10): denormalized text-bearing opinions, one per
    id. The first of a repeated id is chosen among the rows of known clusters, before the text rule."""
    o = opinions_raw.select(
        F.col("id").alias("opinion_id"), "cluster_id", "type", "plain_text", "html_with_citations"
    )
    status = [c for c in (STATUS,) if c in clusters.columns]
    j = first_opinions(opinions_with_clusters(o, clusters, max_broadcast_rows))
    out = j.select(
        "opinion_id", "cluster_id", "case_name", "court", "year", "citation",
        opinion_type("type").alias("opinion_type"),
        default_blank("plain_text").alias("plain_text"),
        default_blank("html_with_citations").alias("html_with_citations"),
        *status,
    )
    lake_text = effective_text("plain_text", "html_with_citations", rule="lake", min_len=min_len)
    return out.where(F.length(lake_text) >= F.lit(min_len)).select(*OPINION_COLUMNS, *status)


def run_lake_etl(spark: SparkSession, dockets_raw: DataFrame, clusters_raw: DataFrame,
                 citations_raw: DataFrame, opinions_raw: DataFrame, out_root: str,
                 courts=LAKE_COURTS, salt_buckets: int | None = None, publish: bool = False) -> dict:
    """Run the three stages, writing each before the next reads it. With ``publish`` the opinions are
    a new version of the table (K6), so that nobody reads half of a rewrite.

    Returns the row counts observed during the writes (no second pass).
    """
    counts = {}
    dockets_path = os.path.join(out_root, "dockets")
    clusters_path = os.path.join(out_root, "clusters")
    opinions_path = os.path.join(out_root, "opinions")

    d, obs = with_count_metric(dockets_stage(dockets_raw, courts), "dockets")
    write_stage(d, dockets_path)
    counts["dockets"] = obs.get["dockets"]

    c, obs = with_count_metric(
        clusters_stage(clusters_raw, spark.read.parquet(dockets_path), citations_raw), "clusters"
    )
    write_stage(c, clusters_path)
    counts["clusters"] = obs.get["clusters"]

    o, obs = with_count_metric(opinions_stage(opinions_raw, spark.read.parquet(clusters_path)), "opinions")
    if publish:
        publish_version(spark, opinions_path, lambda folder: write_by_court(o, folder, salt_buckets=salt_buckets))
    else:
        write_by_court(o, opinions_path, salt_buckets=salt_buckets)
    counts["opinions"] = obs.get["opinions"]
    return counts

"""Joins of the pipeline.

Broadcast is used only behind a check of rows and bytes (``broadcast_if_bounded``);
above the bound the join is left to the planner (sort-merge, or AQE's runtime
conversion when the shuffled side turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.sources.stages import row_bytes, stage_size

# Default row bounds for broadcast build sides (narrow rows: ids + a few strings).
DOCKETS_BROADCAST_ROWS = 2_000_000
CLUSTERS_BROADCAST_ROWS = 1_000_000
DIMENSION_BROADCAST_ROWS = 100_000
LOOKUP_BROADCAST_ROWS = 1_000_000
# Byte bound for any broadcast build side (well under Spark's 8 GB hard limit).
BROADCAST_MAX_BYTES = 512 * 1024 * 1024
# A key with so large a share of the rows is not left to one task of a shuffle join.
HOT_SHARE = 0.01


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` of data (string bytes plus
    fixed-width columns).

    A written stage knows both from its write (``stages.write_measured``): nothing is read.
    Otherwise they are summed over the rows, task by task.
    """
    size = stage_size(df)
    if size is None:
        size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("bytes")).first().asDict()
    return (size["rows"] or 0) <= max_rows and (size["bytes"] or 0) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it fits the bounds; else it is returned unhinted and the planner
    (sort-merge, AQE) decides."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-spread a *bare scan* that has fewer splits than the cluster can run.

    Per-row work downstream (regex cleanup, the chunker UDF) then uses every
    core. A scan that already has enough splits — the normal case for a
    large lake — is returned untouched, so no shuffle is added at scale.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. a remote session): leave it
        return df
    if splits >= target:
        return df
    return df.repartition(target, key)


def clusters_with_court(clusters: DataFrame, dockets: DataFrame,
                        max_broadcast_rows: int = DOCKETS_BROADCAST_ROWS) -> DataFrame:
    """Inner equi-join on docket_id; clusters outside the court set drop out."""
    d = dockets.select("docket_id", F.col("court_id").alias("court"))
    return clusters.join(broadcast_if_bounded(d, max_broadcast_rows), "docket_id", "inner")


def restrict_to_known(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Left semi-join — keep rows whose key occurs in ``keys``."""
    return df.join(keys.select(key), key, "left_semi")


def attach_citations(clusters: DataFrame, citations: DataFrame) -> DataFrame:
    """Left outer on cluster_id, missing citation -> ''."""
    return clusters.join(citations, "cluster_id", "left").withColumn(
        "citation", F.coalesce(F.col("citation"), F.lit(""))
    )


def opinions_with_clusters(opinions: DataFrame, clusters: DataFrame,
                           max_broadcast_rows: int = CLUSTERS_BROADCAST_ROWS) -> DataFrame:
    """Inner equi-join on cluster_id, carrying case_name, court, year, citation.

    Broadcasting the clusters side keeps the (large, text-bearing) opinions
    from being shuffled at all; above the bound, a sort-merge join is used.
    """
    return opinions.join(broadcast_if_bounded(clusters, max_broadcast_rows), "cluster_id", "inner")


def skip_done(df: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Rows whose natural key is not in ``done`` (robust resume, D9)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def lookup_or_default(df: DataFrame, lookup: DataFrame, key: str, defaults: dict, max_broadcast_rows: int = LOOKUP_BROADCAST_ROWS,
                      hot_share: float = HOT_SHARE) -> DataFrame:
    """Left lookup; missing values take the given defaults.

    A lookup that fits the bounds is broadcast. Otherwise the rows are split: those without a key need
    no join; those of a key with ``hot_share`` of all rows or more (ids that failed to parse share
    one) stay where they are and meet the lookup's few rows of such keys by broadcast; only the
    rest is shuffled. At most 1 / hot_share keys are hot.
    """
    cols = [c for c in lookup.columns if c != key]
    if fits_broadcast(lookup, max_broadcast_rows):
        parts = [df.join(F.broadcast(lookup), key, "left")]
    else:
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        total = df.count()
        hot = [r[key] for r in counts.where(F.col("_n") >= max(2.0, hot_share * total)).select(key).collect()]
        is_hot = F.col(key).isin(hot) if hot else F.lit(False)
        none = df.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(t).alias(c) for c, t in lookup.dtypes if c != key])
        parts = [df.where(F.col(key).isNotNull() & ~is_hot).join(lookup, key, "left"), none]
        if hot:
            few = broadcast_if_bounded(lookup.where(is_hot), max_broadcast_rows or LOOKUP_BROADCAST_ROWS)
            parts.append(df.where(is_hot).join(few, key, "left"))
    out = None
    for part in parts:
        for c in cols:
            if c in defaults:
                part = part.withColumn(c, F.coalesce(F.col(c), F.lit(defaults[c])))
        part = part.select(*df.columns, *cols)
        out = part if out is None else out.unionByName(part)
    return out


def label_courts(df: DataFrame, dim: DataFrame, court_col: str = "court") -> DataFrame:
    """Court -> display label via the court dimension; unknown courts keep their id."""
    labels = broadcast_if_bounded(
        dim.select(F.col("id").alias("_court"), F.col("label").alias("_label")), DIMENSION_BROADCAST_ROWS
    )
    out = df.join(labels, df[court_col] == labels["_court"], "left")
    return out.withColumn("court_label", F.coalesce(F.col("_label"), F.col(court_col))).drop("_court", "_label")


def attach_estimates(dim: DataFrame, stats: DataFrame) -> DataFrame:
    """Court dimension ⟕ stats -> '~<size>' badge, '' when not scanned."""
    s = stats.select(F.col("court_id").alias("id"), "est_storage")
    return dim.join(s, "id", "left").select(
        *dim.columns,
        F.when(F.col("est_storage").isNotNull(), F.concat(F.lit("~"), F.col("est_storage")))
        .otherwise(F.lit("")).alias("estimate"),
    )

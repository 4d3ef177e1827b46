"""Deduplication and insert-or-ignore.

Dedup is an aggregation (min/max of a struct led by the order columns), not a
window: the aggregate combines map-side, so a key holding a third of all rows
collapses to one row per task before the shuffle instead of landing whole in
one window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPEATED_BROADCAST = 1_000_000  # repeated keys that are broadcast


def _dedup(df: DataFrame, keys, order, pick) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    # Order columns lead the struct; remaining columns break ties deterministically.
    fields = order + rest
    if not fields:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = df.groupBy(*keys).agg(pick(packed).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.f{i}").alias(c) for i, c in enumerate(fields)]).select(*df.columns)


def dedup_first(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key — the smallest by ``order`` (then by the other columns)."""
    return _dedup(df, keys, order, F.min)


def dedup_last(df: DataFrame, keys, order=None) -> DataFrame:
    """One row per key — the largest by ``order`` (then by the other columns)."""
    return _dedup(df, keys, order, F.max)


def insert_or_ignore(new_rows: DataFrame, target: DataFrame, keys, order=None) -> DataFrame:
    """K4: rows to append — first row per key among ``new_rows``, minus keys already in ``target``.

    Existing target rows are never changed (first write wins).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    fresh = dedup_first(new_rows, keys, order)
    return fresh.join(target.select(*keys).distinct(), keys, "left_anti")


def first_of_wide(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """W1 for rows with long texts: one row per key, the first by ``order``.

    Keys that come several times are found from the key column alone (one narrow job, its result
    written once). All other rows pass where they are read: their texts are neither shuffled nor
    sorted. Rows of repeated keys are sorted by key and ``order``, which should be narrow; each task
    keeps its first row of a key before the shuffle. Rows that ``order`` cannot tell apart count as
    the same row. ``key`` must not be null. Repeated keys that are too many to broadcast would have both
    joins shuffle all rows: then all rows are sorted, in one shuffle.
    """
    from caselake.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, "repeated-keys")
    df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key).write.parquet(path)
    repeated = spark.read.schema(df.select(key).schema).parquet(path)
    many = repeated.count()
    if not many:
        return df
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    if many > REPEATED_BROADCAST:
        return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
    repeated = F.broadcast(repeated)
    chosen = df.join(repeated, key, "left_semi").withColumn("_nth", nth).where("_nth = 1").drop("_nth")
    return df.join(repeated, key, "left_anti").select(*df.columns).unionByName(chosen.select(*df.columns))

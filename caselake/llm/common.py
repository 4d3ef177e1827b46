"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.session import ARROW_CONF, SEMANTIC_CONF, release_memory, scratch_path, ship_package


def prepare(spark: SparkSession) -> None:
    """Session settings that every operator here relies on; ships the package to the workers."""
    for key, value in {**SEMANTIC_CONF, **ARROW_CONF}.items():
        spark.conf.set(key, value)
    ship_package(spark)


def lean(kernel):
    """A kernel after which its worker gives freed memory back: workers stay for later tasks."""
    def run(batches):
        yield from kernel(batches)
        release_memory()
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a point that survives lost executors, and lets several
    consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def range_parts(df: DataFrame, *keys: str | Column, name: str) -> DataFrame:
    """``df`` range-partitioned by ``keys`` and staged, with ``part``: the partition's
    number, ascending in key order. Equal keys share a part."""
    return stage(df.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), name)


def part_offsets(sums: DataFrame, total: str) -> DataFrame:
    """(part, base): what all earlier parts hold together. ``sums`` has a row per part
    and a ``total`` column, so the one-task window sees one row per partition, no more."""
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum(total).over(w), F.lit(0)).alias("base"))

"""A key holding a third of all rows: results stay whole and the work is split."""

import os

from pyspark.sql import functions as F

from caselake.operators.aggregates import court_docket_counts
from caselake.operators.dedup import dedup_first
from caselake.operators.sinks import write_by_court
from caselake.session import recommended_conf


def _skewed(spark, n=30_000):
    # one court ("hot") holds a third of the rows; ids are unique
    return spark.range(n).select(
        F.col("id").cast("string").alias("opinion_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("court"),
        (F.lit(1990) + F.col("id") % 30).cast("int").alias("year"),
        F.lit("x").alias("text"),
    )


def test_salted_court_write_splits_hot_court(spark, tmp_path):
    df = _skewed(spark)
    out = str(tmp_path / "lake")
    write_by_court(df, out, salt_buckets=8)
    hot_files = [f for f in os.listdir(os.path.join(out, "court=hot")) if f.endswith(".parquet")]
    assert len(hot_files) >= 4
    back = spark.read.parquet(out)
    assert back.count() == df.count()
    assert back.where("court = 'hot'").count() == 10_000


def test_hot_key_dedup_and_counts(spark):
    df = _skewed(spark).withColumn("k", F.when(F.col("court") == "hot", F.lit("hot")).otherwise(F.col("opinion_id")))
    out = dedup_first(df.select("k", "opinion_id", "court"), "k", "opinion_id")
    assert out.count() == 20_001
    assert out.where("k = 'hot'").first()["opinion_id"] == "0"
    counts = {r["court_id"]: r["dockets"] for r in court_docket_counts(df.withColumnRenamed("court", "court_id")).collect()}
    assert counts["hot"] == 10_000 and sum(counts.values()) == 30_000
    plan = court_docket_counts(df.withColumnRenamed("court", "court_id"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # combined map-side before the shuffle


def test_recommended_conf():
    conf = recommended_conf(100 * 1024 ** 4)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 100_000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(conf["spark.sql.execution.arrow.maxBytesPerBatch"]) <= 64 * 1024 * 1024
    small = recommended_conf(10 * 1024 ** 3)
    assert int(small["spark.sql.shuffle.partitions"]) == 200  # floor for small inputs


def test_lookup_splits_the_hot_key(spark):
    """A third of the rows share one key and some have none; the lookup is not broadcast."""
    from caselake.operators.joins import lookup_or_default

    n = 40_000
    df = spark.range(0, n, 1, 40).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("key"))
    lookup = spark.range(1, n, 2).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    lookup = lookup.unionByName(spark.createDataFrame([(0, "zero")], "key long, name string"))
    for bound in (0, 10**6):
        got = lookup_or_default(df, lookup, "key", {"name": "Unknown"}, max_broadcast_rows=bound)
        want = df.join(lookup, "key", "left").select("id", "key", F.coalesce("name", F.lit("Unknown")).alias("name"))
        assert got.columns == ["id", "key", "name"]
        assert sorted(got.collect(), key=lambda r: r["id"]) == sorted(want.collect(), key=lambda r: r["id"])
    split = lookup_or_default(df, lookup, "key", {"name": "Unknown"}, max_broadcast_rows=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = split.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert per_task.sum() == n and per_task.max() <= max(0.05 * n, 1.3 * (n * 4 / 7) / 8)  # eight shuffle tasks share the rest
    plan = split._jdf.queryExecution().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_wide_dedup_carries_no_text_through_a_sort_of_other_rows(spark):
    from caselake.operators.dedup import first_of_wide

    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"), (5000 - F.col("id")).alias("n"),
        F.concat(F.lit("long text "), "id").alias("text"))
    order = [F.col("n"), F.length("text"), F.xxhash64("text")]
    one = first_of_wide(rows, "key", order)
    got = {r["key"]: (r["n"], r["text"]) for r in one.collect()}
    assert len(got) == 2001 == one.count() and got["hot"] == (5000 - 2997, "long text 2997") and got["7"] == (4993, "long text 7")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    unique = rows.where("key <> 'hot'")
    assert first_of_wide(unique, "key", order).sameSemantics(unique)


def test_opinion_texts_are_in_no_sort_aggregate(spark):
    from caselake.plans import queries as QQ

    for name in ("opinions_denorm", "opinions_first_wins", "enriched_opinion_chunks"):
        plan = QQ.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan


def test_opinions_without_ids_are_known_by_content(spark):
    from caselake.plans.lake_etl import first_opinions

    rows = [(None, "1", "text a", None), (None, "1", "text a", None), (None, "1", "text b", None), ("7", "1", "long text", "x"), ("7", "1", "short", "x"), ("x7", "1", "s", "")]
    df = spark.createDataFrame(rows, "opinion_id string, cluster_id string, plain_text string, html_with_citations string")
    got = sorted(((r["opinion_id"] or "", r["plain_text"]) for r in first_opinions(df).collect()))
    assert got == [("", "text a"), ("", "text b"), ("7", "short"), ("x7", "s")]

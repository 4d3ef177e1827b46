"""Stage manifests: reuse only for the same inputs and parameters, sizes counted by the write."""

import os

from pyspark.sql import functions as F

from caselake.operators.joins import broadcast_if_bounded, clusters_with_court, fits_broadcast, opinions_with_clusters
from caselake.sources.lake import materialize_stage
from caselake.sources.stages import MANIFEST, read_manifest, reuse_or_build, stage_size, write_measured


def test_changed_inputs_and_parameters_build_anew(spark, tmp_path):
    source, target, built = str(tmp_path / "in"), str(tmp_path / "stage"), []
    spark.range(5).write.parquet(source)

    def stage(params):
        def build():
            built.append(params)
            return spark.read.parquet(source).where(F.col("id") < params["most"])
        return sorted(r["id"] for r in reuse_or_build(spark, target, [source], params, build).collect())

    assert stage({"most": 3}) == [0, 1, 2] == stage({"most": 3}) and len(built) == 1
    assert stage({"most": 4}) == [0, 1, 2, 3] and len(built) == 2
    spark.range(2).write.mode("append").parquet(source)
    assert stage({"most": 4}) == [0, 0, 1, 1, 2, 3] and len(built) == 3
    os.remove(f"{target}/{MANIFEST}")  # cut off before its end
    assert stage({"most": 4}) == [0, 0, 1, 1, 2, 3] and len(built) == 4


def test_materialized_stage_follows_its_inputs(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(3).write.parquet(source)
    get = lambda most: materialize_stage(spark, "t", source, lambda: spark.read.parquet(source).where(F.col("id") < most), {"most": most}).count()
    assert (get(2), get(3), get(2)) == (2, 3, 2)
    spark.range(3).write.mode("append").parquet(source)
    assert (get(2), get(3)) == (4, 6)


def test_sizes_are_counted_by_the_write(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("ab", 1), (None, 2), ("çd", 3)], "t string, n bigint")
    assert write_measured(df, path) == {"rows": 3, "bytes": 3 * (16 + 8) + 2 + 3}
    back = spark.read.parquet(path)
    assert stage_size(back.select("n"))["rows"] == 3 == read_manifest(spark, path)["rows"]
    assert stage_size(df) is None and stage_size(back.union(df).join(back, "n"))["rows"] == 3
    assert fits_broadcast(back, 3) and not fits_broadcast(back, 2) and not fits_broadcast(back, 3, 76)
    assert fits_broadcast(df, 3) and not fits_broadcast(df, 2)  # not a stage: counted
    write_measured(df.where("n > 9"), path)
    assert read_manifest(spark, path)["rows"] == 0 and stage_size(spark.read.schema(df.schema).parquet(path)) in (None, {"rows": 0, "bytes": 0})


def test_the_check_before_a_broadcast_runs_no_limit(spark, tmp_path):
    dockets, clusters = str(tmp_path / "d"), str(tmp_path / "c")
    write_measured(spark.range(50).select(F.col("id").cast("string").alias("docket_id"), F.lit("sc").alias("court_id")), dockets)
    write_measured(spark.range(90).select(F.col("id").cast("string").alias("cluster_id"), (F.col("id") % 60).cast("string").alias("docket_id")), clusters)
    d, c = spark.read.parquet(dockets), spark.read.parquet(clusters)
    o = c.select("cluster_id", F.lit("t").alias("text"))
    for bound, kind in ((50, "BroadcastHashJoin"), (49, None)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = clusters_with_court(c, d, bound)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert joined.count() == 80 and ("BroadcastHashJoin" in plan) == (kind is not None) and "Limit" not in plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert opinions_with_clusters(o, c, 10).count() == 90
    calls = spark.sparkContext._jsc.sc().statusTracker().getJobIdsForGroup(None)
    broadcast_if_bounded(d, 50)
    assert len(spark.sparkContext._jsc.sc().statusTracker().getJobIdsForGroup(None)) == len(calls)  # it ran no job

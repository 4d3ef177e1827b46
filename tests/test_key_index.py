"""The key index of a sink: appends, crashes between the steps, buckets, merging."""

import os

import pytest
from pyspark.sql import functions as F

from caselake.operators import key_index
from caselake.operators.key_index import KeyIndex, append_new, drop_key_index
from caselake.sources.lake import has_data


def sink_at(spark, path, buckets=8):
    def held():
        return spark.read.parquet(path).select("key").distinct() if has_data(spark, path) else None
    return KeyIndex(spark, path, held, buckets)


def rows_of(spark, *keys):
    return spark.createDataFrame([(k, f"text of {k}") for k in keys], "key string, text string")


def run(spark, path, *keys):
    append_new(rows_of(spark, *keys), F.col("key"), sink_at(spark, path), lambda r: r.write.mode("append").parquet(path))


def stored(spark, path):
    return sorted(r["key"] or "" for r in spark.read.schema("key string, text string").parquet(path).collect())


def test_only_new_keys_are_appended(spark, tmp_path):
    path = str(tmp_path / "sink")
    run(spark, path, "a", "b")
    run(spark, path, "b", "c", None)
    run(spark, path, "a", "b", "c")
    assert stored(spark, path) == ["", "a", "b", "c"]


def test_a_sink_without_an_index_gets_one(spark, tmp_path):
    path = str(tmp_path / "sink")
    rows_of(spark, "a", "b").write.parquet(path)
    run(spark, path, "b", "c")
    drop_key_index(spark, path)
    run(spark, path, "a", "c", "d")
    assert stored(spark, path) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("step", ["data", "marker"])
def test_a_crash_between_the_steps(spark, tmp_path, monkeypatch, first, step):
    path = str(tmp_path / "sink")
    if not first:
        run(spark, path, "a")

    def crash(*_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        if step == "data":  # keys written, data not
            append_new(rows_of(spark, "a", "b", "c"), F.col("key"), sink_at(spark, path), crash)
        else:  # data written, marker not
            monkeypatch.setattr(KeyIndex, "finish", crash)
            run(spark, path, "a", "b", "c")
    monkeypatch.undo()
    run(spark, path, "a", "b", "c", "d")
    assert stored(spark, path) == ["a", "b", "c", "d"]
    finished, left_open = sink_at(spark, path).batches()
    assert finished and not left_open


def test_a_batch_reads_only_its_buckets_and_never_the_sink(spark, tmp_path):
    path = str(tmp_path / "sink")
    run(spark, path, *[f"k{n}" for n in range(200)])
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    index = sink_at(spark, path)
    known = index.known(spark.createDataFrame([("k5",), ("new",)], "key string"))
    plan = known._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("_key_index" in line and "bucket" in line.split("PartitionFilters")[1] for line in scans)
    assert [r["key"] for r in known.collect()] == ["k5"]
    every = index.entries().inputFiles()
    buckets = {r[0] for r in index._bucketed(spark.createDataFrame([("k5",), ("new",)], "key string")).select("bucket").collect()}
    assert len(buckets) <= 2 < len({f.split("bucket=")[-1].split("/")[0] for f in every})


def test_many_appends_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "MERGE_AT", 3)
    path = str(tmp_path / "sink")
    for n in range(6):
        run(spark, path, f"k{n}", f"k{n + 1}")
    assert stored(spark, path) == [f"k{n}" for n in range(7)]
    assert len(sink_at(spark, path).batches()[0]) <= 3
    assert len(os.listdir(f"{path}/_key_index/buckets=8/entries")) <= 3

"""Properties from the test strategy: idempotence, one row per key, dense chunk indexes, reset."""

from pyspark.sql import functions as F

from caselake.functions.text import strip_html
from caselake.operators.dedup import dedup_first
from caselake.plans import queries as QQ
from caselake.sources import standins as S
from tests.conftest import SF_MID, SF_SMALL


def test_strip_html_idempotent(spark):
    pages = S.table(spark, SF_MID, "pages")
    once = pages.select(strip_html("html").alias("a"))
    assert once.where(F.col("a") != strip_html(F.col("a"))).count() == 0


def test_dedup_one_row_per_key(spark):
    li = S.table(spark, SF_MID, "lineitem")
    out = dedup_first(li, "l_orderkey", "l_linenumber")
    assert out.count() == li.select("l_orderkey").distinct().count()
    first = li.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("first"))
    assert out.join(first, "l_orderkey").where(F.col("l_linenumber") != F.col("first")).count() == 0


def test_chunk_index_dense(spark):
    ch = QQ.QUERIES["enriched_opinion_chunks"](spark, SF_SMALL)
    per = ch.groupBy("opinion_id").agg(F.count(F.lit(1)).alias("n"), F.min("chunk_index").alias("lo"),
                                       F.max("chunk_index").alias("hi"), F.count_distinct("chunk_index").alias("d"))
    assert per.where((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1) | (F.col("d") != F.col("n"))).count() == 0


def test_reset_reruns_scope(spark, tmp_path):
    from caselake.streaming.incremental import read_chunks, reset, run_incremental_chunks

    lake, sink, ckpt = (str(tmp_path / x) for x in ("lake", "sink", "ckpt"))
    QQ.lake_opinions(spark, SF_SMALL).write.partitionBy("court").parquet(lake)
    schema = spark.read.parquet(lake).schema
    n = run_incremental_chunks(spark, lake, schema, sink, ckpt).count()
    for scope in ({}, {"court": "BUILDING"}, {"year": 1996}, {"court": "MACHINERY", "year": 1995}):
        reset(spark, sink, ckpt, **scope)
        assert not scope or read_chunks(spark, sink).count() < n
        assert run_incremental_chunks(spark, lake, schema, sink, ckpt).count() == n

"""Plan-shape tests: pushdown, pruning, join strategy, no row-at-a-time Python."""

from caselake.plans import queries as QQ
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_court_filter_reaches_scan(spark):
    p = plan(QQ.lake_dockets(spark, SF_SMALL))
    assert "PushedFilters: [In(c_mktsegment" in p


def test_partition_pruning(spark):
    df = QQ.QUERIES["partition_pruned_read"](spark, SF_SMALL)
    p = plan(df)
    assert "PartitionFilters: [" in p and "court" in p.split("PartitionFilters: [")[1].split("]")[0]


def test_column_pruning(spark):
    p = plan(QQ.QUERIES["html_strip"](spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_flagship_strategy(spark):
    df = QQ.QUERIES["enriched_opinion_chunks"](spark, SF_SMALL)
    p = plan(df)
    assert "BatchEvalPython" not in p  # no row-at-a-time Python UDF
    assert "ArrowEvalPython" in p  # the chunker is Arrow-batched
    assert "BroadcastHashJoin" in p  # clusters side is size-checked and broadcast
    # the opinion text is shuffled once, to keep one row per id, after opinions of other courts
    # are gone; the other exchange is the initial spread of a table of one split
    assert p.count("Exchange hashpartitioning") <= 2


def test_lake_path_has_no_python(spark):
    p = plan(QQ.QUERIES["opinions_denorm"](spark, SF_SMALL))
    assert "EvalPython" not in p


def test_topk_uses_window_group_limit(spark):
    df = QQ.QUERIES["cosine_topk"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    # per-task top-k before the shuffle, then the final top-k
    assert "WindowGroupLimit" in final and ", Partial" in final and ", Final" in final
    assert "MapInPandas" in final


def test_dedup_is_an_aggregate(spark):
    p = plan(QQ.QUERIES["dedup_first"](spark, SF_SMALL))
    assert "Aggregate" in p and "Window" not in p


def test_encoder_runs_once_in_vector_search(spark):
    from pyspark.sql import functions as F

    from caselake.operators.vectors import embed, vector_topk

    docs = spark.createDataFrame([(i, f"word{i} shared text") for i in range(20)], "doc_id long, text string")
    corpus = docs.select(F.col("doc_id").alias("item_id"), embed("text", None, 16).alias("vector"))
    queries = spark.createDataFrame([(1, [1.0] * 16)], "query_id long, vector array<float>")
    p = plan(vector_topk(queries, corpus, 3))
    assert p.count("ArrowEvalPython") == 1  # no filter pushed under the encoder

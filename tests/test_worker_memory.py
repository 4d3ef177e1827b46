"""A Python worker's memory does not grow with the rows of its task."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from caselake.functions.chunking import legal_chunks, legal_chunks_native
from caselake.operators.vectors import _TOKEN, HashingEncoder, tokens


def test_batches_are_bounded(spark):
    """a task's rows reach the worker in batches of at most 1,000."""
    import __spark_entry__ as entry

    entry._prepare(spark)

    @pandas_udf("int")
    def size(x: pd.Series) -> pd.Series:
        return pd.Series([len(x)] * len(x))

    assert spark.range(0, 5000, 1, 1).select(size("id").alias("n")).agg(F.max("n")).first()[0] <= 1000


def test_chunks_over_several_batches(spark):
    """a task of many batches gives every row its chunks."""
    text = F.concat(F.repeat(F.concat(F.lit("Word "), F.col("id").cast("string"), F.lit(". Next one.\n\n")), 200))
    docs = spark.range(0, 2500, 1, 1).select("id", F.when(F.col("id") % 7 > 0, text).alias("text"))
    both = docs.select("id", legal_chunks("text").alias("a"), F.coalesce(legal_chunks_native("text"), F.array().cast("array<string>")).alias("b"))
    assert both.count() == 2500 and not both.where("NOT (a <=> b)").count()


def test_slot_cache_is_bounded():
    """the cache of token hashes holds a bounded number, and vectors do not depend on it."""
    enc = HashingEncoder(16)
    texts = [" ".join(f"w{i}" for i in range(n, n + 50_000)) for n in range(0, 250_000, 50_000)]
    got = enc(texts)
    assert len(enc._slots) <= 100_000
    assert (got == [HashingEncoder(16)([t])[0] for t in texts]).all()


def test_tokens_of_any_script():
    """the fast patterns find what TOKEN_PATTERN says."""
    for text in ("U.S.C. § 14-20 it's x_y", "Müller’s İstanbul §§ ²½ ª", "中文-字 ٣٤ áb", "\U00010400b 𝟗-x é", "", "§"):
        assert tokens(text) == _TOKEN.findall(text.lower())
    assert tokens(None) == []


def test_shuffles_grow_with_the_input(spark, tmp_path):
    """a shuffle begins with a partition for each 8 MB of input, and with the usual number at least."""
    from caselake.session import size_shuffles

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        (tmp_path / "x").write_bytes(bytes(100 << 20))
        size_shuffles(spark, str(tmp_path))
        assert int(spark.conf.get(name)) == 13
        size_shuffles(spark, str(tmp_path / "none"))
        assert int(spark.conf.get(name)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_first_cluster_of_an_id(spark):
    """of a repeated cluster id the first row by docket, year and name stays; rows without an id are one."""
    from caselake.plans.lake_etl import clusters_stage

    rows = [("1", "d2", "2001-01-01", "b"), ("1", "d1", "2003-01-01", "z"), ("1", "d1", "2002-01-01", "y"), ("2", "d2", None, "c"),
            (None, "d2", "2001-01-01", "n"), (None, "d1", "2001-01-01", "m"), ("3", None, "2001-01-01", "k"), ("3", "d1", "2001-01-01", "k")]
    raw = spark.createDataFrame([(*r, None, None) for r in rows], "id string, docket_id string, date_filed string, case_name string, case_name_short string, case_name_full string")
    dockets = spark.createDataFrame([("d1", "A"), ("d2", "B")], "docket_id string, court_id string")
    cites = spark.createDataFrame([("1", "5", "U.S.", "7")], "cluster_id string, volume string, reporter string, page string")
    got = {(r["cluster_id"], r["case_name"], r["court"], r["year"], r["citation"]) for r in clusters_stage(raw, dockets, cites).collect()}
    assert got == {("1", "y", "A", 2002, "5 U.S. 7"), ("2", "c", "B", 0, ""), (None, "m", "A", 2001, "")}


def test_hybrid_search_needs_one_worker_a_task(spark, monkeypatch):
    """F8: documents are encoded where they are ranked, and keyword search starts no Python workers."""
    from pyspark.sql import SparkSession

    from caselake.operators.search import bm25_topk, hybrid_topk
    from caselake.operators.vectors import batch_encoder, embed, vector_topk

    queries = spark.createDataFrame([(1, "tax court"), (2, "appeal"), (3, "")], "query_id long, text string")
    docs = spark.createDataFrame(
        [(n, [f"Tax appeal {n}", "", None, "the court, the tax"][n % 4]) for n in range(2500)], "doc_id long, text string")
    plan = hybrid_topk(queries, docs, k=3, depth=5, dim=32)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("MapInPandas") == 1 and "ArrowEvalPython" not in plan
    qv = queries.select("query_id", embed("text", None, 32).alias("vector"))
    made = vector_topk(qv, docs.select(F.col("doc_id").alias("item_id"), embed("text", None, 32).alias("vector")), 2000)
    texts = docs.select(F.col("doc_id").alias("item_id"), "text")
    assert sorted(vector_topk(qv, texts, 2000, c_vec="text", encode=batch_encoder(None, 32)).collect()) == sorted(made.collect())

    def refuse(*_args, **_kw):
        raise AssertionError("rows from the driver's Python")

    monkeypatch.setattr(SparkSession, "createDataFrame", refuse)
    assert bm25_topk(queries, docs, 2).count() == 4

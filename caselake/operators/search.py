"""Keyword, hybrid and reranked retrieval (V3-V6). Keyword search is BM25 over the inverted
index of ``term_index``."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselake.operators.term_index import build_term_index, search_term_index, token_list
from caselake.operators.vectors import global_topk, tokens, vector_topk

RRF_K = 60


def bm25_topk(queries: DataFrame, docs: DataFrame, k: int = 10, q_id: str = "query_id",
              q_text: str = "text", d_id: str = "doc_id", d_text: str = "text") -> DataFrame:
    """V3: BM25 top-k documents per query -> (query_id, item_id, score, rank).

    Only documents sharing at least one term with the query are ranked. The documents are
    indexed under the batch's terms; a standing index (``build_term_index`` without terms) serves
    any number of batches.
    """
    if queries.isEmpty():  # no queries: nothing to rank, no pass over the corpus
        return docs.sparkSession.createDataFrame([], "query_id long, item_id long, score double, rank int")
    asked = queries.select(F.explode(token_list(F.col(q_text))).alias("term"))
    return search_term_index(build_term_index(docs, d_id, d_text, asked), queries, k, q_id, q_text)


def reciprocal_rank_fusion(*ranked: DataFrame, k: int = 10, rrf_k: int = RRF_K) -> DataFrame:
    """V4 fusion: score = sum over lists of 1 / (rrf_k + rank), top-k per query.

    Inputs are (query_id, item_id, rank) lists that are already top-n, so the
    union is bounded by n x lists per query.
    """
    parts = [r.select("query_id", "item_id", (F.lit(1.0) / (F.lit(rrf_k) + F.col("rank"))).alias("w"))
             for r in ranked]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    fused = u.groupBy("query_id", "item_id").agg(F.round(F.sum("w"), 6).alias("score"))
    # at most n x lists rows per query: one level of top-k suffices
    return global_topk(fused, k, ascending=False, partitions=1)


def hybrid_topk(queries: DataFrame, docs: DataFrame, k: int = 10, depth: int = 20, dim: int = 256,
                q_id: str = "query_id", q_text: str = "text", d_id: str = "doc_id",
                d_text: str = "text", encoder=None) -> DataFrame:
    """V4: BM25 top-``depth`` and cosine top-``depth`` fused by reciprocal rank. Documents are encoded
    where they are ranked, by one Python worker a task."""
    from caselake.operators.vectors import batch_encoder, embed

    qv = queries.select(F.col(q_id).alias("query_id"), embed(q_text, encoder, dim).alias("vector"))
    texts = docs.select(F.col(d_id).alias("item_id"), F.col(d_text).alias("text"))
    dense = vector_topk(qv, texts, depth, "cosine", c_vec="text", encode=batch_encoder(encoder, dim))
    sparse = bm25_topk(queries, docs, depth, q_id, q_text, d_id, d_text)
    return reciprocal_rank_fusion(dense, sparse, k=k)


def overlap_scorer(queries: pd.Series, texts: pd.Series) -> pd.Series:
    """Default V5 scorer: token-set F1 between query and candidate text."""
    out = []
    for q, t in zip(queries.tolist(), texts.tolist()):
        a, b = set(tokens(q)), set(tokens(t))
        inter = len(a & b)
        out.append(0.0 if inter == 0 else round(2.0 * inter / (len(a) + len(b)), 6))
    return pd.Series(out, dtype="float64")


def rerank(candidates: DataFrame, k: int = 5, scorer: Callable[[pd.Series, pd.Series], pd.Series] | None = None,
           q_text: str = "query_text", c_text: str = "text") -> DataFrame:
    """V5: rescore (query_id, item_id, query_text, text) candidates with a batched
    scorer (Arrow pandas UDF) and keep the top-k per query.

    Candidates come from a first-stage top-n, so they are bounded by the
    (checked) query batch times n; join them to the text table with the
    candidate side broadcast so the text is streamed, not shuffled.
    """
    from pyspark.sql.functions import pandas_udf

    fn = scorer or overlap_scorer

    @pandas_udf("double")
    def _score(q: pd.Series, t: pd.Series) -> pd.Series:
        return fn(q, t)

    scored = candidates.withColumn("rerank_score", _score(F.col(q_text), F.col(c_text)))
    w = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), F.col("item_id").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def filtered_topk(queries: DataFrame, corpus: DataFrame, condition, k: int = 10, metric: str = "cosine",
                  **kw) -> DataFrame:
    """V6 (+P13): metadata filter on the corpus first (pushed to the scan), then top-k."""
    return vector_topk(queries, corpus.where(condition), k, metric, **kw)


def metadata_filter(courts=None, start_year: int | None = None, end_year: int | None = None, statuses=None, opinion_types=None) -> Column:
    """The condition on an opinion's or chunk's metadata; what is not given is not asked for."""
    cond = F.lit(True)
    for name, values in (("court", courts), ("precedential_status", statuses), ("opinion_type", opinion_types)):
        if values is not None:
            cond = cond & F.col(name).isin(list(values))
    if start_year is not None:
        cond = cond & (F.col("year") >= start_year)
    if end_year is not None:
        cond = cond & (F.col("year") <= end_year)
    return cond

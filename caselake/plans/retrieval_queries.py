"""Registered retrieval queries: benchmark passages as the query batch, the
``embeddings`` table and hash-embedded ``documents`` as corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselake.operators.approx import CELL_ROWS, CODE_BITS, KEEP_FACTOR, MAX_CELL_BITS, PROBE, build_sign_index, search_sign_index
from caselake.operators.search import bm25_topk, filtered_topk, hybrid_topk, metadata_filter, rerank
from caselake.operators.vectors import hash_embed, vector_topk
from caselake.plans import sqlparts as Q
from caselake.plans.chunks import opinion_chunks, searchable_chunks
from caselake.plans.lake_etl import clusters_stage, opinions_stage
from caselake.plans.queries import SQL_FLAGSHIP, register, staged_dockets
from caselake.sources import standins as S
from caselake.sources.lake import materialize_stage

EMB_DIM = 64


def _bench_vectors(spark, d, dim=EMB_DIM):
    b = S.table(spark, d, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), hash_embed("text", dim).alias("vector"))


def _emb_corpus(spark, d):
    e = S.table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), "label")


SQL_QV = "WITH " + Q.hash_vectors("qv", "benchmark", "item_id", "text", EMB_DIM) + """,
    qn AS (SELECT id, sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) AS qsq FROM qv GROUP BY id),
    cn AS (SELECT vec_id, label, list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) AS csq
           FROM embeddings),
    dots AS (SELECT qv.id AS query_id, e.vec_id AS item_id,
                    sum(CAST(qv.v AS DOUBLE) * CAST(e.embedding[qv.b + 1] AS DOUBLE)) AS dot
             FROM qv CROSS JOIN embeddings e GROUP BY qv.id, e.vec_id),
    cos AS (SELECT d.query_id, d.item_id, cn.label,
                   round(CASE WHEN qn.qsq > 0 AND cn.csq > 0 THEN d.dot / (sqrt(qn.qsq) * sqrt(cn.csq)) ELSE 0 END, 6) AS score
            FROM dots d JOIN qn ON d.query_id = qn.id JOIN cn ON d.item_id = cn.vec_id),
    l2 AS (SELECT d.query_id, d.item_id,
                  round(sqrt(greatest(qn.qsq + cn.csq - 2 * d.dot, 0)), 6) AS score
           FROM dots d JOIN qn ON d.query_id = qn.id JOIN cn ON d.item_id = cn.vec_id),
    ip AS (SELECT query_id, item_id, round(dot, 6) AS score FROM dots)
"""


@register("hash_embed", "WITH " + Q.hash_vectors("hv", "documents", "doc_id", "text", EMB_DIM) + f""",
    ids AS (SELECT doc_id FROM documents),
    grid AS (SELECT ids.doc_id, g.b FROM ids CROSS JOIN range({EMB_DIM}) g(b))
    SELECT grid.doc_id, list(coalesce(hv.v, CAST(0 AS FLOAT)) ORDER BY grid.b) AS vector
    FROM grid LEFT JOIN hv ON grid.doc_id = hv.id AND grid.b = hv.b GROUP BY grid.doc_id""")
def q_hash_embed(spark, d):
    """Every document through the batched (hashing) encoder, 64 dims."""
    return S.text_table(spark, d, "documents", "doc_id").select("doc_id", hash_embed("text", EMB_DIM).alias("vector"))


@register("cosine_topk", SQL_QV + Q.topk("cos", 5))
def q_cosine_topk(spark, d):
    """V1: top-5 embeddings per benchmark passage by cosine similarity."""
    return vector_topk(_bench_vectors(spark, d), _emb_corpus(spark, d), k=5, metric="cosine")


@register("l2_topk", SQL_QV + Q.topk("l2", 5, ascending=True))
def q_l2_topk(spark, d):
    """V2: top-5 nearest embeddings per benchmark passage by L2 distance."""
    return vector_topk(_bench_vectors(spark, d), _emb_corpus(spark, d), k=5, metric="l2")


@register("ip_topk", SQL_QV + Q.topk("ip", 5))
def q_ip_topk(spark, d):
    """V2: top-5 embeddings per benchmark passage by inner product."""
    return vector_topk(_bench_vectors(spark, d), _emb_corpus(spark, d), k=5, metric="ip")


@register("filtered_topk", SQL_QV + Q.topk("(SELECT * FROM cos WHERE label = 1)", 5))
def q_filtered_topk(spark, d):
    """Cosine top-5 restricted to corpus rows with label 1."""
    return filtered_topk(_bench_vectors(spark, d), _emb_corpus(spark, d), F.col("label") == 1, k=5)


APPROX_K = 5
SQL_APPROX = SQL_QV + f""",
    planes AS (SELECT j.j, i.i,
                      CASE WHEN ('0x' || substr(md5('plane:17:' || CAST(j.j AS VARCHAR) || ':' || CAST(i.i AS VARCHAR)), 1, 2))::INTEGER % 2 = 0
                           THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS s
               FROM range({CODE_BITS}) j(j), range({EMB_DIM}) i(i)),
    size AS (SELECT count(*) AS n, greatest(0, least({MAX_CELL_BITS}, floor(log2(greatest(1, count(*) // {CELL_ROWS})))))::BIGINT AS bits FROM embeddings),
    eproj AS (SELECT e.vec_id, p.j, CASE WHEN sum(CAST(e.embedding[p.i + 1] AS DOUBLE) * p.s) >= 0 THEN 1 ELSE -1 END AS sgn
              FROM embeddings e CROSS JOIN planes p GROUP BY e.vec_id, p.j),
    qproj AS (SELECT q.id, p.j, sum(CAST(q.v AS DOUBLE) * p.s) AS m FROM qv q JOIN planes p ON q.b = p.i GROUP BY q.id, p.j),
    ecell AS (SELECT vec_id, coalesce(sum(CASE WHEN sgn > 0 AND j < bits THEN 1::BIGINT << j ELSE 0 END), 0)::BIGINT AS cell
              FROM eproj CROSS JOIN size GROUP BY vec_id),
    cells AS (SELECT c.cell, count(e.vec_id) AS rows
              FROM (SELECT unnest(range(1::BIGINT << bits)) AS cell FROM size) c LEFT JOIN ecell e ON c.cell = e.cell GROUP BY c.cell),
    rated_cells AS (SELECT q.id, c.cell, any_value(c.rows) AS rows,
                           coalesce(sum(CASE WHEN j < bits THEN q.m * (CASE WHEN (c.cell >> j::BIGINT) & 1 = 1 THEN 1 ELSE -1 END) END), 0) AS r
                    FROM qproj q CROSS JOIN cells c CROSS JOIN size GROUP BY q.id, c.cell),
    probed AS (SELECT id, cell FROM (
                   SELECT id, cell, sum(rows) OVER (PARTITION BY id ORDER BY r DESC, cell ROWS UNBOUNDED PRECEDING) - rows AS before FROM rated_cells)
               CROSS JOIN size WHERE before < {PROBE} * n),
    rated AS (SELECT q.id, e.vec_id, sum(q.m * e.sgn) AS r FROM qproj q JOIN eproj e USING (j) GROUP BY q.id, e.vec_id),
    cand AS (SELECT id AS query_id, vec_id AS item_id FROM (
                 SELECT r.id, r.vec_id, row_number() OVER (PARTITION BY r.id ORDER BY r.r DESC, r.vec_id) AS nth
                 FROM rated r JOIN ecell USING (vec_id) JOIN probed p ON p.id = r.id AND p.cell = ecell.cell)
             CROSS JOIN size WHERE nth <= ceil({KEEP_FACTOR * APPROX_K} * pow(n, 0.25))),
    approx AS (SELECT c.* FROM cos c JOIN cand USING (query_id, item_id))
"""


@register("approx_topk", SQL_APPROX + Q.topk("approx", APPROX_K))
def q_approx_topk(spark, d):
    """V7: cosine top-5 through the inverted file of sign codes."""
    index = build_sign_index(_emb_corpus(spark, d))
    return search_sign_index(index, _bench_vectors(spark, d), APPROX_K)


def _bench_queries(spark, d):
    return S.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@register("bm25_topk", "WITH " + Q.bm25_scores("bm", "benchmark", "item_id", "text", "documents", "doc_id", "text")
          + " " + Q.topk("bm", 10))
def q_bm25_topk(spark, d):
    """V3: BM25 top-10 documents per benchmark passage."""
    return bm25_topk(_bench_queries(spark, d), S.text_table(spark, d, "documents", "doc_id"), k=10)


def _hybrid_ctes(depth):
    return "WITH " + Q.bm25_scores("bm", "benchmark", "item_id", "text", "documents", "doc_id", "text") + "," \
        + Q.hash_vectors("qh", "benchmark", "item_id", "text", 256) + "," \
        + Q.hash_vectors("dh", "documents", "doc_id", "text", 256) + """,
    qhn AS (SELECT id, sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) AS sq FROM qh GROUP BY id),
    dhn AS (SELECT id, sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) AS sq FROM dh GROUP BY id),
    hdot AS (SELECT qh.id AS query_id, dh.id AS item_id, sum(CAST(qh.v AS DOUBLE) * CAST(dh.v AS DOUBLE)) AS dot
             FROM qh JOIN dh ON qh.b = dh.b GROUP BY qh.id, dh.id),
    allpairs AS (SELECT q.id AS query_id, d.doc_id AS item_id FROM (SELECT DISTINCT id FROM qh) q CROSS JOIN documents d),
    dense AS (SELECT a.query_id, a.item_id,
                     round(CASE WHEN qhn.sq > 0 AND dhn.sq > 0
                                THEN coalesce(h.dot, 0) / (sqrt(qhn.sq) * sqrt(dhn.sq)) ELSE 0 END, 6) AS score
              FROM allpairs a JOIN qhn ON a.query_id = qhn.id LEFT JOIN dhn ON a.item_id = dhn.id
                   LEFT JOIN hdot h ON a.query_id = h.query_id AND a.item_id = h.item_id),
    dr AS (""" + Q.topk("dense", depth) + """),
    sr AS (""" + Q.topk("bm", depth) + """),
    fused AS (SELECT query_id, item_id, round(sum(1.0 / (60 + rank)), 6) AS score
              FROM (SELECT * FROM dr UNION ALL SELECT * FROM sr) GROUP BY query_id, item_id)
    """


@register("hybrid_topk", _hybrid_ctes(20) + Q.topk("fused", 10))
def q_hybrid_topk(spark, d):
    """V4: BM25 top-20 and cosine top-20 (256-dim hash vectors) fused by reciprocal rank, top-10."""
    return hybrid_topk(_bench_queries(spark, d), S.text_table(spark, d, "documents", "doc_id"), k=10, depth=20, dim=256)


@register("rerank", _hybrid_ctes(50) + ", top AS (" + Q.topk("fused", 50) + """),
    cand AS (SELECT t.query_id, t.item_id, t.score,
                    list_distinct(regexp_extract_all(lower(b.text), '""" + Q.TOKEN_SQL + """')) AS qa,
                    list_distinct(regexp_extract_all(lower(d.text), '""" + Q.TOKEN_SQL + """')) AS da
             FROM top t JOIN benchmark b ON t.query_id = b.item_id JOIN documents d ON t.item_id = d.doc_id),
    rs AS (SELECT query_id, item_id, score,
                  CASE WHEN len(list_intersect(qa, da)) = 0 THEN 0.0
                       ELSE round_even(2.0 * len(list_intersect(qa, da)) / (len(qa) + len(da)), 6) END AS rerank_score
           FROM cand)
    SELECT query_id, item_id, score, rerank_score, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, item_id) AS INTEGER) AS rank
        FROM rs) WHERE rank <= 5""")
def q_rerank(spark, d):
    """V5: hybrid top-50 rescored by a batched scorer (token-set F1), top-5 per passage."""
    docs = S.text_table(spark, d, "documents", "doc_id")
    top = hybrid_topk(_bench_queries(spark, d), docs, k=50, depth=50, dim=256).drop("rank")
    top = top.join(_bench_queries(spark, d).withColumnRenamed("text", "query_text"), "query_id")
    cands = docs.select(F.col("doc_id").alias("item_id"), "text").join(top, "item_id")
    return rerank(cands, k=5).select("query_id", "item_id", "score", "rerank_score", "rank")


# V6 as designed: metadata-filtered semantic search over the opinion chunks,
# returning the chunk text with its opinion's raw id.
CHUNK_DIM = 128
CHUNK_COURTS = ("BUILDING", "MACHINERY")
CHUNK_MIN_YEAR = 1998
CHUNK_STATUSES = ("Published", "Errata")
CHUNK_TYPES = ("en", "fr", "Lead")


@register("chunk_search", "WITH fl AS (" + SQL_FLAGSHIP + ")," + S.SQL_STATUS + f""",
    ch AS (SELECT *, row_number() OVER (ORDER BY opinion_key, chunk_index) AS key FROM (
               SELECT CASE WHEN opinion_id % 2 = 1 THEN 'x' ELSE '' END || opinion_id AS opinion_key, chunk_index, text
               FROM fl JOIN st ON fl.cluster_id = st.cluster_id
               WHERE court IN {CHUNK_COURTS} AND year >= {CHUNK_MIN_YEAR} AND precedential_status IN {CHUNK_STATUSES}
                     AND opinion_type IN {CHUNK_TYPES})),
    """ + Q.hash_vectors("qh", "benchmark", "item_id", "text", CHUNK_DIM) + "," \
    + Q.hash_vectors("chh", "ch", "key", "text", CHUNK_DIM) + """,
    qn AS (SELECT id, sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) AS sq FROM qh GROUP BY id),
    cn AS (SELECT id, sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) AS sq FROM chh GROUP BY id),
    dots AS (SELECT qh.id AS query_id, chh.id AS item_id, sum(CAST(qh.v AS DOUBLE) * CAST(chh.v AS DOUBLE)) AS dot
             FROM qh JOIN chh ON qh.b = chh.b GROUP BY qh.id, chh.id),
    pairs AS (SELECT q.id AS query_id, c.key AS item_id FROM (SELECT DISTINCT id FROM qh) q CROSS JOIN ch c),
    sc AS (SELECT p.query_id, p.item_id,
                  round(CASE WHEN qn.sq > 0 AND cn.sq > 0 THEN coalesce(d.dot, 0) / (sqrt(qn.sq) * sqrt(cn.sq)) ELSE 0 END, 6) AS score
           FROM pairs p JOIN qn ON p.query_id = qn.id LEFT JOIN cn ON p.item_id = cn.id
                LEFT JOIN dots d ON p.query_id = d.query_id AND p.item_id = d.item_id),
    top AS (""" + Q.topk("sc", 5) + """)
    SELECT top.query_id, ch.opinion_key, ch.chunk_index, top.score, top.rank, ch.text
    FROM top JOIN ch ON top.item_id = ch.key""")
def q_chunk_search(spark, d):
    """Top-5 opinion chunks per benchmark passage among two courts from 1998 on, of some
    statuses and opinion types, with the chunk text and the raw opinion id, half of which are no
    numbers (chunks hash-embedded, 128 dims)."""
    clusters = materialize_stage(
        spark, "clusters-status", [f"{d}/{t}.parquet" for t in ("customer", "orders", "lineitem")],
        lambda: clusters_stage(S.clusters_raw_with_status(spark, d), staged_dockets(spark, d), S.citations_raw(spark, d)))
    raw = S.opinions_raw(spark, d)
    named = raw.withColumn("id", F.when(F.col("id").cast("bigint") % 2 == 1, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    opinions = opinions_stage(named, clusters).withColumn("opinion_key", F.col("opinion_id"))
    cond = metadata_filter(CHUNK_COURTS, CHUNK_MIN_YEAR, None, CHUNK_STATUSES, CHUNK_TYPES)
    chunks = searchable_chunks(opinion_chunks(opinions.where(cond)), CHUNK_DIM)
    top = vector_topk(_bench_vectors(spark, d, CHUNK_DIM), chunks.select("item_id", "vector"), k=5)
    return chunks.select("item_id", "opinion_key", "chunk_index", "text").join(top, "item_id").select(
        "query_id", "opinion_key", "chunk_index", "score", "rank", "text")

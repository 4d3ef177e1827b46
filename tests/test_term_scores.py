"""Keyword scoring asks once of each posting whether its document is wanted."""

from pyspark.sql import functions as F

from caselake.operators import term_index as T


def test_wanted_documents_are_bits_of_their_block(spark):
    """F2: documents at both ends of both halves of a block are scored, no other, and no posting is compared with a list."""
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("alpha beta w"), F.col("id").cast("string")).alias("text"))
    index = T.build_term_index(docs)
    ids = [0, 62, 63, 64, 126, 127, 128, 191, 192, 299]
    rows = spark.createDataFrame([(q, i // T.BLOCK_ROWS, i) for q in (1, 2) for i in ids[q - 1:]], "query_id bigint, block bigint, row bigint")
    terms = spark.createDataFrame([(1, "alpha", 2.0), (1, "w63", 1.0), (2, "beta", 3.0), (2, "w0", 1.0)], "query_id bigint, term string, idf double")
    scored = T._scores(index, rows, terms)
    weight = 2.2 / 2.2  # all documents have three tokens
    got = {(r["query_id"], r["row"]): round(r["score"], 9) for r in scored.collect()}
    assert got == {**{(1, i): round(weight * (3.0 if i == 63 else 2.0), 9) for i in ids}, **{(2, i): 3.0 * weight for i in ids[1:]}}
    assert "array_contains" not in scored._jdf.queryExecution().optimizedPlan().toString()

"""V3: BM25 over a block-wise inverted index, in SQL expressions only.

Tokens are runs of letters, marks and digits of any script, with inner points, hyphens and
apostrophes (``u.s.c``, ``14-20``), and section signs. The index has a row for each term and block of
BLOCK_ROWS consecutive documents: the postings, and the largest weight among them. So a term in a
third of all documents is many rows, never one, and its postings are read only where needed.

A search first scores, for each query, the most promising blocks of its rarest terms; the k-th best
score found is a threshold. The query's common terms, as many as together weigh less than the
threshold, cannot carry a document by themselves: only blocks that hold another of its terms
are looked at, and of those only the ones whose largest weights, with all the common terms on top,
reach the threshold. Then the same is asked of each document there, and what remains is scored
with all terms. Scores are exact.

BM25 parameters are ours: k1 = 1.2, b = 0.75, idf = ln(1 + (N - df + 0.5) / (df + 0.5)), distinct
query terms, scores to 6 decimals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.session import scratch_path

# The same in Java's, RE2's and Python's ``regex`` syntax.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}]+(?:[.'’-][\p{L}\p{M}\p{N}]+)*|§+"
BM25_K1 = 1.2
BM25_B = 0.75
BLOCK_ROWS = 128
SEED_BLOCKS = 16          # blocks of a query that are scored for its threshold
VOCABULARY_BROADCAST = 1_000_000
_ROUNDING = 2e-6          # scores are rounded, and sums of doubles depend on their order
_ENTRY = "struct<row:bigint,doc_id:bigint,dl:bigint,tf:bigint>"


def token_list(text: Column) -> Column:
    """The tokens of a text, lower-cased, repeats included; none for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


@dataclass
class TermIndex:
    """``blocks`` (term, block, n, best, entries); documents in all and their mean length."""
    blocks: DataFrame
    documents: int
    mean_length: float


def _weight(tf: Column, dl: Column, mean_length: float) -> Column:
    norm = 1 - BM25_B + BM25_B * dl / F.lit(mean_length) if mean_length > 0 else F.lit(1.0)
    return tf * (BM25_K1 + 1) / (tf + BM25_K1 * norm)


def build_term_index(docs: DataFrame, d_id: str = "doc_id", d_text: str = "text", terms: DataFrame | None = None,
                     path: str | None = None) -> TermIndex:
    """Index every document under every term, or under the given ``terms`` only (one column ``term``).

    Written once: tokens are made and counted in one pass, partly before the shuffle, and the
    statistics are aggregates over what it wrote."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "term-index")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(d_id).cast("bigint").alias("doc_id"), token_list(F.col(d_text)).alias("tokens"))
    # The empty term stands for the document itself, so that those without any term are counted too.
    each = rows.select("row", "doc_id", F.size("tokens").cast("bigint").alias("dl"), F.explode(F.concat("tokens", F.array(F.lit("")))).alias("term"))
    if terms is not None:
        wanted = terms.select("term").union(spark.range(1).select(F.lit("").alias("term"))).distinct()
        if wanted.count() <= VOCABULARY_BROADCAST:
            wanted = F.broadcast(wanted)
        each = each.join(wanted, "term", "left_semi")
    each.groupBy("row", "doc_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf")).write.parquet(f"{path}/postings")
    postings = spark.read.schema("row bigint, doc_id bigint, dl bigint, term string, tf bigint").parquet(f"{path}/postings")
    total = postings.where("term = ''").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("mean")).first()
    mean_length = float(total["mean"] or 0.0)
    block = F.floor(F.col("row") / BLOCK_ROWS).cast("bigint").alias("block")
    grouped = postings.where("term <> ''").groupBy("term", block).agg(
        F.count(F.lit(1)).alias("n"), F.max(_weight(F.col("tf"), F.col("dl"), mean_length)).alias("best"),
        F.collect_list(F.struct("row", "doc_id", "dl", "tf")).alias("entries"))
    grouped.sortWithinPartitions("term", "block").write.parquet(f"{path}/blocks")
    blocks = spark.read.schema(f"term string, block bigint, n bigint, best double, entries array<{_ENTRY}>").parquet(f"{path}/blocks")
    return TermIndex(blocks, total["n"], mean_length)


def _query_terms(index: TermIndex, queries: DataFrame, q_id: str, q_text: str) -> DataFrame:
    """(query_id, term, idf, top): the known terms of each query; ``top`` bounds what the term can add."""
    asked = queries.select(F.col(q_id).cast("bigint").alias("query_id"), F.explode(F.array_distinct(token_list(F.col(q_text)))).alias("term")).distinct()
    known = index.blocks.groupBy("term").agg(F.sum("n").alias("df"), F.max("best").alias("best"))
    idf = F.log(1 + (F.lit(index.documents) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return asked.join(known, "term").select("query_id", "term", "df", idf.alias("idf"), (idf * F.col("best")).alias("top"))


def _scores(index: TermIndex, rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, row, item_id, score) of the documents ``rows`` (query_id, block, row), by the given terms
    (query_id, term, idf). A block's postings are read once for all its documents, which are a bit each."""
    bit, half = F.expr("shiftleft(1L, CAST(row % 64 AS INT))"), F.expr(f"CAST(row % {BLOCK_ROWS} / 64 AS INT)")
    halves = [f"half{i}" for i in range(-(-BLOCK_ROWS // 64))]
    wanted = rows.groupBy("query_id", "block").agg(*[F.bit_or(F.when(half == i, bit).otherwise(0)).alias(name) for i, name in enumerate(halves)])
    met = wanted.join(terms.select("query_id", "term", "idf"), "query_id").join(index.blocks.select("term", "block", "entries"), ["term", "block"])
    own = F.array(*halves)[F.expr(f"CAST(e.row % {BLOCK_ROWS} / 64 AS INT)")]
    hits = met.select("query_id", "idf", *halves, F.explode("entries").alias("e")).where(
        own.bitwiseAND(F.expr("shiftleft(1L, CAST(e.row % 64 AS INT))")) != 0)
    weight = F.col("idf") * _weight(F.col("e.tf"), F.col("e.dl"), index.mean_length)
    return hits.groupBy("query_id", F.col("e.row").alias("row"), F.col("e.doc_id").alias("item_id")).agg(F.sum(weight).alias("score"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("item_id"), F.col("row"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _thresholds(index: TermIndex, terms: DataFrame, k: int) -> DataFrame:
    """(query_id, least): a score that k documents reach; 0 where fewer were seen."""
    rarest = Window.partitionBy("query_id").orderBy("df", "term")
    before = F.sum("df").over(rarest.rowsBetween(Window.unboundedPreceding, -1))
    rare = terms.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < 4 * k)
    heads = rare.join(index.blocks.select("term", "block", "best"), "term")
    order = Window.partitionBy("query_id").orderBy(F.desc(F.col("idf") * F.col("best")), "term", "block")
    seeds = heads.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= max(SEED_BLOCKS, 2 * k))
    found = seeds.join(index.blocks.select("term", "block", "entries"), ["term", "block"]).select(
        "query_id", "block", F.explode("entries.row").alias("row")).distinct()
    top = _best(_scores(index, found, terms), k)
    return top.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(0.0).alias("least"))


def search_term_index(index: TermIndex, queries: DataFrame, k: int = 10, q_id: str = "query_id", q_text: str = "text") -> DataFrame:
    """(query_id, item_id, score, rank): the k best documents of each query that share a term with it; equal
    scores by id. Queries of one id are one. Nothing is collected, and no side is broadcast by hint."""
    spark = queries.sparkSession
    path = scratch_path(spark, "term-search")
    _query_terms(index, queries, q_id, q_text).write.parquet(f"{path}/terms")
    terms = spark.read.schema("query_id bigint, term string, df bigint, idf double, top double").parquet(f"{path}/terms")
    lightest = Window.partitionBy("query_id").orderBy("top", "term").rowsBetween(Window.unboundedPreceding, 0)
    marked = terms.join(_thresholds(index, terms, k), "query_id").withColumn("least", F.col("least") - _ROUNDING)
    # Common terms: the lightest that together stay under the threshold.
    marked = marked.withColumn("common", F.sum("top").over(lightest) < F.col("least"))
    marked.write.parquet(f"{path}/marked")
    marked = spark.read.schema("query_id bigint, term string, df bigint, idf double, top double, least double, common boolean").parquet(f"{path}/marked")
    light = marked.groupBy("query_id").agg(
        F.max("least").alias("least"), F.coalesce(F.sum(F.when(F.col("common"), F.col("top"))), F.lit(0.0)).alias("rest"))
    own = marked.where("NOT common").select("query_id", "term", "idf")
    promising = own.join(index.blocks.select("term", "block", "best"), "term").groupBy("query_id", "block").agg(
        F.sum(F.col("idf") * F.col("best")).alias("bound")).join(light, "query_id").where("bound + rest >= least")
    entries = promising.select("query_id", "block").join(own, "query_id").join(index.blocks.select("term", "block", "entries"), ["term", "block"])
    weight = F.col("idf") * _weight(F.col("e.tf"), F.col("e.dl"), index.mean_length)
    seen = entries.select("query_id", "block", "idf", F.explode("entries").alias("e")).groupBy(
        "query_id", "block", F.col("e.row").alias("row")).agg(F.sum(weight).alias("seen"))
    rows = seen.join(light, "query_id").where("seen + rest >= least").select("query_id", "block", "row")
    rows.write.parquet(f"{path}/rows")
    rows = spark.read.schema("query_id bigint, block bigint, row bigint").parquet(f"{path}/rows")
    scored = _scores(index, rows, terms).withColumn("score", F.round("score", 6))
    return _best(scored, k).select("query_id", "item_id", "score", "rank")

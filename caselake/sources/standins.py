"""Reference-shaped raw tables derived from the driver's test tables.

The real inputs (docket, cluster, citation and opinion snapshots, statute
JSONL) are not available here, so each is derived from a test table with the
same shape: all-string ids, a court column, dates, names, text and HTML. Each
Spark definition has a DuckDB twin in ``STANDIN_SQL`` (same values, row for
row) used by the oracle queries.

Value rules that exercise edge paths are computed from the row itself (e.g.
blank plain text on every third document) — they transform values and never
drop rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-in court set: four of the five market segments (HOUSEHOLD is outside).
STANDIN_COURTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver test table (read-only, so its schema is inferred once)."""
    from caselake.sources.lake import read_immutable_parquet

    return read_immutable_parquet(spark, os.path.join(sf_dir, f"{name}.parquet"))


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A text-heavy test table, spread over the cluster when its scan has too few
    splits (the driver's tables are single files with one row group), so the
    per-row text work that follows without a shuffle uses every core. Other
    tables are read as they are: their first shuffle spreads them anyway, and
    measured, an extra spread costs more than it gains."""
    from caselake.operators.joins import spread

    return spread(table(spark, sf_dir, name), key)


def dockets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dockets(id, court_id) <- customer(c_custkey, c_mktsegment)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("court_id"))


def clusters_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """opinion-clusters <- orders: id, docket_id, date_filed, three name fields."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("docket_id"),
        F.when(key % 11 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_filed"),
        F.when(key % 5 == 0, F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("case_name"),
        F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" "), F.col("o_orderstatus"))).alias("case_name_short"),
        F.lit(None).cast("string").alias("case_name_full"),
    )


def clusters_raw_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clusters_raw with a precedential status, blank on every fourth (SQL_STATUS)."""
    key = F.col("id").cast("bigint") % 4
    status = F.when(key == 0, "Published").when(key == 1, "Unpublished").when(key == 2, "Errata")
    return clusters_raw(spark, sf_dir).withColumn("precedential_status", status)


SQL_STATUS = """
    st AS (SELECT o_orderkey AS cluster_id,
                  CASE o_orderkey % 4 WHEN 0 THEN 'Published' WHEN 1 THEN 'Unpublished' WHEN 2 THEN 'Errata' ELSE '' END AS precedential_status
           FROM orders)"""


def citations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """citations(cluster_id, volume, reporter, page) <- lineitem; flag 'N' gives a blank reporter."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("cluster_id"),
        F.col("l_quantity").cast("int").cast("string").alias("volume"),
        F.when(F.col("l_returnflag") == "A", F.lit("S.C."))
        .when(F.col("l_returnflag") == "R", F.lit("S.E.2d"))
        .otherwise(F.lit(" ")).alias("reporter"),
        F.col("l_linenumber").cast("string").alias("page"),
    )


def court_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """court ids <- the dockets' courts, 'ca' + nation key, and regions as real courts (SQL_COURT_IDS)."""
    dockets = dockets_raw(spark, sf_dir).select("court_id").where(F.col("court_id").isNotNull())
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("ca"), F.col("n_nationkey").cast("string")).alias("court_id"))
    key = F.col("r_regionkey")
    court = F.when(key == 0, "sc").when(key == 1, "scctapp").when(key == 2, "scotus").otherwise(F.lower("r_name"))
    return dockets.union(nations).union(table(spark, sf_dir, "region").select(court.alias("court_id"))).distinct()


def court_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, group) <- nations but those of region 4, grouped by region (SQL_COURT_NAMES)."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).where("r_regionkey <> 4").select(
        F.concat(F.lit("ca"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("group"))


SQL_COURT_IDS = """
    court_ids AS (SELECT court_id AS id FROM dockets_raw WHERE court_id IS NOT NULL
                  UNION SELECT 'ca' || CAST(n_nationkey AS VARCHAR) FROM nation
                  UNION SELECT CASE r_regionkey WHEN 0 THEN 'sc' WHEN 1 THEN 'scctapp' WHEN 2 THEN 'scotus'
                                                ELSE lower(r_name) END FROM region)"""
SQL_COURT_NAMES = """
    court_names AS (SELECT 'ca' || CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, r_name AS "group"
                    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 4)"""


def opinions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """opinions <- documents ⟕ pages (page_id = doc_id): plain text blank on every third doc."""
    d = text_table(spark, sf_dir, "documents", "doc_id")
    p = table(spark, sf_dir, "pages").select(F.col("page_id"), F.col("html"))
    j = d.join(p, d["doc_id"] == p["page_id"], "left")
    return j.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").cast("string").alias("cluster_id"),
        F.when(F.col("lang") == "de", F.lit(None).cast("string")).otherwise(F.col("lang")).alias("type"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("text")).alias("plain_text"),
        F.col("html").alias("html_with_citations"),
    )


def statute_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """statute records <- conversations: one title file per role; system turns are repealed."""
    cv = table(spark, sf_dir, "conversations")
    doc = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return cv.select(
        F.concat(F.lit("sc_title_"), F.col("role"), F.lit(".jsonl")).alias("file"),
        doc.alias("doc_id"),
        doc.alias("section_id"),
        F.col("conv_id").cast("string").alias("title_num"),
        F.col("role").alias("title_name"),
        F.col("turn").cast("string").alias("chapter_num"),
        F.lit(None).cast("string").alias("short_title"),
        F.col("text").alias("body_text"),
        F.lit(None).cast("string").alias("text"),
        F.when(F.col("role") == "system", F.lit("repealed")).alias("status"),
        F.col("turn").cast("string").alias("chunk_index"),
        F.lit(None).cast("string").alias("chunk_total"),
        F.concat(F.lit("https://law.example/"), doc).alias("url"),
    )


def statute_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statute records rendered as JSONL lines (file, value), as a title file holds them."""
    rec = statute_records(spark, sf_dir)
    fields = [c for c in rec.columns if c != "file"]
    return rec.select("file", F.to_json(F.struct(*fields)).alias("value"))


# DuckDB twins of the definitions above (views over the pre-registered tables).
STANDIN_SQL = {
    "dockets_raw": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS court_id FROM customer""",
    "clusters_raw": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CAST(o_custkey AS VARCHAR) AS docket_id,
               CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_filed,
               CASE WHEN o_orderkey % 5 = 0 THEN '  ' ELSE o_orderpriority END AS case_name,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE ' ' || o_orderstatus END AS case_name_short,
               CAST(NULL AS VARCHAR) AS case_name_full
        FROM orders""",
    "citations_raw": """
        SELECT CAST(l_orderkey AS VARCHAR) AS cluster_id,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS volume,
               CASE l_returnflag WHEN 'A' THEN 'S.C.' WHEN 'R' THEN 'S.E.2d' ELSE ' ' END AS reporter,
               CAST(l_linenumber AS VARCHAR) AS page
        FROM lineitem""",
    "opinions_raw": """
        SELECT CAST(d.doc_id AS VARCHAR) AS id,
               CAST(d.doc_id AS VARCHAR) AS cluster_id,
               CASE WHEN d.lang = 'de' THEN NULL ELSE d.lang END AS type,
               CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE d.text END AS plain_text,
               p.html AS html_with_citations
        FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id""",
    "statute_records": """
        SELECT 'sc_title_' || role || '.jsonl' AS file,
               CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS doc_id,
               CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS section_id,
               CAST(conv_id AS VARCHAR) AS title_num,
               role AS title_name,
               CAST(turn AS VARCHAR) AS chapter_num,
               CAST(NULL AS VARCHAR) AS short_title,
               text AS body_text,
               CAST(NULL AS VARCHAR) AS text,
               CASE WHEN role = 'system' THEN 'repealed' END AS status,
               CAST(turn AS VARCHAR) AS chunk_index,
               CAST(NULL AS VARCHAR) AS chunk_total,
               'https://law.example/' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS url
        FROM conversations""",
}


def standin_ctes(*names: str) -> str:
    """'WITH a AS (...), b AS (...)' prefix for oracle SQL."""
    return "WITH " + ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in names)

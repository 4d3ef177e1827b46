"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.chat import conversation_nodes, format_conversations, masked_text, read_turns
from caselake.llm.common import prepare, stage, table
from caselake.llm.decontaminate import benchmark_matches
from caselake.llm.jaccard_join import jaccard_components
from caselake.llm.langid import html_language, html_words, identify_languages, train_text_model
from caselake.llm.licenses import scan_licences, train_licence_model
from caselake.llm.packing import pack_documents
from caselake.llm.periodic_runs import collapse_runs, run_text, strongest_run
from caselake.llm.ranked_search import ranked_search
from caselake.llm.secret_scan import scan_report
from caselake.llm.sharding import assign_shards
from caselake.llm.simhash_dedup import near_duplicates
from caselake.llm.token_files import read_token_files, token_digests, write_token_files
from caselake.llm.winnowing import fingerprint_neighbours, fingerprint_text, likeness
from caselake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
WORD_TOKENIZER = "word_bpe_49k.json"


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return deco


@register("op1_language_id")
def op1_language_id(spark, d):
    """Every row of ``documents`` (declared language and source as markup and address evidence) and of
    ``pages`` (language of the markup, URL); doc_id or page_id is null for the other table."""
    docs = table(spark, d, "documents")
    rows = docs.select(
        "doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", F.col("lang").alias("declared"), F.col("source").alias("address"),
    ).unionByName(table(spark, d, "pages").select(
        F.lit(None).cast("bigint").alias("doc_id"), "page_id", html_words(F.col("html")).alias("text"),
        html_language(F.col("html")).alias("declared"), F.col("url").alias("address")))
    return identify_languages(
        rows, train_text_model(docs), ("doc_id", "page_id"), declared=F.col("declared"), address=F.col("address"))


@register("op2_secret_scan")
def op2_secret_scan(spark, d):
    """Spans of strong and linked secrets in every document."""
    return scan_report(table(spark, d, "documents"))


@register("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark, d):
    """Every benchmark item that a document holds."""
    return benchmark_matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register("op4_token_files")
def op4_token_files(spark, d):
    """Token-id files written and read back."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, d, "documents"), path, public_tokenizers.path(WORD_TOKENIZER), end_id=2)
    return token_digests(read_token_files(spark, path))


@register("op5_license_scan")
def op5_license_scan(spark, d):
    """Licence family of every paragraph of ``documents`` that may match a licence template."""
    docs = table(spark, d, "documents")
    return scan_licences(docs, train_licence_model(docs))


@register("op6_winnowing")
def op6_winnowing(spark, d):
    """Fingerprints of every document and of its edited text, and their likeness."""
    rows = fingerprint_neighbours(table(spark, d, "documents"))
    return rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("prints")).alias("fingerprint"), fingerprint_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).alias("near_next"))


@register("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark, d):
    """Fingerprint and near-duplicate class of every document."""
    return near_duplicates(table(spark, d, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op8_sharding")
def op8_sharding(spark, d):
    """Every document in one of 24 shards of near-equal bytes."""
    return assign_shards(table(spark, d, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark, d):
    """All documents packed into sequences of 4096 tokens."""
    return pack_documents(table(spark, d, "documents"), public_tokenizers.path(WORD_TOKENIZER), end_id=1)


@register("op10_chat_formatting")
def op10_chat_formatting(spark, d):
    """Every conversation formatted, written and read back."""
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text"))
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    nodes = stage(conversation_nodes(turns), "chat-nodes")
    back = stage(format_conversations(nodes), "chat-formatted")
    read = back.withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", masked_text(F.col("formatted"), F.col("mask")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SEARCH_SQL = rf"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all({LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM doc_terms GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM lengths),
tfs AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM doc_terms WHERE t IN (SELECT t FROM item_terms) GROUP BY doc_id, t),
dfs AS (SELECT t, count(*)::BIGINT AS df FROM tfs GROUP BY t),
impacts AS (
    SELECT doc_id, t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // len))) AS impact
    FROM tfs JOIN dfs USING (t) JOIN lengths USING (doc_id) CROSS JOIN totals),
scores AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM item_terms JOIN impacts USING (t) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS "rank", doc_id, score
FROM scores WHERE score > 0 QUALIFY "rank" <= 50
"""


@register("op11_ranked_search", SEARCH_SQL)
def op11_ranked_search(spark, d):
    """The 50 best documents for each benchmark item."""
    return ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def repeated_text(text, doc_id):
    """The words of a text, from the word a on those of its first p words after a again and again, for
    a tenth of the ids: h = crc32(doc_id), g = h div 10, a = g mod n, p = 1 + (n - a) div (3 + g mod 8)
    where h mod 10 = 0. Other texts, and those of rows without an id, as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1)

    def again(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.element_at(w, (a + i % p + 1).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", F.slice(w, 1, a), tail)).otherwise("")

    # The words are found once: a list of one is transformed, not an expression repeated.
    made = F.element_at(F.transform(F.array(words), again), 1)
    return F.when(h % 10 == 0, made).otherwise(text)


@register("op12_periodic_runs")
def op12_periodic_runs(spark, d):
    """Every periodic run of the words of every document, a tenth of which are made to repeat."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    found = collapse_runs(docs.withColumn("text", repeated_text(F.col("text"), F.col("doc_id"))), with_text=False)
    found = found.withColumn("best", strongest_run(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length / best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(run_text(F.col("runs")), 256).alias("runs_sha256"), "collapsed_sha256")


JOIN_SQL = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS t FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(t) = 0 THEN []::VARCHAR[] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
                ELSE list_distinct(list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' '))) END AS s FROM words),
each AS (SELECT doc_id, unnest(s) AS g FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM met JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * same >= 80 * (len(x.s) + len(y.s) - same)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b AS a, a AS b FROM links),
reach AS (SELECT doc_id AS node, doc_id AS low FROM sets UNION SELECT ways.b AS node, reach.low FROM reach JOIN ways ON ways.a = reach.node WHERE reach.low < ways.b)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.low) AS component_id FROM sets s JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, s.s
"""


@register("op13_jaccard_join", JOIN_SQL)
def op13_jaccard_join(spark, d):
    """Class of every document under links of five-word shingle sets of similarity 0.8 or more."""
    return jaccard_components(table(spark, d, "documents"))


@register("pipeline")
def pipeline(spark, d):
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)

"""Stages of the corpus pipeline: documents in, the documents that a stage keeps out."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import prepare, stage, table
from caselake.llm.decontaminate import benchmark_matches
from caselake.llm.langid import identify_languages, train_text_model
from caselake.llm.packing import pack_documents
from caselake.llm.secret_scan import scan_secrets
from caselake.llm.simhash_dedup import near_duplicates

TOKENIZER = "word_bpe_49k.json"
PACK_END_ID = 1


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a row number and the number's name: ids may be null or shared, so stages decide by
    row. The name is one that no column of ``docs`` has (case ignored).

    Rows read straight from Parquet are numbered by file and place in it, so no text is copied;
    other rows are numbered as they come and written once."""
    row, taken = "row", {c.lower() for c in docs.columns}
    while row in taken:
        row += "_"
    try:
        if "_metadata" in taken:
            raise AnalysisException("a column hides the file's own")
        placed = docs.select("*", F.col("_metadata.file_path").alias(f"{row}_file"), F.col("_metadata.row_index").alias(f"{row}_index"))
    except AnalysisException:
        return stage(docs.withColumn(row, F.monotonically_increasing_id()), "pipe-rows"), row
    paths = sorted(r[0] for r in placed.select(f"{row}_file").distinct().collect())  # a row per file, as in Spark's own listing
    files = docs.sparkSession.createDataFrame(list(enumerate(paths)), f"{row}_number bigint, {row}_file string")
    number = F.shiftleft(F.col(f"{row}_number"), 40) + F.col(f"{row}_index")
    return placed.join(F.broadcast(files), f"{row}_file").select(*[docs[c] for c in docs.columns], number.alias(row)), row


def _without(rows: DataFrame, row: str, listed: DataFrame) -> DataFrame:
    """The numbered rows that are not listed (``listed.row``), as documents."""
    gone = listed.select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; see ``identify_languages`` for what is rejected.
    The text model learns from the labelled rows of the stage's own input. Rows are judged one by
    one, those without an id too; a null or empty text is judged by its other evidence. An empty
    table gives an empty one. All columns are returned, whatever their names."""
    prepare(spark)
    rows, row = _numbered(docs)
    found = identify_languages(rows, train_text_model(rows), (row,), declared=F.col("lang"), address=F.col("source"))
    return _without(rows, row, stage(found.where("NOT accepted").select(F.col(row).alias("row")), "pipe-rejected"))


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class of the SimHash operator (three-word shingles, at most
    three differing bits): that of the smallest id; any one where all ids are null. Null and empty
    texts are one class. An empty table gives an empty one. All columns are returned."""
    prepare(spark)
    rows, row = _numbered(docs)
    classes = near_duplicates(rows, id_col=row).select(F.col("doc_id").alias(row), F.col("component_id").alias("class"))
    named = stage(rows.select(F.col(row), "doc_id").join(classes, row).select(F.col(row).alias("row"), "doc_id", "class"), "pipe-classes")
    # The smallest id of a class, and of its rows the first; a class without ids has its first row.
    least = named.groupBy("class").agg(F.min("doc_id").alias("low"))
    of_least = named.join(least, "class").where("doc_id <=> low").groupBy("class").agg(F.min("row").alias("first"))
    return _without(rows, row, stage(named.join(of_least, "class").where("row <> first").select("row"), "pipe-copies"))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none. Rows without an id are
    judged too; an empty table gives an empty one. All columns are returned."""
    prepare(spark)
    rows, row = _numbered(docs)
    found = benchmark_matches(rows, table(spark, sf_dir, "benchmark"), id_col=row)
    return _without(rows, row, stage(found.select(F.col("doc_id").alias("row")).distinct(), "pipe-contaminated"))


def keep_secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no secret is found, strong or linked. Null and empty texts hold none. Rows
    without an id are judged too; an empty table gives an empty one. All columns are returned."""
    prepare(spark)
    rows, row = _numbered(docs)
    found = scan_secrets(rows, id_col=row).where(F.size("spans") > 0)
    return _without(rows, row, stage(found.select(F.col("doc_id").alias("row")), "pipe-secrets"))


def pack_kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents packed into sequences; a row per piece. Null texts are packed as empty ones
    (their end id alone), rows without an id and repeated rows each for itself, as ``pack_documents``
    says; an empty table gives an empty one."""
    prepare(spark)
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), PACK_END_ID)

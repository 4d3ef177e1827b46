"""Statute JSONL records.

Every field is read as a string so that values such as ``"5A"`` survive and
are mapped to 0 later (F15) instead of nulling or failing the parse. A JSON
``null`` and a missing key both read as null (D12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

STATUTE_FIELDS = (
    "doc_id", "section_id", "title_num", "title_name", "chapter_num", "short_title",
    "body_text", "text", "status", "chunk_index", "chunk_total", "url",
)
STATUTE_SCHEMA = StructType([StructField(f, StringType()) for f in STATUTE_FIELDS])

# ── Fixed values: title file names, and the split-set files that are excluded ──
TITLE_GLOB = "sc_title_*.jsonl"
SPLIT_SUFFIX_RE = r"_(train|val|test)\.jsonl$"


def parse_statute_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S7 over a DataFrame of JSONL lines: blank and unparsable lines are skipped.

    A line counts as a record only if it parses as one JSON object; junk is
    routed to a corrupt-record field by ``from_json`` and filtered out.
    """
    v = F.col(value_col)
    schema = StructType(STATUTE_SCHEMA.fields + [StructField("_corrupt", StringType())])
    rec = F.from_json(v, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.where(F.trim(v) != F.lit("")).select("*", rec.alias("_rec"))
    keep = [c for c in lines.columns if c != value_col]
    return parsed.where(F.col("_rec").isNotNull() & F.col("_rec._corrupt").isNull()).select(
        *keep, *[F.col(f"_rec.{f}").alias(f) for f in STATUTE_FIELDS]
    )


def scan_statutes_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Statute records from JSONL files, with the source file name."""
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_name"))
    return parse_statute_lines(lines)


def discover_title_files(spark: SparkSession, root: str) -> DataFrame:
    """Title files under ``root`` minus train/val/test splits, sorted by name."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", TITLE_GLOB)
        .load(root)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    return files.where(~F.col("file_name").rlike(SPLIT_SUFFIX_RE)).orderBy("file_name")


def title_file_paths(spark: SparkSession, root: str) -> list[str]:
    """Driver-side list of title file paths (a bounded listing); error when none."""
    from pyspark.errors import AnalysisException

    try:
        paths = [r["path"] for r in discover_title_files(spark, root).select("path").collect()]
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        paths = []
    if not paths:
        raise FileNotFoundError(f"no {TITLE_GLOB} files under {root}")
    return paths

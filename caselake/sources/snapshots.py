"""Bulk CSV snapshots.

Snapshots are headered CSV (often bz2) with quotes escaped by doubling and
newlines inside quoted fields. Spark's ``multiLine`` makes a file one task, so
records are cut in parallel (``csv_splits``) and only then parsed. The first
job converts each snapshot to Parquet once (``stage_snapshot``) and every later
stage reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caselake.functions.text import snapshot_date
from caselake.sources.csv_splits import read_records

CORRUPT = "_corrupt_record"

# Columns each snapshot contributes (all strings; only these are touched).
SNAPSHOT_COLUMNS = {
    "dockets": ("id", "court_id"),
    "opinion-clusters": ("id", "docket_id", "date_filed", "case_name", "case_name_short", "case_name_full"),
    "citations": ("cluster_id", "volume", "reporter", "page"),
    "opinions": ("id", "cluster_id", "type", "plain_text", "html_with_citations"),
}


# Columns that are read where a snapshot's header lists them.
SNAPSHOT_OPTIONAL = {"opinion-clusters": ("precedential_status",)}


def snapshot_columns(spark: SparkSession, path: str, kind: str) -> tuple[str, ...]:
    """The columns to read of a snapshot of that kind."""
    header = snapshot_header(spark, path)
    return (*SNAPSHOT_COLUMNS[kind], *[c for c in SNAPSHOT_OPTIONAL.get(kind, ()) if c in header])


def snapshot_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns] + [StructField(CORRUPT, StringType())])


def snapshot_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a snapshot in file order; reads the header, not the rows."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns


def scan_snapshot_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """Read the named columns of a snapshot, whatever else its header lists and in which order.

    All columns are strings. Malformed rows are detected through
    ``_corrupt_record`` and removed, which, unlike DROPMALFORMED, does not
    depend on which columns a query prunes to. A missing column is an error;
    so is a file of the folder whose header differs from the first one's.
    No per-field length cap: an over-long field would fail the job, so long
    texts are filtered by length downstream instead.

    A file is read by as many tasks as it has splits, bz2 included. The
    result is that of Spark's reader with ``multiLine`` and ``escape='"'``; lines
    end in a line feed or in carriage return and line feed.
    """
    header = snapshot_header(spark, path)
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"snapshot {path} has no column {', '.join(missing)}; its header is {', '.join(header)}")
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    records = read_records(spark, path).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    ddl = ", ".join(f"`{c}` string" for c in [*header, CORRUPT])
    parsed = records.select("header", "record", F.from_csv("record", ddl, options).alias("r"))
    # An all-empty record parses to nulls and stays, as in the reader.
    names = F.array(*[F.col(f"r.`{c}`") for c in header])
    other = F.raise_error(F.concat(F.lit("a file of the snapshot has another header: "), F.col("record")))
    same = names == F.array(*[F.lit(c) for c in header])
    rows = parsed.where(F.when(F.col("header"), F.when(same, F.lit(False)).otherwise(other.cast("boolean"))).otherwise(F.lit(True)))
    return rows.where(F.col(f"r.{CORRUPT}").isNull()).select(*[F.col(f"r.`{c}`").alias(c) for c in columns])


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """File listing (path, file_name, length) without reading contents."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
    )


def latest_snapshot(spark: SparkSession, root: str, prefix: str, suffix: str = ".csv.bz2") -> DataFrame:
    """S2+S3+O2: the lexicographically last ``<prefix>*<suffix>`` file, with its date.

    Returns a one-row DataFrame (path, file_name, snapshot_date); an empty
    result means no snapshot exists (``latest_snapshot_path`` raises then).
    """
    files = list_files(spark, root, f"{prefix}*{suffix}")
    return files.agg(F.max("path").alias("path")).where(F.col("path").isNotNull()).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        snapshot_date(F.col("path")).alias("snapshot_date"),
    )


def latest_snapshot_path(spark: SparkSession, root: str, prefix: str, suffix: str = ".csv.bz2") -> str:
    """Driver-side path of the newest snapshot (one value); error when none."""
    from pyspark.errors import AnalysisException

    try:
        rows = latest_snapshot(spark, root, prefix, suffix).select("path").take(1)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        rows = []
    if not rows:
        raise FileNotFoundError(f"no snapshot matching {prefix}*{suffix} under {root}")
    return rows[0]["path"]


def spread_rows(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def stage_snapshot(spark: SparkSession, csv_path: str, columns, out_path: str, partitions: int | None = None) -> DataFrame:
    """Convert one CSV snapshot to Parquet once; later stages read the Parquet.

    The scan has a task for each split, so rows are written where they were
    read, or spread over ``partitions`` if given.
    """
    spread_rows(scan_snapshot_csv(spark, csv_path, columns), partitions).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def count_nonblank(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S10 over a DataFrame of lines: one row with the number of non-blank lines."""
    return lines.agg(F.count_if(F.trim(value_col) != F.lit("")).alias("rows"))


def row_total(spark: SparkSession, path: str) -> DataFrame:
    """Number of non-blank lines over all files at ``path`` (one-row DataFrame)."""
    return count_nonblank(spark.read.text(path))

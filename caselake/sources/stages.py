"""Written stages that know what they were made of and how large they are (S9, and sizes for J1/J3).

Beside its data a stage has a hidden ``_manifest.json``: a digest of the inputs' listing (path,
length and time of every file), the parameters it was built with, and its rows and bytes, which
are observed while it is written. A stage is reused only if inputs and parameters are the same.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

MANIFEST = "_manifest.json"
ROW_OVERHEAD_BYTES = 16
_FIXED_WIDTHS = {
    "BooleanType": 1, "ByteType": 1, "ShortType": 2, "IntegerType": 4, "DateType": 4, "FloatType": 4,
    "LongType": 8, "DoubleType": 8, "TimestampType": 8, "TimestampNTZType": 8, "DecimalType": 16,
}


def row_bytes(schema: StructType) -> Column:
    """Bytes of a row in memory: strings by length, the rest by width, and an overhead."""
    fixed, parts = ROW_OVERHEAD_BYTES, []
    for f in schema.fields:
        width = _FIXED_WIDTHS.get(type(f.dataType).__name__)
        if width is not None:
            fixed += width
        elif isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:  # nested: its JSON text over-estimates the in-memory size
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    return sum(parts, F.lit(fixed)).cast("bigint")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    stream.close()
    return text


def input_digest(spark: SparkSession, paths) -> str:
    """A digest of every file under the paths: name, length, time of change."""
    found = []
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            found.append([path, None])
            continue
        files = fs.listFiles(p, True)
        while files.hasNext():
            s = files.next()
            found.append([s.getPath().toString(), s.getLen(), s.getModificationTime()])
    return hashlib.md5(json.dumps(sorted(found, key=str)).encode("utf-8")).hexdigest()


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    text = _read_text(spark, os.path.join(path, MANIFEST))
    return json.loads(text) if text else None


def write_measured(df: DataFrame, path: str, about: dict | None = None) -> dict:
    """Overwrite a Parquet stage; its rows and bytes are counted by the write itself and kept, with
    ``about``, in its manifest, which is written last."""
    spark, seen = df.sparkSession, Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("bytes")).write.mode("overwrite").parquet(path)
    size = {"rows": int(seen.get["rows"] or 0), "bytes": int(seen.get["bytes"] or 0)}
    _write_text(spark, os.path.join(path, MANIFEST), json.dumps({**(about or {}), **size}))
    return size


def reuse_or_build(spark: SparkSession, path: str, inputs, params: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage at ``path``, built anew unless its manifest names the same inputs and parameters.
    A stage that was cut off has no manifest; one being replaced loses it first."""
    about = {"inputs": input_digest(spark, inputs), "params": json.loads(json.dumps(params, sort_keys=True, default=str))}
    kept = read_manifest(spark, path)
    if kept is None or {k: kept.get(k) for k in about} != about:
        df = build()
        fs, p = _fs(spark, os.path.join(path, MANIFEST))
        fs.delete(p, False)
        write_measured(df, path, about)
        return spark.read.schema(df.schema).parquet(path)
    return spark.read.parquet(path)


def stage_size(df: DataFrame) -> dict | None:
    """Rows and bytes that were counted when the one stage was written that ``df`` reads, whole or less
    of it; None if it reads anything else."""
    spark, found = df.sparkSession, {}
    folders = {os.path.dirname(f) for f in df.inputFiles()}
    for folder in folders:
        while folder not in found and "=" in os.path.basename(folder):
            folder = os.path.dirname(folder)  # a partition's folder lies in its stage's
        found[folder] = None
    if len(found) != 1:
        return None
    return read_manifest(spark, next(iter(found)))

"""Token ids as Parquet list columns: sorted by document, delta or dictionary encoded, with
bounded row groups and pages whose indexes let a reader skip to single documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import part_offsets
from caselake.llm.tokens import encoder

SCHEMA = "part int, doc_id bigint, part_start bigint, n_tokens bigint, tokens array<int>"
ROW_GROUP_BYTES = 32 * 1024 * 1024
PAGE_BYTES = 256 * 1024
PAGE_ROWS = 1000


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, encoding: str = "delta",
                      row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
                      page_rows: int = PAGE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the ids under ``path``.

    Files hold ascending, disjoint id ranges and rows ascend in each. Columns: ``part`` (range
    number), ``doc_id``, ``part_start`` (ids before the row in its part), ``n_tokens``,
    ``tokens``. ``encoding`` is "delta" (DELTA_BINARY_PACKED) or "dictionary". Page row limits
    and the page index bound what a selective read decodes.

    A null or empty text has ``end_id`` alone; null ids come first; rows with equal ids are
    ordered by text, repeated rows stay; other columns are ignored, whatever their names; an
    empty table gives files without rows.
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError(f"unknown encoding {encoding!r}")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, at = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            rows = [ids.ids(t.as_py()) + end for t in batch.column(2)]
            n = np.array([len(r) // 4 for r in rows], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(n)])
            tokens = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(at + ends[:-1]), pa.array(n), tokens],
                names=["part", "doc_id", "part_start", "n_tokens", "tokens"])
            at += int(ends[-1])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = (
        src.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    (
        ordered.mapInArrow(kernel, SCHEMA).write
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true" if encoding == "dictionary" else "false")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``write_token_files``; filters on doc_id and column choice reach the pages."""
    return spark.read.schema(SCHEMA).parquet(path)


def token_index(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens): where each document begins in the whole id stream; reads no ids."""
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = F.broadcast(part_offsets(sums, "n"))  # one row per written partition
    return files.join(base, "part").withColumn("start", F.col("base") + F.col("part_start")).drop("base")


def token_digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the index plus the unsigned CRC-32 of each
    document's ids as little-endian unsigned 32-bit integers, from the ids as stored."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = token_index(files).select("doc_id", "start", "n_tokens", "tokens")
    return rows.mapInArrow(kernel, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

"""Split-parallel read of quoted multi-line CSV.

A record may hold line ends inside quotes, so a task that starts in the middle of a file cannot
tell whether its first line begins a record. Lines come from Spark's text source, which splits
plain and bz2 files. A first pass works out, for each split, whether its end is inside quotes
if its start is outside, and if its start is inside. A scan over the splits of a file then
gives the true state at each start. A second pass cuts the records: those that lie in one split
leave it whole, and of those that cross a border only the pieces are shuffled.

Quotes follow Spark's CSV reader with ``escape='"'``: a quote opens a field only as its first
character, a doubled one is a quote, and after a closing quote that no delimiter follows the rest
of the field is unquoted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE, DELIMITER = '"', ","


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the line end after ``line`` is inside a quoted field, if its start is or is not."""
    if QUOTE not in line:
        return inside
    parts = line.split(QUOTE)
    last = len(parts) - 1
    closing = False  # the quote before this part was met inside a quoted field
    for n, part in enumerate(parts):
        if closing:
            closing = False
            if not part and n < last:
                inside = True  # doubled: still in the field
                continue
            inside = False
            if n == last:
                return False
            inside = part.endswith(DELIMITER)
        elif inside:
            if n == last:
                return True
            closing, inside = True, False
        else:
            if n == last:
                return False
            inside = part.endswith(DELIMITER) or (n == 0 and not part)
    return inside


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of all files, split by split in order. ``file`` is a hash of the
    file's path and ``block`` the split's first byte."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[str]]]:
    """(file, block, lines) for stretches of lines of one split."""
    for batch in batches:
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lines = batch.column(2).to_pylist()
        first = 0
        for n in range(1, len(lines) + 1):
            if n == len(lines) or files[n] != files[first] or blocks[n] != blocks[first]:
                yield files[first], blocks[first], lines[first:n]
                first = n


def split_ends(lines: DataFrame) -> DataFrame:
    """(file, block, from_outside, from_inside): the state at the end of each split for either state at
    its start; true is inside quotes."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, outside, inside = None, False, True

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([split[0]], pa.int64()), pa.array([split[1]], pa.int64()), pa.array([outside]), pa.array([inside])],
                names=["file", "block", "from_outside", "from_inside"])

        for file, block, some in _runs(batches):
            if (file, block) != split:
                if split:
                    yield told()
                split, outside, inside = (file, block), False, True
            for line in some:
                if QUOTE in line:
                    # Once both ways agree they stay so, and one is worked out.
                    both = outside == inside
                    outside = ends_inside(line, outside)
                    inside = outside if both else ends_inside(line, inside)
        if split:
            yield told()

    return lines.mapInArrow(kernel, "file bigint, block bigint, from_outside boolean, from_inside boolean")


def split_starts(ends: DataFrame) -> DataFrame:
    """(file, block, inside): the true state at the start of each split.

    A split either fixes the state at its end, whatever it was at its start, or keeps or swaps
    it. So the state is that of the last split that fixed it (else outside, as at the file's
    start), swapped as often as splits after that one swap.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.expr("int(from_outside AND NOT from_inside)")).over(before), F.lit(0))
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct("from_outside", "so_far"))
    counted = ends.withColumn("so_far", swaps).withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    # A split that fixes the state swaps none, so what came before it is not counted after it.
    since = F.col("so_far") - F.coalesce("fixed.so_far", F.lit(0))
    return counted.select("file", "block", (F.coalesce("fixed.from_outside", F.lit(False)) != (since % 2 == 1)).alias("inside"))


def cut_records(lines: DataFrame, inside: set[tuple[int, int]]) -> DataFrame:
    """(file, block, kind, record): the records and pieces of records of each split, given the splits
    that start inside quotes. ``kind``: "header" for the first record of a file, "whole", and for pieces
    "tail" (a record's start), "middle" and "head" (its end)."""
    sent = lines.sparkSession.sparkContext.broadcast(frozenset(inside))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = sent.value
        split, state, held, opened = None, False, [], "whole"

        for file, block, some in _runs(batches):
            kinds, records = [], []
            if (file, block) != split:
                if held:
                    yield _pieces(*split, ["middle" if opened == "head" else "tail"], ["\n".join(held)])
                split, held = (file, block), []
                state = split in starts
                opened = "head" if state else "header" if block == 0 else "whole"
            for line in some:
                state = ends_inside(line, state)
                held.append(line)
                if not state:
                    kinds.append(opened)
                    records.append(held[0] if len(held) == 1 else "\n".join(held))
                    held, opened = [], "whole"
            if records:
                yield _pieces(file, block, kinds, records)
        if held:
            yield _pieces(*split, ["middle" if opened == "head" else "tail"], ["\n".join(held)])

    return lines.mapInArrow(kernel, "file bigint, block bigint, kind string, record string")


def _pieces(file: int, block: int, kinds: list[str], records: list[str]) -> pa.RecordBatch:
    many = len(records)
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * many, pa.int64()), pa.array([block] * many, pa.int64()), pa.array(kinds, pa.string()), pa.array(records, pa.string())],
        names=["file", "block", "kind", "record"])


def join_pieces(cut: DataFrame) -> DataFrame:
    """(header, record): whole records, and those that cross splits put together. There are at most two
    pieces a split, so only border records are shuffled."""
    pieces = cut.where("kind IN ('tail', 'middle', 'head')")
    # A split's head comes before its tail.
    in_file = Window.partitionBy("file").orderBy("block", F.col("kind") == "tail")
    begun = F.last(F.when(F.col("kind") == "tail", F.col("block")), ignorenulls=True).over(in_file)
    chained = pieces.withColumn("begun", begun).groupBy("file", "begun").agg(
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
    joined = chained.select(F.lit(False).alias("header"), F.array_join(F.col("parts.record"), "\n").alias("record"))
    return cut.where("kind IN ('whole', 'header')").select((F.col("kind") == "header").alias("header"), "record").union(joined)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(header, record) of all files at ``path``, read by as many tasks as there are splits. The state of
    each split is worked out at once: one pass over the files, one row a split."""
    lines = read_lines(spark, path)
    inside = {(r["file"], r["block"]) for r in split_starts(split_ends(lines)).where("inside").select("file", "block").collect()}
    return join_pieces(cut_records(lines, inside))

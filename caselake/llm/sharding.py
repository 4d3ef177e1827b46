"""Shards of near-equal bytes by sampled splitters, in DataFrame functions.

Records are ordered by (hash of the text, id), so equal texts are neighbours. A sample in which a
record's chance grows with its size gives quantile boundaries; the records fall into these
ranges, and ranges that turn out overfull are subdivided by a new draw inside them. Exact sums per
range then give every record its place in bytes, and the place its shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import stage

SHARDS = 24
RANGES_PER_SHARD = 16
DRAWS_PER_RANGE = 32    # the sample on the driver has about shards x ranges x draws keys
OVERFULL = 2.0          # times the mean bytes of a range
WHOLE_GROUP = 0.02      # a group of equal texts up to this share of a shard is never split
RECORD_BYTES = 8


def _key_struct() -> Column:
    return F.struct("key", "order_id", "tie")


def _literal(bounds: list[tuple]) -> Column:
    rows = ", ".join(f"named_struct('key', {a}L, 'order_id', {b}L, 'tie', {c}L)" for a, b, c in bounds)
    return F.expr(f"array({rows})")


def _range_of(bounds: list[tuple]) -> Column:
    """How many of the ascending boundaries are at most the record's key, in two steps of about
    sqrt(boundaries) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    at = lambda array: F.size(F.filter(array, lambda b: b <= _key_struct()))
    skip = F.greatest(at(_literal(bounds[::step])) - 1, F.lit(0)) * step
    return F.transform(F.array(skip), lambda s: s + at(F.slice(_literal(bounds), s + 1, step)))[0]


def _draw(records: DataFrame, bytes_per_draw: float, seed: int) -> list[tuple]:
    """Sorted keys of a sample; a record of n times ``bytes_per_draw`` is drawn n times on average."""
    chance = F.col("size") / F.lit(bytes_per_draw)
    u = F.pmod(F.xxhash64("key", "order_id", "tie", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = records.withColumn("n", F.floor(chance + u)).where("n >= 1").select("key", "order_id", "tie", "n")
    out = []
    for r in sorted(drawn.collect()):
        out += [tuple(r[:3])] * int(min(r["n"], 64))  # more copies than a range has draws change no quantile
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                  carry: tuple[str, ...] = (), ranges_per_shard: int = RANGES_PER_SHARD,
                  draws_per_range: int = DRAWS_PER_RANGE) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, carried columns) for every row of ``docs``.

    size is the text's UTF-8 bytes plus 8. Shards 0.. hold near-equal bytes in ascending key order;
    slots count a shard's records from 0. Equal texts share a shard unless they outweigh
    WHOLE_GROUP of one. A null text is as an empty one; null ids come first among equal texts;
    repeated rows are records of their own and may be split; an empty table gives an empty
    result. Columns are carried under the names given; others are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = stage(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("order_id"),
        F.monotonically_increasing_id().alias("tie"), F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    ), "shard-records")
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = shards * ranges_per_shard
    sample = _draw(records, max(1.0, total / (ranges * draws_per_range)), 1)
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []

    seed, mean = 1, max(1.0, total / ranges)
    while True:
        sums = {r["range"]: r for r in records.groupBy(_range_of(bounds).alias("range")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()}  # a row per range
        full = [n for n, r in sums.items() if r["bytes"] > OVERFULL * mean and r["rows"] > 1]
        inside = records.withColumn("range", _range_of(bounds)).where(F.col("range").isin(full)) if full else None
        seed += 1
        more = set(_draw(inside, mean / draws_per_range, seed)[::draws_per_range // 2]) - set(bounds) if full else set()
        if not more:
            break
        bounds = sorted(set(bounds) | more)

    before_bytes, before_rows, at, n = [], [], 0, 0
    for k in range(len(bounds) + 1):
        before_bytes.append(at)
        before_rows.append(n)
        at, n = at + (sums[k]["bytes"] if k in sums else 0), n + (sums[k]["rows"] if k in sums else 0)
    base = lambda xs: F.get(F.lit(xs).cast("array<bigint>"), F.col("range"))
    order = Window.partitionBy("range").orderBy("key", "order_id", "tie")
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    share = F.lit(shards / max(1, total))
    placed = stage(
        records.withColumn("range", _range_of(bounds))
        .withColumn("begin", base(before_bytes) + F.sum("size").over(until) - F.col("size"))
        .withColumn("rank", base(before_rows) + F.row_number().over(order) - 1)
        .withColumn("shard", F.least(F.floor((F.col("begin") + F.col("size") / 2) * share), F.lit(shards - 1)).cast("int"))
        .drop("range", "order_id", "tie"), "shard-places")

    # Groups of equal texts across a boundary: at most one for each boundary.
    cut = placed.groupBy("key").agg(
        F.min("shard").alias("a"), F.max("shard").alias("b"), F.min("begin").alias("begin"), F.sum("size").alias("bytes")
    ).where("a < b").where(F.col("bytes") <= F.lit(WHOLE_GROUP * total / shards)).collect()
    shard = F.col("shard")
    for r in cut:
        home = min(shards - 1, int((r["begin"] + r["bytes"] / 2) * shards / total))
        shard = F.when(F.col("key") == r["key"], F.lit(home)).otherwise(shard)
    final = placed.withColumn("shard", shard)
    counts = {r["shard"]: r["n"] for r in final.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = [sum(counts.get(s, 0) for s in range(k)) for k in range(shards)]
    slot = F.col("rank") - F.get(F.lit(first).cast("array<bigint>"), F.col("shard"))
    return final.select("doc_id", "size", "text_crc32", "shard", slot.cast("bigint").alias("slot"), *[F.col("carried")[c].alias(c) for c in carry])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the records, texts included, as one Parquet folder per shard, sorted by slot."""
    rows = assign_shards(docs, shards, id_col, text_col, carry=(text_col,))
    rows.repartitionByRange(4 * shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

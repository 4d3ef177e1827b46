"""Best-fit packing by a configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits one sequence. The covering program
(fewest sequences so that every length is covered as often as it occurs) has one dual weight
per length. Multiplicative weights raise the weights of lengths that lag behind; the pricing
problem, the configuration of most weight, is an unbounded knapsack solved by dynamic
programming over the capacity. The fractional counts are rounded down, and what is left is
packed best-fit decreasing. All of this sees the histogram only, at most ``capacity`` numbers;
pieces find their place by their rank among pieces of the same length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import lean, range_parts, stage
from caselake.llm.tokens import encoder

CAPACITY = 4096
ROUNDS = 32        # pricing problems solved
LEARNING_RATE = 0.1
STEP = 0.5         # share of the scarcest remaining length that a configuration takes at once
LONGER = 0.05      # how much dearer, for its size, the longest piece starts: it is the hardest to place
SLACK = 0.1        # configurations within this share of the best price are used too
_RANK_BITS = 48


@dataclass
class Plan:
    """Where pieces go: for each row, ranks [rank, rank + copies * bins) of ``length`` lie in
    sequences first_bin.., ``copies`` each, from ``offset`` on. ``bound`` is the linear
    program's dual lower bound on the number of sequences."""

    length: np.ndarray
    rank: np.ndarray
    copies: np.ndarray
    first_bin: np.ndarray
    offset: np.ndarray
    bins: int
    bound: float


def knapsack(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over lengths 1..C with ``weight[length]`` (index 0 unused): the most
    weight for every capacity, and the length to take first (0: leave the space)."""
    size = weight.size
    best, first = np.zeros(size), np.zeros(size, dtype=np.int64)
    for c in range(1, size):
        value = best[c - 1::-1] + weight[1:c + 1]
        k = int(value.argmax())
        if value[k] > 0:
            best[c], first[c] = value[k], k + 1
    return best, first


def solve_lp(histogram: np.ndarray, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """Fractional configurations {((length, copies), ...): count} that cover no length more
    often than it occurs, and the best dual bound. ``histogram[length]`` counts pieces."""
    need = histogram.astype(float)
    left, present = need.copy(), histogram > 0
    share = np.arange(need.size) / (need.size - 1)
    weight = np.where(present, share * (1 + LONGER * share), 0.0)
    lengths = np.flatnonzero(present)[::-1]
    chosen: dict[tuple, float] = {}
    bound = float(need @ share)  # the dual solution that prices a piece by its size
    for _ in range(rounds if lengths.size else 0):
        best, first = knapsack(np.where(left >= 1e-9, weight, 0.0))
        priced = best if (left[present] >= 1e-9).all() else knapsack(weight)[0]
        bound = max(bound, float(need @ weight) / priced[-1])
        for length in lengths:  # the dearest configuration that holds this length
            if left[length] < 1e-9 or weight[length] + best[-1 - length] < (1 - SLACK) * best[-1]:
                continue
            items, space = {int(length): 1}, need.size - 1 - length
            while space and first[space]:
                k = int(first[space])
                items[k] = items.get(k, 0) + 1
                space -= k
            take = STEP * min(left[k] / n for k, n in items.items())
            if take <= 0:
                continue
            for k, n in items.items():
                left[k] -= take * n
            key = tuple(sorted(items.items(), reverse=True))
            chosen[key] = chosen.get(key, 0.0) + take
        lag = np.divide(left, need, out=np.zeros_like(need), where=present)
        weight = np.where(present, weight * np.exp(LEARNING_RATE * (lag - lag[present].mean())), 0.0)
    return chosen, bound


def best_fit(histogram: np.ndarray) -> list[tuple[tuple, int]]:
    """Best-fit decreasing on counts: [(((length, copies), ...), sequences)]."""
    capacity = histogram.size - 1
    spaces: list[int] = []
    groups: dict[int, list[tuple[tuple, int]]] = {}

    def put(space: int, items: tuple, n: int) -> None:
        if space not in groups:
            insort(spaces, space)
        groups.setdefault(space, []).append((items, n))

    for length in np.flatnonzero(histogram)[::-1]:
        n, length = int(histogram[length]), int(length)
        while n:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                space, items, count = capacity, (), n
            else:
                space = spaces[at]
                items, count = groups[space].pop()
                if not groups[space]:
                    del groups[space], spaces[at]
            each = min(space // length, n)
            used = min(count, n // each)
            put(space - each * length, (*items, (length, each)), used)
            n -= used * each
            if items and count > used:
                put(space, items, count - used)
    return [(items, n) for space in spaces for items, n in groups[space]]


def make_plan(histogram: np.ndarray, rounds: int = ROUNDS) -> Plan:
    """Solve, round to whole sequences that never cover a length too often, pack the rest
    best-fit; ``histogram[length]`` counts pieces."""
    chosen, bound = solve_lp(histogram, rounds)
    left = histogram.astype(np.int64).copy()
    filled: list[tuple[tuple, int]] = []
    carry = 0.0
    for items, x in chosen.items():
        carry += x  # fractions add up along the list: a whole one is given to the configuration it falls on
        n = min(int(carry), *(int(left[k]) // c for k, c in items))
        carry -= n if n else int(carry)
        if n:
            for k, c in items:
                left[k] -= n * c
            filled.append((items, n))
    rows, bins = [], 0
    taken = np.zeros(histogram.size, dtype=np.int64)
    for items, n in filled + best_fit(left):
        offset = 0
        for length, copies in items:
            rows.append((length, taken[length], copies, bins, offset))
            taken[length] += copies * n
            offset += copies * length
        bins += n
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(*cols, bins=bins, bound=bound)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the ids of each whole text with
    ``end_id`` appended, cut into ``capacity`` pieces where longer."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, data = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = ids.ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at:at + 4 * capacity]
                    rows.append((key, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        data.append(np.frombuffer(part, "<i4"))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            if with_ids:
                arrays.append(pa.array(data, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(lean(kernel), schema)


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``rank``, 0.. among pieces of equal length; a hot length is spread over
    as many tasks as its share of the rows asks for."""
    order = [F.col(c) for c in ("length", "doc_id", "piece", "ids_crc32")]
    parts = range_parts(pieces, *order, name="pack-ranges")
    counts = parts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each part and each length: parts ascend with the length.
    base = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    local = F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32"))
    return (
        parts.withColumn("local", local - 1).join(F.broadcast(base), ["part", "length"])
        .withColumn("rank", F.col("base") + F.col("local")).drop("part", "base", "local")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> tuple[DataFrame, Plan]:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset, and the plan.

    Pieces keep their order only within their document's numbering; sequence ids are 0.. and
    offsets in a sequence gapless from 0. Repeated rows are packed one by one; null ids are
    allowed; an empty table gives an empty result.
    """
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counts:
        histogram[row["length"]] = row["n"]
    plan = make_plan(histogram, rounds)
    key = plan.length << _RANK_BITS | plan.rank
    length, rank, copies, first_bin, offset = plan.length, plan.rank, plan.copies, plan.first_bin, plan.offset

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size, place = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = np.searchsorted(key, size << _RANK_BITS | place, side="right") - 1
            nth = place - rank[row]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first_bin[row] + nth // copies[row]),
                 pa.array(offset[row] + nth % copies[row] * length[row])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rows = ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("bigint"))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(lean(kernel), schema), plan


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
                   rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds ``end_id``. Other columns are ignored,
    whatever their names. The encoder runs once: its pieces are staged.
    """
    pieces = stage(token_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col), "pack-pieces")
    return pack(pieces, capacity, rounds)[0]


def packed_sequences(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
                     rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves. A group holds at most ``capacity`` ids."""
    pieces = stage(token_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, with_ids=True), "pack-ids")
    placed, _ = pack(pieces.drop("ids"), capacity, rounds)
    keys = ["doc_id", "piece", "ids_crc32"]
    unique = pieces.dropDuplicates(keys).select(*keys, "ids")
    same = [placed[k].eqNullSafe(unique[k]) for k in keys]
    rows = placed.join(unique, same).select("sequence_id", F.struct("offset", "ids").alias("x"))
    return rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list("x")).alias("xs")).select(
        "sequence_id", F.flatten(F.col("xs.ids")).alias("ids"))

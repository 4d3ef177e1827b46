"""SimHash near-duplicate classes through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of 2 bits; the vector of per-segment bit
counts (0, 1 or 2 each) is its embedding. The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints. For radius r the segments form
G = ceil((r + 1) / 2) groups: if the whole vectors are within r, one group is within 1
(G groups at 2 or more would make 2G > r). So each group is a unit grid, and two
fingerprints are candidates when, in some group, their cells are equal or neighbours.
Neighbouring cells have bit counts of different parity, so only members of odd cells also
visit the neighbours. Candidates must then pass the Manhattan bound over all segments and
the exact Hamming test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import lean, stage
from caselake.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
MAX_RADIUS = 7
# Distinct fingerprints in one cell that a task compares block by block; a fuller cell goes
# through ``_star_edges``, which is linear in the members. Both are exact.
CELL_MEMBERS = 4096
_HASH_ROWS = 1 << 16


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash: XXH64 (seed 42) of each word shingle, repeats included; a bit
    is 1 if it is set in over half of the hashes. A-Z are lower-cased, words are runs without
    ASCII white space. Fewer words than a shingle: the whole sequence; none: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - shingle_words + 1
    if not words:
        return 0
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _HASH_ROWS):
        part = words[at:at + _HASH_ROWS + shingle_words - 1]
        grams = zip(*(part[k:] for k in range(shingle_words)), strict=False)
        hashes = np.fromiter((digest(join(g), SEED) for g in grams), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, fp bigint): the fingerprint of every whole text; rows stay as they are."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(lean(kernel), "doc_id bigint, fp bigint")


def _cells(reps: DataFrame, radius: int) -> DataFrame:
    """(cell, exact, fp): each fingerprint under its own cell of each group (exact), and
    under the neighbouring cells where its group has an odd number of bits."""
    groups = 1 if radius <= 1 else 2 if radius <= 3 else 4
    fields = 32 // groups
    low = F.lit(0x5555555555555555)
    even, odd = F.col("fp").bitwiseAND(low), F.shiftrightunsigned("fp", 1).bitwiseAND(low)
    counts = F.shiftleft(even.bitwiseAND(odd), 1).bitwiseOR(even.bitwiseXOR(odd))
    rows = []
    for g in range(groups):
        if groups == 1:
            cell = counts
        else:
            width = 64 // groups
            cell = F.shiftrightunsigned(counts, g * width).bitwiseAND(F.lit((1 << width) - 1))
        steps = []
        for j in range(fields):
            two = F.shiftrightunsigned(cell, 2 * j).bitwiseAND(F.lit(3))
            clear = F.lit(_signed(~(3 << 2 * j)))
            for change, allowed in ((1, two < 2), (-1, two > 0)):
                moved = cell.bitwiseAND(clear).bitwiseOR(F.shiftleft(two + change, 2 * j))
                steps.append(F.when(allowed, F.struct(moved.alias("cell"), F.lit(False).alias("exact"))))
        own = F.array(F.struct(cell.alias("cell"), F.lit(True).alias("exact")))
        visited = F.array_compact(F.array(*steps))
        # A field of 2 adds an even number, so the fields of 1 give the parity of the sum.
        odd_sum = F.bit_count(cell.bitwiseAND(low)) % 2 == 1
        each = F.when(odd_sum, F.concat(own, visited)).otherwise(own)
        rows.append(_in_group(each, g))
    return reps.select("fp", F.explode(F.concat(*rows)).alias("x")).select("x.grp", "x.cell", "x.exact", "fp")


def _in_group(cells: Column, g: int) -> Column:
    return F.transform(cells, lambda x: F.struct(F.lit(g).alias("grp"), x["cell"].alias("cell"), x["exact"].alias("exact")))


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >= 1 << 63 else x


def _linked_pairs(key: np.ndarray, exact: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of rows that share a key and of which one is exact; rows are sorted by
    key, exact ones first. Compared by distance in the run, so memory stays linear."""
    low = np.uint64(0x5555555555555555)
    a, b = fp & low, (fp >> np.uint64(1)) & low
    steps = (a | b) | ((a & b) << np.uint64(1))  # a count as 0, 1 or 2 ones: xor counts the Manhattan distance
    left, right = [], []
    at, gap = np.flatnonzero(exact), 1
    while at.size:
        at = at[at + gap < key.size]
        at = at[key[at] == key[at + gap]]
        near = at[np.bitwise_count(steps[at] ^ steps[at + gap]) <= radius]
        near = near[np.bitwise_count(fp[near] ^ fp[near + gap]) <= radius]
        left.append(near)
        right.append(near + gap)
        gap += 1
    return np.concatenate(left or [np.empty(0, np.int64)]), np.concatenate(right or [np.empty(0, np.int64)])


def _forest(fp: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge for each fingerprint, with the same components as the given pairs."""
    values, inverse = np.unique(np.concatenate([fp[left], fp[right]]), return_inverse=True)
    a, b = inverse[:left.size], inverse[left.size:]
    label = np.arange(values.size)
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(old, label):
            break
    node = np.flatnonzero(label != np.arange(values.size))
    return values[node], values[label[node]]


def _cell_edges(cells: DataFrame, radius: int) -> DataFrame:
    """(a, b): edges that connect the linked fingerprints of each cell."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _then_none(batches):
            if batch is None:
                if rest is not None:
                    yield from edges(rest)
                return
            now = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            grp, cell = now["grp"].to_numpy(), now["cell"].to_numpy()
            same = (grp == grp[-1]) & (cell == cell[-1]) if now.num_rows else np.empty(0, bool)
            cut = int(np.argmax(same)) if now.num_rows else 0  # the last cell may go on in the next batch
            if cut:
                yield from edges(now.slice(0, cut))
            rest = now.slice(cut).combine_chunks()

    def edges(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        grp, cell = rows["grp"].to_numpy(), rows["cell"].to_numpy()
        new = np.ones(rows.num_rows, bool)
        new[1:] = (grp[1:] != grp[:-1]) | (cell[1:] != cell[:-1])
        key = np.cumsum(new)
        exact = rows["exact"].to_numpy().astype(bool)
        fp = rows["fp"].to_numpy().view(np.uint64)
        left, right = _linked_pairs(key, exact, fp, radius)
        if left.size:
            a, b = _forest(fp, left, right)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    spread = cells.repartition("grp", "cell").sortWithinPartitions("grp", "cell", F.col("exact").desc())
    return spread.mapInArrow(lean(kernel), "a bigint, b bigint")


def _then_none(batches):
    yield from batches
    yield None


def _star_edges(members: DataFrame, radius: int) -> DataFrame:
    """(a, b): links among fingerprints of overfull cells without comparing pairs.

    Every member visits the values within r // 2 flips of it (near) and those within
    r - r // 2 (far). Two members within r meet at a value where one of them is near, and
    whoever meets a near member is truly linked to it, so tying all visitors of a value to
    its smallest near member keeps exactly the components. Linear in the members.
    """
    near, far = radius // 2, radius - radius // 2

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [(0, 0)]
        frontier = [(0, 0)]
        for size in range(1, far + 1):
            frontier = [(m | 1 << bit, bit + 1) for m, first in frontier for bit in range(first, 64)]
            masks += [(m, size) for m, _ in frontier]
        mask = np.array([m for m, _ in masks], dtype=np.uint64)
        flips = np.array([s for _, s in masks])
        for batch in batches:
            for fp in batch.column(0).to_numpy().view(np.uint64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((mask ^ fp).view(np.int64)), pa.array(np.full(mask.size, fp).view(np.int64)),
                     pa.array(flips <= near)], names=["at", "fp", "near"])

    visits = stage(members.select("fp").distinct().mapInArrow(lean(kernel), "at bigint, fp bigint, near boolean"), "simhash-visits")
    centers = stage(
        visits.groupBy("at").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.count(F.lit(1)).alias("n"))
        .where("b IS NOT NULL AND n > 1").select("at", "b"), "simhash-centers")
    return visits.join(centers, "at").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def link_edges(reps: DataFrame, radius: int = RADIUS, cell_members: int = CELL_MEMBERS) -> DataFrame:
    """(a, b) edges whose components are those of the graph that links distinct fingerprints
    (``reps.fp``) at ``radius`` or fewer differing bits. Not every link is a row."""
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"radius must be 0 to {MAX_RADIUS}")
    # Fingerprints are few bytes, but each has a hundred cells: dealt anew, they are not left to
    # the few tasks that a small file is read in.
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = stage(_cells(reps.select("fp").repartition(parts, "fp"), radius), "simhash-cells")
    full = stage(
        cells.groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_members)
        .select("grp", "cell"), "simhash-full")
    usual = _cell_edges(cells.join(full, ["grp", "cell"], "left_anti"), radius)
    crowded = _star_edges(cells.join(full, ["grp", "cell"], "left_semi"), radius)
    return usual.union(crowded)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    cell_members: int = CELL_MEMBERS) -> DataFrame:
    """(doc_id, fp bigint, component_id) for every row of ``docs``.

    component_id is the smallest id reachable through links of at most ``radius`` differing
    bits, the row's own included. A null or empty text has fingerprint 0 and is linked like
    any other; a row without an id belongs to its class but is never its smallest id (a class
    of such rows only: null). Repeated rows stay. Other columns are ignored, whatever their names.
    """
    marked = stage(fingerprints(docs, id_col, text_col), "simhash-docs")
    reps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    labels = connected_components(link_edges(reps, radius, cell_members))
    linked = stage(reps.join(labels.select(F.col("node").alias("fp"), "label"), "fp"), "simhash-linked")
    smallest = linked.groupBy("label").agg(F.min("rep").alias("low"))
    classes = stage(
        reps.join(linked.join(smallest, "label").select("fp", "low"), "fp", "left")
        .select("fp", F.coalesce("low", "rep").alias("component_id")), "simhash-classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")

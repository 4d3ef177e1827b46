"""Classes of documents linked by the Jaccard similarity of word shingles: a size-aware join.

Equal shingle sets are one set. Shingles have one global order, the common ones last: all documents'
shingles are counted by range of their hash. The order decides how many candidates there are, never
which links are found. Of a set of n
shingles, o = ceil(s n) are in any linked set too, so two linked sets share k shingles among the
first n - o + k of each.

Light sets (at most ``boundary`` shingles) are filed under every subset of SUBSET shingles of
that part; two light sets meet under a subset. Heavy sets are found by inverted lists of
single shingles of the shorter part (k = 1), in which light sets stand as far as their size can
be linked to a heavy one. The boundary is the size at which the rows and expected meetings of
subsets and lists together cost least, by the sizes and keys of all documents; any boundary gives the
same links.

Of every meeting, sizes and positions bound the overlap, then parities by hash range do; what is
left is verified on the whole sets. A long list of near copies is not compared pair by pair: in
ROUNDS rounds each list ties its sets to CENTERS of them, and only sets of one list that are
still in different classes are compared after that, those of a long list inside a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import lean, stage
from caselake.llm.components import connected_components
from caselake.llm.words import find_words, hash_words, mix, text_bytes

SEED = 42
SHINGLE_WORDS = 5
SIMILARITY = (4, 5)      # numerator and denominator
SUBSET = 2               # shingles in an enumerated subset
RANGES = 1 << 20         # of hashes; shingles are counted in them, for the order
TALLIES = 1 << 16        # signed sums, of whose squares the meetings of all keys are worked out
LARGEST_LIGHT = 64       # sizes that the cost is worked out for; beyond it subsets outnumber list rows by far
MEETING_COST = 2.0       # a candidate pair against a row of a list
HOT = 2048               # a shingle met so often has a list that is not windowed in one task
LONG_LIST = 16           # lists up to this length are joined pair by pair
ROUNDS = 3
CENTERS = 4
BROADCAST_ROWS = 1_000_000
BLOCK_ROWS = 4096        # members of a list that a task compares with each other, or with as many
BRIEF_BYTES = 128        # of a sketch, for comparing long lists
_STRIP = 1 << 21
_BLOCK = 4096            # numbers of a sum that are a row
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, shingle_words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text. A-Z are lower-cased, words are runs
    without ASCII white space. Fewer words than a shingle: the whole sequence; none: an empty set."""
    data, bounds = text_bytes(column)
    starts, ends, first = find_words(data, bounds)
    ids = hash_words(data, starts, ends)
    k, whole = shingle_words, max(0, ids.size - shingle_words + 1)
    grams = np.full(whole, k, dtype=np.uint64)
    for j in range(k):
        grams = mix(grams * _BASE + ids[j:j + whole])
    for i in range(len(bounds) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            yield np.unique(grams[a:b - k + 1].view(np.int64))
        elif b == a:
            yield np.empty(0, np.int64)
        else:
            one = np.full(1, b - a, dtype=np.uint64)
            for j in range(a, b):
                one = mix(one * _BASE + ids[j:j + 1])
            yield one.view(np.int64)


def _set_name(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), SEED) - (1 << 63)


def part_length(n: int, k: int) -> int:
    """The first so many shingles of a set of n hold k of any overlap with a linked set."""
    up, down = SIMILARITY
    return min(n, n + n * up // -down + k)


def _ordered(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts) of the first ``length`` in the global order. ``common``: what a range holds anyway,
    and what each holds."""
    usual, counts = common
    often = np.zeros(own.size, dtype=np.int64)
    if counts.size:
        often = np.maximum(counts[own & (counts.size - 1)] - usual, 0)
    at = np.lexsort((own, often))[:length]
    return own[at], often[at]


def _subsets(first: np.ndarray) -> np.ndarray:
    """A 64-bit key for each subset of SUBSET of these shingles, which stand in the global order."""
    picked = np.array(list(combinations(range(first.size), SUBSET)), dtype=np.int64).reshape(-1, SUBSET)
    out = np.full(len(picked), SUBSET, dtype=np.uint64)
    for j in range(SUBSET):
        out = mix(out * _BASE + first.view(np.uint64)[picked[:, j]])
    return out.view(np.int64)


def _sketch(own: np.ndarray) -> bytes:
    """Which hash ranges hold an odd number of shingles, a bit each; two to four ranges a shingle."""
    size = 1 << max(6, int(2 * own.size).bit_length())
    odd = np.bincount(own & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: bytes, size: int) -> bytes:
    """The sketch with ``size`` bytes at most: ranges that fall together add up."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = (int.from_bytes(sketch[:half]) ^ int.from_bytes(sketch[half:])).to_bytes(half)
    return sketch


def _least_difference(a: bytes, b: bytes) -> int:
    """Shingles that must be in one of two sets alone: one at least in each range in which one set has
    an odd and the other an even number. The finer sketch is folded to the coarser."""
    size = min(len(a), len(b))
    return (int.from_bytes(_folded(a, size)) ^ int.from_bytes(_folded(b, size))).bit_count()


def _new_sets(column: pa.Array, shingle_words: int, seen: set[int]) -> Iterator[np.ndarray]:
    """The sets that the task has not met before: copies say nothing of how common a shingle is."""
    for own in shingle_sets(column, shingle_words):
        name = _set_name(own)
        if name not in seen:
            if len(seen) >= BROADCAST_ROWS:
                seen.clear()
            seen.add(name)
            yield own


def _summed(docs: DataFrame, width: int, add: Callable[[np.ndarray, pa.Array, set[int]], None]) -> np.ndarray:
    """``width`` numbers that ``add`` adds up over the texts of a task, summed over all tasks. A task sends
    its numbers in blocks, so what is shuffled does not depend on how many texts it had."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = np.zeros(width, dtype=np.int64), set()
        for batch in batches:
            add(own, batch.column(0), seen)
        if own.any():
            parts = [own[i:i + _BLOCK] for i in range(0, width, _BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["block", "part"])

    def total(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        parts = sum(np.frombuffer(x.as_buffer(), dtype=np.int64) for x in rows["part"])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([parts.tobytes()], pa.binary())})

    out = np.zeros(width, dtype=np.int64)
    sums = docs.select("text").mapInArrow(lean(kernel), "block int, part binary").groupBy("block").applyInArrow(total, "block int, part binary")
    for row in sums.collect():  # ``width`` numbers
        part = np.frombuffer(row["part"], dtype=np.int64)
        out[row["block"] * _BLOCK:row["block"] * _BLOCK + part.size] = part
    return out


def _common(docs: DataFrame, shingle_words: int) -> tuple[tuple[np.ndarray, np.ndarray], dict[int, int]]:
    """((usual, counts), sizes): how many sets hold a shingle of each range of hashes, what half of the ranges
    hold at most, and how many sets have each size up to LARGEST_LIGHT. Counted over all documents;
    copies in a task count once."""

    def add(own: np.ndarray, column: pa.Array, seen: set[int]) -> None:
        for one in _new_sets(column, shingle_words, seen):
            np.add.at(own, one & (RANGES - 1), 1)
            if one.size <= LARGEST_LIGHT:
                own[RANGES + one.size] += 1

    found = _summed(docs, RANGES + LARGEST_LIGHT + 1, add)
    counts = found[:RANGES]
    return (np.median(counts, keepdims=True).astype(np.int64), counts), {n: int(m) for n, m in enumerate(found[RANGES:]) if m and n >= 4}


def choose_boundary(sizes: dict[int, int], list_mates: float, subset_mates: float) -> int:
    """The size up to which sets are light, at the least cost. ``sizes``: sets by size. Each row of a
    list or subset costs 1, and MEETING_COST for each other set expected under its key."""
    up, down = SIMILARITY
    by_list, by_subset = 1 + MEETING_COST * list_mates, 1 + MEETING_COST * subset_mates

    def cost(x: int) -> float:
        total = 0.0
        for n, many in sizes.items():
            if n <= x:
                subset = part_length(n, SUBSET)
                total += many * by_subset * subset * (subset - 1) / 2
            if n > x or n * down >= (x + 1) * up:
                total += many * by_list * part_length(n, 1)
        return total

    return min([0, *range(4, LARGEST_LIGHT + 1)], key=lambda x: (cost(x), x))


def _boundary(docs: DataFrame, common, sizes: dict[int, int], shingle_words: int) -> int:
    """``choose_boundary`` by the sizes of all sets and by how often the small ones among them meet.

    Under keys of n rows each, n (n - 1) rows meet. The sum of n n is that of the squared tallies, to
    which each key adds with a sign of its own, with an error of sqrt(2 / TALLIES)."""
    if not sizes:
        return choose_boundary(sizes, 0.0, 0.0)
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def add(own: np.ndarray, column: pa.Array, seen: set[int]) -> None:
        for one in _new_sets(column, shingle_words, seen):
            if 4 <= one.size <= LARGEST_LIGHT:
                first, _ = _ordered(one, sent.value, part_length(one.size, SUBSET))
                for kind, found in enumerate((first[:part_length(one.size, 1)], _subsets(first))):
                    spread = mix(found.view(np.uint64) * _BASE)
                    np.add.at(own, kind * TALLIES + (spread % np.uint64(TALLIES)).astype(np.int64), 1 - 2 * (spread >> np.uint64(63)).astype(np.int64))
                    own[2 * TALLIES + kind] += found.size

    found = _summed(docs, 2 * TALLIES + 2, add)
    mates = [max(0.0, float((found[k * TALLIES:(k + 1) * TALLIES].astype(float) ** 2).sum()) / max(1, int(found[2 * TALLIES + k])) - 1) for k in (0, 1)]
    return choose_boundary(sizes, *mates)


def _files(docs: DataFrame, common, boundary: int, shingle_words: int) -> DataFrame:
    """(doc_id, h, u, n, sketch, brief, keys): of each document the name, size and sketch of its set and the keys
    it is filed under, as struct(key, at, hot): ``at`` is the shingle's place in the order, null for
    a subset. A set that the same task has met before comes without keys."""
    up, down = SIMILARITY
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            names, sizes, sketches, sums, keys, places, hots = [], [], [], [0], [], [], []
            for own in shingle_sets(batch.column(2), shingle_words):
                n = int(own.size)
                names.append(_set_name(own))
                sizes.append(n)
                sketches.append(_sketch(own))
                made = 0
                if n >= 4 and names[-1] not in seen:  # different sets of fewer shingles are never linked
                    if len(seen) >= BROADCAST_ROWS:
                        seen.clear()
                    seen.add(names[-1])
                    first, often = _ordered(own, sent.value, part_length(n, SUBSET))
                    if n <= boundary:
                        found = _subsets(first)
                        keys.append(found)
                        places.append(np.full(found.size, -1))
                        hots.append(np.zeros(found.size, bool))
                        made += found.size
                    if n > boundary or n * down >= (boundary + 1) * up:
                        short = part_length(n, 1)
                        keys.append(first[:short])
                        places.append(np.arange(short))
                        hots.append(often[:short] >= HOT)
                        made += short
                sums.append(sums[-1] + made)
            flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
            place = flat(places, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sums, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(flat(keys, np.int64)), pa.array(place, mask=place < 0), pa.array(flat(hots, bool))], ["key", "at", "hot"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array([_folded(x, BRIEF_BYTES) for x in sketches], pa.binary()), lists],
                names=["doc_id", "h", "u", "n", "sketch", "brief", "keys"])

    return docs.select("doc_id", "h", "text").mapInArrow(
        kernel, "doc_id bigint, h bigint, u bigint, n bigint, sketch binary, brief binary, keys array<struct<key:bigint,at:int,hot:boolean>>")


def _sets(docs: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """(u, own): the shingle sets of the wanted documents (h, doc_id)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = list(shingle_sets(batch.column(0), shingle_words))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_name(x) for x in own], pa.int64()), pa.array(own, pa.list_(pa.int64()))], names=["u", "own"])

    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)  # spares the texts a shuffle
    same = (docs["h"] == wanted["h"]) & docs["doc_id"].eqNullSafe(wanted["doc_id"])
    return stage(docs.join(wanted, same, "left_semi").select("text").mapInArrow(kernel, "u bigint, own array<bigint>"), "join-sets")


def _may_link(n: Column, at: Column, n2: Column, at2: Column) -> Column:
    """Sizes allow the similarity, and so do the shingles after the first common one. A pair's
    first common shingle passes this, so no link is lost by asking it of each meeting."""
    up, down = SIMILARITY
    sizes = F.least(n, n2) * down >= F.greatest(n, n2) * up
    after = F.least(n - at, n2 - at2)
    return sizes & (at.isNull() | at2.isNull() | (after * (up + down) >= (n + n2) * up))


def _promising_pairs(u, n, at, label, block, sketches) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of one list that sizes, positions and sketches allow and whose labels differ;
    across blocks only, if the rows are of two. Compared in strips, so memory stays linear."""
    up, down = SIMILARITY
    left, right = [], []
    length = np.array([len(x) for x in sketches])
    across = block.min() != block.max()
    for size in np.unique(length):
        own = np.flatnonzero(length == size)
        other = np.concatenate([own, np.flatnonzero(length == 2 * size)])  # linked sets differ by one step at most
        words = np.frombuffer(b"".join(_folded(sketches[i], size) for i in other), dtype=np.uint64).reshape(other.size, -1)
        step = max(1, _STRIP // words.size)
        for first in range(0, own.size, step):
            rows = np.arange(first, min(first + step, own.size))
            apart = np.bitwise_count(words[rows][:, None] ^ words[None]).sum(axis=2, dtype=np.int64)
            a, b = own[rows][:, None], other[None]
            both = n[a] + n[b]
            after = np.minimum(n[a] - at[a], n[b] - at[b])
            fits = (both - apart) * (up + down) >= 2 * up * both
            fits &= (np.minimum(n[a], n[b]) * down >= np.maximum(n[a], n[b]) * up) & (label[a] != label[b]) & (after * (up + down) >= both * up)
            fits &= (np.arange(other.size)[None] > rows[:, None]) & ((block[a] != block[b]) | (not across))
            i, j = np.nonzero(fits)
            left.append(own[rows[i]])
            right.append(other[j])
    return np.concatenate(left), np.concatenate(right)


def _compared(lists: DataFrame, names: DataFrame, block_rows: int) -> DataFrame:
    """(u, u2): the promising pairs of long lists (key, at, u, n, label, many: members of the list).

    A task compares a list, or two blocks of a very long one, in place; no pair is a row before
    its sketches allow it."""
    blocks = F.ceil(F.col("many") / block_rows)
    own = F.pmod(F.xxhash64("u", F.lit(SEED)), blocks)
    dealt = lists.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "many")
    group = ["key", "low", "high"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            if not now.num_rows:
                continue
            keys = np.stack([now[c].to_numpy() for c in group])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for first, last in zip([0, *cuts[:-1]], cuts, strict=False):
                yield pairs(now.slice(first, last - first))
            rest = now.slice(cuts[-1] if cuts.size else 0).combine_chunks()  # the last group may go on
        if rest is not None:
            yield pairs(rest)

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        u, n, at, label, block = (rows[c].to_numpy() for c in ("u", "n", "at", "label", "block"))
        a, b = _promising_pairs(u, n, at, label, block, rows["brief"].to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(u[a]), pa.array(u[b])], names=["u", "u2"])

    columns = [*group, "block", "u", "n", F.coalesce("at", F.lit(0)).alias("at"), "label", "brief"]
    full = dealt.join(names.select("u", "brief"), "u").select(*columns)
    return full.repartition(*group).sortWithinPartitions(*group).mapInArrow(kernel, "u bigint, u2 bigint").distinct()


def _not_ruled_out(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b): the pairs whose sketches leave room for the similarity."""
    up, down = SIMILARITY

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, y = batch.column(2).to_numpy(), batch.column(3).to_pylist(), batch.column(4).to_pylist()
            least = np.fromiter(map(_least_difference, x, y), dtype=np.int64, count=len(x))
            # overlap = (n - difference) / 2, and it must be up / (up + down) of n at least
            kept = pa.array((n - least) * (up + down) >= 2 * up * n)
            yield batch.select([0, 1]).filter(kept)

    of = lambda side, name: sketches.select(F.col("u").alias(side), F.col("sketch").alias(name), F.col("n").alias(f"n{name}"))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", (F.col("nx") + F.col("ny")).alias("n"), "x", "y")
    return both.mapInArrow(kernel, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                       boundary: int | None = None, long_list: int = LONG_LIST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: the size of its shingle set and the
    smallest id reachable through pairs whose sets have a Jaccard similarity of SIMILARITY or
    more, its own included.

    A null or empty text, or one without words, has an empty set and is linked with nothing: its
    own id. A row without an id belongs to its class but is never its smallest id (a class of
    such rows only: null). Repeated rows stay; other columns are ignored, whatever their names; an
    empty table gives an empty one. Hashes have 64 bits; shingles or sets of equal hash are taken
    for equal. ``boundary``: largest size of a light set; chosen by cost if not given.
    """
    up, down = SIMILARITY
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    common, sizes = _common(src, shingle_words)
    light = _boundary(src, common, sizes, shingle_words) if boundary is None else boundary
    filed = stage(_files(src, common, light, shingle_words), "join-files")
    names = stage(filed.groupBy("u").agg(F.min(F.struct("h", "doc_id")).alias("of"), F.max("n").alias("n"), F.first("sketch").alias("sketch"), F.first("brief").alias("brief")), "join-names")
    exploded = filed.select("u", "n", F.explode("keys").alias("k")).select(F.col("k.key").alias("key"), F.col("k.at").alias("at"), "k.hot", "u", "n")
    # If any other set of a list has a size that allows the similarity, so has the next one by size.
    by_size = Window.partitionBy("key").orderBy("n", "u")
    before, after = F.lag("u").over(by_size) != F.col("u"), F.lead("u").over(by_size) != F.col("u")
    fits = (before & (F.lag("n").over(by_size) * down >= F.col("n") * up)) | (after & (F.col("n") * down >= F.lead("n").over(by_size) * up))
    usual = exploded.where("NOT hot").withColumn("fits", fits).where("fits")
    columns = ["key", "at", "u", "n"]
    members = stage(usual.select(columns).union(exploded.where("hot").select(columns)).distinct(), "join-members")

    links = None

    def verified(pairs: DataFrame) -> DataFrame:
        """(a, b): the links among the candidate pairs (u, u2)."""
        both = stage(_not_ruled_out(pairs.select(F.least("u", "u2").alias("a"), F.greatest("u", "u2").alias("b")).distinct(), names), "join-pairs")
        wanted = both.select(F.col("a").alias("u")).union(both.select(F.col("b").alias("u"))).distinct()
        sets = _sets(src, stage(names.join(wanted, "u").select("of.h", "of.doc_id"), "join-wanted"), shingle_words)
        found = both.join(sets.select(F.col("u").alias("a"), F.col("own").alias("x")), "a").join(
            sets.select(F.col("u").alias("b"), F.col("own").alias("y")), "b")
        same = F.size(F.array_intersect("x", "y"))
        return stage(found.where(same * (up + down) >= (F.size("x") + F.size("y")) * up).select("a", "b"), "join-links")

    lists = stage(members.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > long_list), "join-long")
    open_lists = members.join(lists, "key").withColumn("label", F.col("u"))
    for turn in range(ROUNDS):
        # A few sets of each list, the same ones in most lists of a group of near copies.
        by_hash = Window.partitionBy("key").orderBy(F.xxhash64("u", F.lit(turn)), "u")
        center = open_lists.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= CENTERS).select(
            "key", *[F.col(c).alias(f"{c}2") for c in ("u", "n", "at", "label")])
        met = open_lists.join(center, "key").where(
            (F.col("label") != F.col("label2")) & _may_link(F.col("n"), F.col("at"), F.col("n2"), F.col("at2")))
        new = verified(met)
        links = new if links is None else links.union(new)
        labels = connected_components(links)
        named = members.join(lists, "key", "inner" if turn + 1 < ROUNDS else "left")  # short lists after the last round
        named = named.join(labels.select(F.col("node").alias("u"), "label"), "u", "left").withColumn("label", F.coalesce("label", "u"))
        several = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
        open_lists = stage(named.join(several, "key", "left_semi").select(*columns, "label", "many"), "join-open")
    short = open_lists.where("many IS NULL")
    other = short.select("key", *[F.col(c).alias(f"{c}2") for c in ("at", "u", "n", "label")])
    met = short.join(other, "key").where(
        (F.col("u") < F.col("u2")) & (F.col("label") != F.col("label2")) & _may_link(F.col("n"), F.col("at"), F.col("n2"), F.col("at2")))
    compared = _compared(open_lists.where("many IS NOT NULL"), names, block_rows)
    labels = connected_components(links.union(verified(met.select("u", "u2").union(compared))))
    linked = stage(names.select("u").join(labels.select(F.col("node").alias("u"), "label"), "u", "left").select("u", F.coalesce("label", "u").alias("label")), "join-classes")
    classes = filed.select("doc_id", "u", "n").join(linked, "u")
    first = stage(classes.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("low")), "join-first")
    component = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return classes.join(first, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))

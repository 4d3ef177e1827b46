"""Benchmark decontamination with SimHash over item-sized windows.

For each benchmark item of n words, every window of n words in a document is a suspect. The
fingerprints of suspects are looked up in a multi-index of the items' fingerprints: 64 bits in
4 blocks, each item filed under all block values within radius // 4 bits, so by the pigeonhole
principle no item within the radius is missed. A few long words can carry a similar window beyond
any radius, so a second index completes the candidates: of each item the rarest shingles
that weigh more than a window may miss. A window without any of them cannot reach the threshold.
Candidates of the window's size are then verified by the exact weighted similarity of their
word shingles.

Two exact shortcuts keep the windows few. A window can only reach the threshold if the
benchmark shingles in it weigh enough for the lightest item of its size, so others get no
fingerprint; and the sums behind the fingerprints are prefix sums over the shingles.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.common import lean

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
# Characters of benchmark text that one pass over the documents holds in each worker; a larger
# benchmark is worked off in several passes, item by item in full.
PASS_CHARS = 2_000_000
PIECES_IN_CACHE = 100_000
_WORD = re.compile(r"\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased; positions are those of the text."""
    return _WORD.findall(_lower(text))


def _lower(text: str | None) -> str:
    return (text or "").replace("İ", "i").lower()  # the one letter whose lower case is longer


def _shingles(words: list[str], k: int) -> list[tuple[str, ...]]:
    return list(zip(*(words[j:] for j in range(k)), strict=False))


def _weight(shingle: tuple[str, ...]) -> int:
    return sum(map(len, shingle))


def similarity(item: list[str], window: list[str], k: int) -> float:
    """Weight of the item's shingles that the window holds too (with multiplicity), over that
    of all the item's shingles; a shingle weighs as many characters as its words have."""
    have, want = Counter(_shingles(window, k)), Counter(_shingles(item, k))
    total = sum(n * _weight(s) for s, n in want.items())
    return sum(min(n, have[s]) * _weight(s) for s, n in want.items()) / total if total else 0.0


def _signed_bits(shingles: list[tuple[str, ...]]) -> np.ndarray:
    """(shingles, 64): +weight where the shingle's hash has a 1, -weight elsewhere."""
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(s).encode("utf-8", "surrogatepass")) for s in shingles], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    return (2 * bits - 1) * np.array([_weight(s) for s in shingles], dtype=np.int64)[:, None]


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


class _PieceIds(dict):
    """White-space-free piece of a lower-cased text -> vocabulary numbers of its words as bytes
    (0: not in the benchmark); emptied when full."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary
        self.unknown: dict[int, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECES_IN_CACHE:
            self.clear()
        ids = [self.vocabulary.get(w, 0) for w in _WORD.findall(piece)]
        if any(ids):
            out = np.array(ids, dtype="<u4").tobytes()
        else:  # most pieces: one bytes object for all of them
            out = self.unknown.setdefault(len(ids), bytes(4 * len(ids)))
        self[piece] = out
        return out


class BenchmarkIndex:
    """Items of one pass: vocabulary, shingles, fingerprints and the Hamming multi-index."""

    def __init__(self, items: list[tuple[int, str]], shingle_words: int = SHINGLE_WORDS,
                 threshold: float = SIMILARITY, radius: int = RADIUS):
        self.shingle_words, self.threshold, self.radius = shingle_words, threshold, radius
        kept = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if w]
        self.ids = [i for i, _ in kept]
        self.words = [w for _, w in kept]
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.k = [min(shingle_words, len(w)) for w in self.words]
        self.vocabulary: dict[str, int] = {}
        for w in self.words:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.pieces = _PieceIds(self.vocabulary)
        # By shingle length (shorter only for items of fewer words): hashes of the items' shingles.
        self.known: dict[int, np.ndarray] = {}
        for k in sorted(set(self.k)):
            own = [w for w, n in zip(self.words, self.k, strict=True) if n == k]
            hashes = [self._hashes(self._ids(" ".join(w)), k) for w in own]
            self.known[k] = np.unique(np.concatenate(hashes))
        # By item size: the weight that benchmark shingles must have in a window of that size.
        self.least: dict[int, float] = {}
        prints = np.zeros(len(self.words), dtype=np.uint64)
        common = Counter(s for w, k in zip(self.words, self.k, strict=True) for s in set(_shingles(w, k)))
        rare: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for n, (w, k) in enumerate(zip(self.words, self.k, strict=True)):
            shingles = _shingles(w, k)
            need = threshold * sum(map(_weight, shingles)) - 1e-6  # weights are whole numbers
            left = sum(map(_weight, shingles))
            for s, times in sorted(Counter(shingles).items(), key=lambda x: (common[x[0]], x[0])):
                if left < need:
                    break
                rare[k].append((int(self._hashes(self._ids(" ".join(s)), k)[0]), n))
                left -= times * _weight(s)
            self.least[len(w)] = min(need, self.least.get(len(w), need))
            prints[n] = _pack(_signed_bits(shingles).sum(axis=0, keepdims=True))[0]
        self.prints = prints
        # By shingle length: hashes of the rare shingles, start of each one's list, items.
        self.rare: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k, entries in rare.items():
            entries.sort()
            hashes, starts = np.unique(np.array([h for h, _ in entries], dtype=np.uint64), return_index=True)
            self.rare[k] = hashes, np.append(starts, len(entries)), np.array([n for _, n in entries], dtype=np.int64)
        self.buckets = [self._bucket(b) for b in range(BLOCKS)]

    def _ids(self, lowered: str) -> np.ndarray:
        """Vocabulary numbers of ``words_of`` the text; no word holds white space."""
        ids = b"".join(map(self.pieces.__getitem__, lowered.split()))
        return np.frombuffer(ids, dtype="<u4").astype(np.uint64)

    @staticmethod
    def _hashes(ids: np.ndarray, k: int) -> np.ndarray:
        n = ids.size - k + 1
        out = np.zeros(max(n, 0), dtype=np.uint64)
        for j in range(k if n > 0 else 0):
            out = out * _BASE + ids[j:j + n]
        return out

    def _bucket(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(start of each block value's list, items) for every value within radius // BLOCKS."""
        masks = np.array([sum(1 << b for b in bits) for n in range(self.radius // BLOCKS + 1)
                          for bits in combinations(range(BLOCK_BITS), n)], dtype=np.int64)
        values = (self.prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & (1 << BLOCK_BITS) - 1
        near = (values[:, None] ^ masks[None, :]).ravel()
        order = np.argsort(near, kind="stable")
        starts = np.searchsorted(near[order], np.arange((1 << BLOCK_BITS) + 1))
        return starts, (order // masks.size).astype(np.int32)

    def lookup(self, prints: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of equal size within the radius; none within it is missed."""
        pairs = []
        for block, (starts, items) in enumerate(self.buckets):
            value = (prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & (1 << BLOCK_BITS) - 1
            count = starts[value + 1] - starts[value]
            window = np.repeat(np.arange(prints.size), count)
            at = np.arange(window.size) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts[value], count)
            item = items[at]
            fit = self.size[item] == size[window]
            fit[fit] = np.bitwise_count(prints[window[fit]] ^ self.prints[item[fit]]) <= self.radius
            pairs.append(window[fit] * len(self.words) + item[fit])
        unique = np.unique(np.concatenate(pairs))
        return unique // len(self.words), unique % len(self.words)

    def sharing(self, text: str | None, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of equal size of which the window holds a rare shingle of the item;
        no pair that reaches the threshold is missed."""
        ids = self._ids(_lower(text))
        stride = ids.size + 1
        order = np.argsort(size * stride + start, kind="stable")
        placed = (size * stride + start)[order]
        pairs = [np.empty(0, np.int64)]
        for k, (hashes, starts, items) in self.rare.items():
            at, found = self._known_at(ids, k, hashes)
            place = np.searchsorted(hashes, found)
            count = starts[place + 1] - starts[place]
            pos = np.repeat(at, count)
            item = items[np.arange(pos.size) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts[place], count)]
            own = self.size[item]
            lo = np.searchsorted(placed, own * stride + np.maximum(pos - (own - k), 0))
            hi = np.searchsorted(placed, own * stride + pos, side="right")
            count = np.maximum(hi - lo, 0)
            window = order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)]
            pairs.append(np.unique(window * len(self.words) + np.repeat(item, count)))
        unique = np.unique(np.concatenate(pairs))
        return unique // len(self.words), unique % len(self.words)

    def suspects(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, fingerprint) of the windows that could reach the threshold."""
        ids = self._ids(_lower(text))
        starts, sizes, prints = [], [], []
        words: list[str] = []
        for k, known in self.known.items():
            hit, _ = self._known_at(ids, k, known)
            if not hit.size:
                continue
            words = words or words_of(text)
            weight = np.zeros(ids.size - k + 1, dtype=np.int64)
            weight[hit] = [_weight(tuple(words[i:i + k])) for i in hit]
            mass = np.concatenate([[0], np.cumsum(weight)])
            sums: dict[int, np.ndarray] = {}
            reach = max(self.least)
            for lo, hi in _regions(hit, reach, ids.size):
                for size, need in self.least.items():
                    if min(self.shingle_words, size) != k:
                        continue
                    first, last = max(lo, 0), min(hi, ids.size - size)
                    if last < first:
                        continue
                    at = np.arange(first, last + 1)
                    at = at[mass[at + size - k + 1] - mass[at] >= need]
                    if not at.size:
                        continue
                    if lo not in sums:
                        top = min(hi + reach, ids.size)
                        rows = _signed_bits(_shingles(words[lo:top], k))
                        sums[lo] = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(rows, axis=0)])
                    starts.append(at)
                    sizes.append(np.full(at.size, size))
                    prints.append(_pack(sums[lo][at - lo + size - k + 1] - sums[lo][at - lo]))
        if not starts:
            none = np.empty(0, np.int64)
            return none, none, none.astype(np.uint64)
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(prints)

    def _known_at(self, ids: np.ndarray, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, hash) of the text's shingles that are among the known ones."""
        n = ids.size - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        full = np.ones(n, bool)
        for j in range(k):
            full &= ids[j:j + n] > 0
        at = np.flatnonzero(full)
        hashes = np.zeros(at.size, dtype=np.uint64)
        for j in range(k):
            hashes = hashes * _BASE + ids[at + j]
        place = np.minimum(np.searchsorted(known, hashes), known.size - 1)
        fit = known[place] == hashes
        return at[fit], hashes[fit]

    def matches(self, text: str | None) -> list[tuple[int, float, int, int, int]]:
        """(item id, similarity, Hamming distance, start, end) for each item found in the text: its
        most similar window, the first of equals; start and end in code points."""
        start, size, prints = self.suspects(text)
        if not start.size:
            return []
        words = words_of(text)
        found: dict[int, tuple] = {}
        near, shared = self.lookup(prints, size), self.sharing(text, start, size)
        for w, n in np.unique(np.concatenate([np.stack(near, axis=1), np.stack(shared, axis=1)]), axis=0).tolist():
            at, item = int(start[w]), self.words[n]
            like = similarity(item, words[at:at + len(item)], self.k[n])
            if like >= self.threshold:
                far = int(np.bitwise_count(prints[w] ^ self.prints[n]))
                best = (-like, at, far)
                if n not in found or best < found[n]:
                    found[n] = best
        if not found:
            return []
        spans = [m.span() for m in _WORD.finditer(_lower(text))]
        return [(self.ids[n], -like, far, spans[at][0], spans[at + len(self.words[n]) - 1][1])
                for n, (like, at, far) in sorted(found.items())]


def _regions(hits: np.ndarray, reach: int, n: int) -> Iterator[tuple[int, int]]:
    """Ranges of window starts from which a window of up to ``reach`` words can hold a hit."""
    lo, hi = max(0, int(hits[0]) - reach), int(hits[0])
    for h in hits[1:].tolist():
        if h - reach > hi:
            yield lo, min(hi, n)
            lo = max(0, h - reach)
        hi = h
    yield lo, min(hi, n)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", threshold: float = SIMILARITY,
                      radius: int = RADIUS, pass_chars: int = PASS_CHARS) -> DataFrame:
    """(doc_id, item_id, similarity, hamming, start, end): a row for each document and each
    benchmark item that it holds, from the whole text of every document.

    Items and documents without words match nothing; a null text is empty. An item of fewer than
    five words is one shingle of all its words. Repeated documents give a row each, repeated
    items a row for each distinct id; null ids are carried. Of equally similar windows the first
    is reported. Empty tables give no rows. Other columns are ignored, whatever their names.
    """
    items = benchmark.select(
        F.col(item_col).cast("bigint").alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("t"),
    ).distinct()
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    passes = max(1, -(-int(chars) // pass_chars))
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, item_id bigint, similarity double, hamming int, start int, end int"
    out = None
    for n in range(passes):
        rows = items.where(F.pmod(F.xxhash64("t", "item"), F.lit(passes)) == n).collect()  # about pass_chars characters
        found = src.mapInArrow(lean(_kernel(sorted(((r["item"], r["t"]) for r in rows), key=repr), threshold, radius)), schema)
        out = found if out is None else out.union(found)
    return out


def _kernel(items, threshold, radius):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BenchmarkIndex(items, threshold=threshold, radius=radius)
        names = ["doc_id", "item_id", "similarity", "hamming", "start", "end"]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            rows = defaultdict(list)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for match in index.matches(text.as_py()) if index.ids else ():
                    for name, value in zip(names, (key, *match), strict=True):
                        rows[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in zip(names, types, strict=True)], names=names)
    return kernel

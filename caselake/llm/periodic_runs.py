"""Periodic runs of words: seed and extend along diagonals.

A run of smallest period q that is at least max(LEAST, 3 q) words long agrees with itself shifted
by q in a stretch of max(LEAST - q, 2 q) words or more. So for the periods up to SEED_WORDS a
seed of SEED_WORDS words lies in that stretch, and for those of (K / 2, K] one of K words; K
doubles until no run fits the text.

Seeds of one length are indexed by hash, and each is paired with its next occurrence in the
document. Inside a run the next occurrence is one smallest period away: nearer it would give
the run a smaller period. So only lags of (K / 2, K] are followed, each pair names a
diagonal, and the stretch around it is extended word by word both ways. A table of how far
each lag is covered drops the seeds that lie in a stretch already found.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.words import find_words, hash_words, mix, text_bytes

LEAST = 24          # words of the shortest run
PERIODS = 3         # periods that a run holds at least
SEED_WORDS = 16     # min over q of max(LEAST - q, 2 q)
_BASE = np.uint64(0x9E3779B97F4A7C15)
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _next_occurrences(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of each gram that comes again: to its next occurrence; by place."""
    order = np.argsort(grams, kind="stable")
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    place = order[again]
    lag = order[again + 1] - place
    by_place = np.argsort(place, kind="stable")
    return place[by_place], lag[by_place]


def _agree(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from a and b on (step 1) or back (-1) are the same, by blocks that double."""
    done, block = 0, 32
    while True:
        if step > 0:
            size = min(block, ids.size - (b + done))
            same = ids[a + done:a + done + size] == ids[b + done:b + done + size]
        else:
            size = min(block, a - done + 1)
            same = (ids[a - done - size + 1:a - done + 1] == ids[b - done - size + 1:b - done + 1])[::-1]
        if size <= 0:
            return done
        if not same.all():
            return done + int(np.argmin(same))
        done += size
        block *= 2


def find_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least max(least, 3 * period) ids, by start, then
    period. A run is a longest stretch with that smallest period."""
    n = ids.size
    runs: list[tuple[int, int, int]] = []
    # The shortest stretch over the periods q is that of the q where least - q meets 2 q.
    size = max(1, min(max(least - q, (PERIODS - 1) * q) for q in range(1, max(2, least))))
    low, width = 0, 1
    grams = mix(ids + _BASE)
    while True:
        while width < size:  # the hash of a gram from those of two shorter ones that cover it
            step = min(width, size - width)
            grams = mix(grams[:-step] * _BASE + grams[step:]) if grams.size > step else grams[:0]
            width += step
        if grams.size < 2:
            return sorted(runs, key=lambda r: (r[0], r[2]))
        covered: dict[int, int] = {}
        place, lag = _next_occurrences(grams)
        fits = (lag > low) & (lag <= size)
        for i, q in zip(place[fits].tolist(), lag[fits].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            start = i - _agree(ids, i - 1, i - 1 + q, -1) if i else 0
            end = i + _agree(ids, i, i + q, 1)
            covered[q] = end
            if end - start + q >= max(least, PERIODS * q):
                runs.append((start, end - start + q, q))
        low, size = size, 2 * size


def dropped_words(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words some run holds after its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) > 0


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, runs, collapsed, collapsed_sha256) for every row of ``docs``.

    Words are runs without ASCII white space, as written. ``runs``: array of struct(start, length,
    period) by start, then period, in word numbers. ``collapsed``: the words that no run holds
    after its first period, joined by one space (null unless ``with_text``), and its digest.
    A null or empty text has no words, no runs and an empty collapsed text. Null ids and repeated
    rows stay; other columns are ignored, whatever their names; an empty table gives an empty one.
    Words are told apart by 64-bit hashes.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column(1), lower=False)
            starts, ends, first = find_words(data, bounds)
            ids = hash_words(data, starts, ends)
            counts, lists, texts, digests = [], [], [], []
            for i in range(batch.num_rows):
                a, b = int(first[i]), int(first[i + 1])
                runs = find_runs(ids[a:b], least)
                kept = _joined(data, starts[a:b], ends[a:b], ~dropped_words(runs, b - a) if runs else None)
                counts.append(b - a)
                lists.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                digests.append(sha256(kept).hexdigest())
                texts.append(kept.decode("utf-8", "surrogatepass") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()),
                 pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                 pa.array(texts, pa.string()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(kernel, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string, collapsed_sha256 string")


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray | None) -> bytes:
    """The kept words' bytes with one space between them."""
    if kept is not None:
        starts, ends = starts[kept], ends[kept]
    if not starts.size:
        return b""
    size = ends - starts + 1  # with the space after it
    at = np.cumsum(size) - size
    source = np.arange(int(size.sum())) + np.repeat(starts - at, size)
    out = data[source]
    out[at + size - 1] = 32
    return out[:-1].tobytes()


def strongest_run(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equals the smallest start, then period. Null
    if there is none."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]  # runs come by start, then period
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def run_text(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")

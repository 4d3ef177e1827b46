"""Embedding and vector top-k.

Shape of every search here: the query batch is the bounded side — its size is
checked, then it is broadcast once; the corpus is scanned where it lies with
``mapInPandas``; each task keeps only its own top-k per query (so no
(query, row) pairs are shuffled), and a final ``row_number`` window — planned
as ``WindowGroupLimit`` — picks the global top-k from k candidates per task.
Scores are computed in double and rounded to 6 decimals before ranking; ties
go to the smaller id.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, FloatType

from caselake.operators.term_index import TOKEN_PATTERN
from caselake.session import release_memory

_TOKEN = regex.compile(TOKEN_PATTERN)
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
MAX_BROADCAST_QUERIES = 10_000
# Upper bound on query x row scores held in memory at once inside a task.
SCORE_CELLS = 4_000_000


# ── X2: pluggable batched encoder ───────────────────────────────────────────


@functools.cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """TOKEN_PATTERN for ``re``, which is faster: for ASCII texts, and for those without characters
    beyond the basic plane. The classes are written out as ``regex`` knows them."""
    plane = "".join(" " if 0xD800 <= c < 0xE000 else chr(c) for c in range(0x10000))
    runs = regex.finditer(r"[\p{L}\p{M}\p{N}]+", plane)
    word = "[" + "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in runs) + "]"
    return re.compile(r"[a-z0-9]+(?:[.'-][a-z0-9]+)*"), re.compile(f"{word}+(?:[.'’-]{word}+)*|§+")


def tokens(text: str | None) -> list[str]:
    """The tokens of ``term_index.token_list``, in Python (hashing encoder, default reranker)."""
    text = (text or "").lower()
    plain, plane = _patterns()
    if text.isascii():
        return plain.findall(text)
    return (_TOKEN if _BEYOND.search(text) else plane).findall(text)


class _Slots(dict):
    """token -> 2 * bucket, and 1 more where the sign is -; forgotten when ``limit`` are held."""

    def __init__(self, dim: int, limit: int):
        super().__init__()
        self.dim, self.limit = dim, limit

    def __missing__(self, tok: str) -> int:
        h = hashlib.md5(tok.encode("utf-8"), usedforsecurity=False).digest()
        if len(self) >= self.limit:
            self.clear()
        self[tok] = slot = 2 * (int.from_bytes(h[:4], "big") % self.dim) + h[4] % 2
        return slot


class HashingEncoder:
    """Deterministic signed feature hashing, L2-normalized (a stand-in model).

    Token t goes to bucket int(md5(t)[:8], 16) % dim with sign + when
    int(md5(t)[8:10], 16) is even, else -. Token hashes are cached per worker
    (bounded), since a corpus repeats a small vocabulary.
    """

    CACHE_LIMIT = 100_000

    def __init__(self, dim: int = 64):
        self.dim = dim
        self._slots = _Slots(dim, self.CACHE_LIMIT)

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        slot = self._slots.__getitem__
        for row, text in zip(out, texts, strict=True):
            found = tokens(text)
            counts = np.bincount(np.fromiter(map(slot, found), np.int64, len(found)), minlength=2 * self.dim)
            row[:] = counts[0::2] - counts[1::2]
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


_ENCODERS: dict = {}


def cached_encoder(key: str, factory: Callable[[], Callable[[list[str]], np.ndarray]]):
    """The worker's encoder of that key, built on first use. UDFs refer to this function by its
    module, so the cache belongs to the worker process and not to a pickled copy of it."""
    if key not in _ENCODERS:
        _ENCODERS[key] = factory()
    return _ENCODERS[key]


def batch_encoder(encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]] | None = None, dim: int = 64,
                  batch_size: int = 256, model_key: str | None = None) -> Callable[[list], Iterator[np.ndarray]]:
    """The encoder of ``embed`` for use inside a kernel: a list of texts -> their float32 vectors, in order, as
    matrices of at most ``batch_size`` rows."""
    factory = encoder_factory or (lambda: HashingEncoder(dim))
    key = model_key or (f"hashing-{dim}" if encoder_factory is None else f"model-{uuid.uuid4().hex}")

    def encode(texts: list) -> Iterator[np.ndarray]:
        enc = cached_encoder(key, factory)
        for i in range(0, len(texts), batch_size):
            yield enc(texts[i:i + batch_size]).astype(np.float32)

    return encode


def embed(col, encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
          dim: int = 64, batch_size: int = 256, model_key: str | None = None, skip_null: bool = False):
    """Text column -> array<float> via a batched encoder.

    ``encoder_factory`` is called once per Python worker and ``model_key`` (the
    model is loaded lazily and cached), then fed batches of ``batch_size``
    texts. Without a key each call of ``embed`` is a model of its own. With
    ``skip_null`` a null text is not encoded and has no vector.
    """
    encode = batch_encoder(encoder_factory, dim, batch_size, model_key)

    @pandas_udf(ArrayType(FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            at = np.flatnonzero(texts.notna()) if skip_null else np.arange(len(texts))
            out = np.full(len(texts), None, dtype=object)
            for place, row in zip(at, itertools.chain.from_iterable(encode(texts.iloc[at].tolist())), strict=True):
                out[place] = row
            yield pd.Series(out)
        release_memory()

    return _embed(F.col(col) if isinstance(col, str) else col)


def hash_embed(col, dim: int = 64):
    """X2 with the hashing encoder."""
    return embed(col, None, dim)


# ── Size-checked broadcast of the query batch ───────────────────────────────


def collect_bounded(df: DataFrame, max_rows: int) -> list | None:
    """Rows of ``df`` when it has at most ``max_rows`` rows, else None."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def query_blocks(queries: DataFrame, q_id: str, max_rows: int, depth: int = 0) -> Iterator[list]:
    """The query batch as lists of at most ``max_rows`` rows, one after another.

    One list when small enough; otherwise the batch is split by a hash of the query id, and a
    part that is still too large is split again by another one. Rows that share an id cannot be
    told apart by it and are split by all they hold. Each list then scans the corpus once:
    exact results, no pair explosion.
    """
    rows = collect_bounded(queries, max_rows)
    if rows is not None:
        if rows:
            yield rows
        return
    parts = max(2, math.ceil(2 * queries.count() / max_rows))
    key = [F.col(q_id)] if depth < 2 else [F.to_json(F.struct(*[F.col(c) for c in queries.columns]))]
    if depth > 4:
        raise ValueError(f"over {max_rows} equal queries")
    for n in range(parts):
        part = queries.where(F.pmod(F.xxhash64(F.lit(depth), *key), F.lit(parts)) == n)
        yield from query_blocks(part, q_id, max_rows, depth + 1)


# ── Per-task top-k kernel ───────────────────────────────────────────────────


def _topk_merge(best_s, best_i, s, i, k, ascending):
    """Merge candidate (score, id) matrices row-wise, keep k best per row.

    Exact: each row's k-th best value is found in linear time, only cells at
    least that good (ties included) are sorted by (score, id).
    """
    if best_s is not None:
        s = np.concatenate([best_s, s], axis=1)
        i = np.concatenate([best_i, i], axis=1)
    nq, m = s.shape
    kk = min(k, m)
    primary = s if ascending else -s
    if m > kk:
        kth = np.partition(primary, kk - 1, axis=1)[:, kk - 1:kk]
        rows, cols = np.nonzero(primary <= kth)
    else:
        rows, cols = np.nonzero(np.ones_like(primary, dtype=bool))
    order = np.lexsort((i[rows, cols], primary[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    keep = rank < kk
    rows, cols = rows[keep], cols[keep]
    out_s = s[rows, cols].reshape(nq, kk)
    out_i = i[rows, cols].reshape(nq, kk)
    return out_s, out_i


def _scores(metric: str, Q: np.ndarray, qn: np.ndarray, C: np.ndarray) -> np.ndarray:
    dots = Q @ C.T
    if metric == "ip":
        return dots
    cn = np.sqrt((C * C).sum(axis=1))
    if metric == "cosine":
        denom = qn[:, None] * cn[None, :]
        return np.divide(dots, denom, out=np.zeros_like(dots), where=denom > 0)
    if metric == "l2":
        sq = qn[:, None] ** 2 + cn[None, :] ** 2 - 2.0 * dots
        return np.sqrt(np.maximum(sq, 0.0))
    raise ValueError(f"unknown metric {metric!r}")


def _make_kernel(qids, Q, k, metric, c_id, c_vec, encode=None):
    ascending = metric == "l2"
    qn = np.sqrt((Q * Q).sum(axis=1))
    worst = np.inf if ascending else -np.inf
    step = max(1, SCORE_CELLS // max(1, len(qids)))

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best_s = best_i = None
        for pdf in batches:
            if pdf.empty:
                continue
            vecs = pdf[c_vec].to_numpy()  # one numpy array per row (from Arrow), or its text
            present = np.fromiter((v is not None for v in vecs), dtype=bool, count=len(vecs))
            if encode is None and not present.all():
                vecs = vecs[present]
                pdf = pdf[present]
                if pdf.empty:
                    continue
            ids_all = pdf[c_id].to_numpy(dtype=np.int64)
            for lo in range(0, len(pdf), step):
                rows = vecs[lo:lo + step]
                C = (np.stack(rows) if encode is None else np.concatenate(list(encode(rows.tolist())))).astype(np.float64, copy=False)
                ids = ids_all[lo:lo + step]
                S = np.round(_scores(metric, Q, qn, C), 6)
                # an all-zero query vector (no tokens) carries no signal: no results
                S[qn == 0.0, :] = worst
                I = np.broadcast_to(ids, S.shape)
                best_s, best_i = _topk_merge(best_s, best_i, S, I, k, ascending)
        if best_s is None:
            return
        rows_q = np.repeat(qids, best_s.shape[1])
        s, i = best_s.ravel(), best_i.ravel()
        keep = np.isfinite(s)
        yield pd.DataFrame({"query_id": rows_q[keep], "item_id": i[keep], "score": s[keep]})
        release_memory()

    return kernel


# Candidates merged per query in one task are capped at k x TOPK_FAN_IN.
TOPK_FAN_IN = 256


def global_topk(cands: DataFrame, k: int, ascending: bool, partitions: int | None = None) -> DataFrame:
    """Top-k per query from per-task candidates (k per query per task).

    Candidates are first reduced per (query, group of tasks) and then per
    query, so no query's final window holds more than k x TOPK_FAN_IN rows
    however many tasks the corpus has. Callers whose inputs are already
    bounded per query pass ``partitions`` at most TOPK_FAN_IN to use one level.
    (The task count of an arbitrary plan is not probed: under adaptive
    execution that would run its shuffles.)
    """
    order = F.col("score").asc() if ascending else F.col("score").desc()
    if partitions is None or partitions > TOPK_FAN_IN:
        group = F.pmod(F.spark_partition_id(), F.lit(TOPK_FAN_IN))
        w1 = Window.partitionBy("query_id", "_grp").orderBy(order, F.col("item_id").asc())
        cands = (cands.withColumn("_grp", group).withColumn("_r", F.row_number().over(w1))
                 .where(F.col("_r") <= k).drop("_r", "_grp"))
    w = Window.partitionBy("query_id").orderBy(order, F.col("item_id").asc())
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = 10, metric: str = "cosine",
                q_id: str = "query_id", q_vec: str = "vector", c_id: str = "item_id",
                c_vec: str = "vector", max_queries: int = MAX_BROADCAST_QUERIES,
                encode: Callable[[list], Iterator[np.ndarray]] | None = None) -> DataFrame:
    """V1/V2: top-k corpus rows per query.

    metric: "cosine" / "ip" (higher first) or "l2" (smaller first).
    Returns (query_id, item_id, score, rank). Ids must be integral; a query
    whose vector is all zeros gets no rows, corpus rows without a vector are
    not candidates.
    A batch above the bound is searched block by block: each is collected, broadcast and
    let go before the next one, so the driver holds one block.
    With ``encode`` (``batch_encoder``) ``c_vec`` holds texts, null ones too, that are encoded where they
    are ranked: a task then needs one Python worker, not a second one for the vectors.
    """
    spark = corpus.sparkSession
    ascending = metric == "l2"
    # Rows without a vector are skipped inside the kernel: a filter on the vector
    # column would be pushed under a vector-producing UDF and run it twice.
    corpus_cols = corpus.select(F.col(c_id).cast("bigint").alias(c_id), F.col(c_vec).alias(c_vec))
    schema = "query_id long, item_id long, score double"
    parts = []
    for block in query_blocks(queries.select(q_id, q_vec), q_id, max_queries):
        qids = np.array([int(r[0]) for r in block], dtype=np.int64)
        Q = np.array([list(r[1]) for r in block], dtype=np.float64)
        bq = spark.sparkContext.broadcast((qids, Q))

        def kernel(batches, bq=bq):
            qi, qm = bq.value
            return _make_kernel(qi, qm, k, metric, c_id, c_vec, encode)(batches)

        parts.append(corpus_cols.mapInPandas(kernel, schema))
    if not parts:
        return spark.createDataFrame([], schema + ", rank int")
    cands = parts[0]
    for p in parts[1:]:
        cands = cands.unionByName(p)
    return global_topk(cands, k, ascending)

"""V7: approximate nearest neighbours through an inverted file of sign codes.

The code of a vector is the signs of CODE_BITS projections. The leading bits are its cell; how
many bits depends on the number of rows, so that a cell holds CELL_ROWS rows or so. The index has a
row for every vector (cell, id, code), sorted by cell, and beside it the vectors themselves.

A query's projections are its margins. The margins, with the signs of a cell's bits, order the
cells: those that differ from the query's own only where its margin is small come first. Cells are
probed in that order until they hold ``probe`` of the rows. In them the margins, with the signs of
the whole code, estimate each row's inner product, and the best ``keep`` rows a query are scored on
their vectors. ``keep`` grows with the fourth root of the rows, so the share that is scored falls.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.operators.vectors import MAX_BROADCAST_QUERIES, global_topk, query_blocks
from caselake.session import scratch_path

CODE_BITS = 256
CELL_ROWS = 64
MAX_CELL_BITS = 20
PROBE = 0.95
KEEP_FACTOR = 3
_SCORES = 4_000_000


@lru_cache(maxsize=8)
def sign_planes(bits: int, dim: int, seed: int) -> np.ndarray:
    """(bits, dim) projections with entries +1/-1. Entry (j, i) is +1 when
    int(md5(f"plane:{seed}:{j}:{i}")[:2], 16) is even: anyone, SQL too, can make them again."""
    out = np.empty((bits, dim))
    for j in range(bits):
        for i in range(dim):
            h = hashlib.md5(f"plane:{seed}:{j}:{i}".encode("ascii")).hexdigest()
            out[j, i] = 1.0 if int(h[:2], 16) % 2 == 0 else -1.0
    return out


def cell_bits(rows: int) -> int:
    """Leading code bits that name a cell."""
    return min(MAX_CELL_BITS, max(0, (rows // CELL_ROWS).bit_length() - 1))


def kept_rows(rows: int, k: int) -> int:
    """Rows that are scored on their vectors for each query."""
    return max(k, math.ceil(KEEP_FACTOR * k * rows ** 0.25))


class SignIndex:
    """The written index: ``codes`` (cell, id, code), ``vectors`` (id, vector) and the sizes of the cells."""

    def __init__(self, spark, path: str, rows: int, bits: int, dim: int, seed: int):
        self.spark, self.path, self.rows, self.bits, self.dim, self.seed = spark, path, rows, bits, dim, seed
        self.codes = spark.read.schema("cell int, id bigint, code binary").parquet(f"{path}/codes")
        self.vectors = spark.read.schema("id bigint, vector array<float>").parquet(f"{path}/vectors")

    def cell_sizes(self) -> np.ndarray:
        sizes = np.zeros(1 << self.bits, dtype=np.int64)  # at most 2^MAX_CELL_BITS numbers
        for r in self.codes.groupBy("cell").count().collect():
            sizes[r["cell"]] = r["count"]
        return sizes


def build_sign_index(corpus: DataFrame, id_col: str = "item_id", vec_col: str = "vector", path: str | None = None,
                     code_bits: int = CODE_BITS, seed: int = 17) -> SignIndex:
    """Every row that has a vector is indexed; nothing is fitted to data. Vectors are coded as they are:
    the sign of a projection does not change with a vector's length."""
    spark = corpus.sparkSession
    path = path or scratch_path(spark, "sign-index")
    corpus.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<float>").alias("vector")).write.parquet(f"{path}/vectors")
    vectors = spark.read.schema("id bigint, vector array<float>").parquet(f"{path}/vectors").where("vector IS NOT NULL")
    rows, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    bits = cell_bits(rows)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = sign_planes(code_bits, dim, seed)
        for batch in batches:
            if batch.num_rows:
                V = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
                signs = V @ planes.T >= 0
                cell = (signs[:, :bits] * (1 << np.arange(bits))).sum(axis=1)
                packed = np.packbits(signs, axis=1, bitorder="little")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), batch.column(0), pa.array([row.tobytes() for row in packed], pa.binary())],
                    names=["cell", "id", "code"])

    coded = vectors.mapInArrow(kernel, "cell int, id bigint, code binary") if rows else spark.createDataFrame([], "cell int, id bigint, code binary")
    # A cell's rows stand together, so a search of few cells skips row groups by their bounds.
    coded.repartitionByRange("cell").sortWithinPartitions("cell").write.parquet(f"{path}/codes")
    return SignIndex(spark, path, rows, bits, dim or 0, seed)


def probed_cells(margins: np.ndarray, sizes: np.ndarray, probe: float) -> np.ndarray:
    """(queries, cells) of bool: the cells of each query that are searched. Equal cells go by number."""
    bits = sizes.size.bit_length() - 1
    signs = np.where(np.arange(sizes.size)[:, None] >> np.arange(bits) & 1, 1.0, -1.0)
    order = np.argsort(-(margins[:, :bits] @ signs.T), axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(order.shape, dtype=bool)
    np.put_along_axis(out, order, before < probe * sizes.sum(), axis=1)
    return out


def search_sign_index(index: SignIndex, queries: DataFrame, k: int = 10, metric: str = "cosine", q_id: str = "query_id",
                      q_vec: str = "vector", probe: float = PROBE, keep: int | None = None,
                      max_queries: int = MAX_BROADCAST_QUERIES) -> DataFrame:
    """(query_id, item_id, score, rank): the k best of the rows whose codes promise most.

    Scores are exact; neighbours can be missed. A query whose vector is all zeros gets no rows.
    "ip" and "l2" are scored so, but candidates are found by angle.
    """
    spark = index.spark
    schema = "query_id long, item_id long, score double"
    if not index.rows:
        return spark.createDataFrame([], schema + ", rank int")
    sizes, planes = index.cell_sizes(), sign_planes(CODE_BITS, index.dim, index.seed)
    keep = keep or kept_rows(index.rows, k)
    found = None
    for block in query_blocks(queries.select(q_id, q_vec), q_id, max_queries):
        block = [r for r in block if r[1] is not None and any(r[1])]
        if not block:
            continue
        ids = np.array([int(r[0]) for r in block], dtype=np.int64)
        vectors = np.array([list(r[1]) for r in block], dtype=np.float64)
        margins = vectors @ planes.T
        near = _promising(index, ids, margins, probed_cells(margins, sizes, probe), keep)
        scored = _scored(near, index, ids, vectors, metric)
        found = scored if found is None else found.union(scored)
    if found is None:
        return spark.createDataFrame([], schema + ", rank int")
    return global_topk(found, k, metric == "l2", partitions=1)  # at most ``keep`` rows a query


def _promising(index: SignIndex, ids: np.ndarray, margins: np.ndarray, probed: np.ndarray, keep: int) -> DataFrame:
    """(query_id, item_id): for each query the ``keep`` rows of its probed cells that the codes rate best,
    equal ones by id; each task sends on no more than its own best."""
    sent = index.spark.sparkContext.broadcast((ids, margins, probed))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, margins, probed = sent.value
        best = [(np.empty(0), np.empty(0, np.int64))] * qids.size
        for batch in batches:
            cell = batch.column(0).to_numpy()
            row_ids = batch.column(1).to_numpy()
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(cell.size, -1)
            step = max(1, _SCORES // max(1, qids.size + margins.shape[1]))
            for at in range(0, cell.size, step):
                some = slice(at, at + step)
                asked = np.flatnonzero(probed[:, np.unique(cell[some])].any(axis=1))
                signs = np.unpackbits(codes[some], axis=1, bitorder="little") * 2.0 - 1.0
                rated = margins[asked] @ signs.T
                for q, row in zip(asked.tolist(), rated, strict=True):
                    mine = np.flatnonzero(probed[q, cell[some]])
                    value, item = np.concatenate([best[q][0], row[mine]]), np.concatenate([best[q][1], row_ids[some][mine]])
                    if value.size > keep:
                        least = np.partition(value, value.size - keep)[value.size - keep]
                        ok = value >= least
                        value, item = value[ok], item[ok]
                        order = np.lexsort((item, -value))[:keep]
                        value, item = value[order], item[order]
                    best[q] = (value, item)
        for q, (value, item) in enumerate(best):
            if item.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(item.size, qids[q])), pa.array(item), pa.array(value)], names=["query_id", "item_id", "score"])

    rated = index.codes.mapInArrow(kernel, "query_id bigint, item_id bigint, score double")
    return global_topk(rated, keep, False).select("query_id", "item_id")


def _scored(near: DataFrame, index: SignIndex, ids: np.ndarray, vectors: np.ndarray, metric: str) -> DataFrame:
    """(query_id, item_id, score) of the candidate pairs, on the vectors; to 6 decimals."""
    sent = index.spark.sparkContext.broadcast((ids, vectors))
    pairs = near.join(index.vectors.withColumnRenamed("id", "item_id"), "item_id").select("query_id", "item_id", "vector")

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, queries = sent.value
        order = np.argsort(qids)
        for rows in batches:
            if rows.empty:
                continue
            Q = queries[order[np.searchsorted(qids[order], rows["query_id"].to_numpy())]]
            C = np.stack(rows["vector"].to_numpy()).astype(np.float64)
            dots, qn, cn = (Q * C).sum(axis=1), np.sqrt((Q * Q).sum(axis=1)), np.sqrt((C * C).sum(axis=1))
            if metric == "cosine":
                dots = np.divide(dots, qn * cn, out=np.zeros_like(dots), where=cn > 0)
            elif metric == "l2":
                dots = np.sqrt(np.maximum(qn**2 + cn**2 - 2 * dots, 0.0))
            yield pd.DataFrame({"query_id": rows["query_id"], "item_id": rows["item_id"], "score": np.round(dots, 6)})

    if metric not in ("cosine", "ip", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    return pairs.mapInPandas(kernel, "query_id long, item_id long, score double")

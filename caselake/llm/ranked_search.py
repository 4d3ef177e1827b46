"""Ranked lexical search by best-first document intervals.

Postings of the queries' terms are made once from the whole texts, in blocks of documents. In a
block every posting list has a range-maximum sparse table over its impacts (all lists lie in
one array, so one table serves them all), and the place of any document in any list is known.
The sum of a query's range maxima bounds every score in an interval of documents. The interval
of the largest bound is split at the document of its largest single impact: that document is
scored, and the two rest intervals get bounds of their own, until no bound reaches the k-th best
score. Each round takes the few best intervals of every query of the block at once.

A search of a sample of the documents comes first: the k-th best score it finds for a query is
reached by k documents, so blocks of the main search need nothing below it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import stage
from caselake.llm.words import TERMS, find_words, hash_word, hash_words, text_bytes

TOP = 50
QUERY_BLOCK = 1000           # queries answered in one pass over the documents
BLOCK_DOCS = 2048
BLOCK_POSTINGS = 1 << 20
ROUND_INTERVALS = 32         # intervals of a query that one round splits
SAMPLE_SHARE = 32            # one document of so many is searched first
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
_DOC_BITS = BLOCK_DOCS.bit_length()


def terms_of(text: str | None) -> list[str]:
    """Runs of ASCII letters, digits and anything beyond ASCII; only A-Z are lower-cased."""
    return _TERM.findall((text or "").translate(_LOWER))


@dataclass
class Queries:
    """Queries of one pass: their ids, the sorted hashes of all their terms, and each query's terms as
    places in those, padded with a term that no document has."""
    ids: list
    vocabulary: np.ndarray
    terms: np.ndarray


def make_queries(rows: list[tuple]) -> Queries:
    """From (id, text) rows: rows of one id are one query; a query without a term is none."""
    by_id: dict = {}
    for key, text in rows:
        by_id.setdefault(key, set()).update(terms_of(text))
    by_id = {key: terms for key, terms in by_id.items() if terms}
    hashes = {t: hash_word(t) for t in sorted(set().union(*by_id.values()))}
    vocabulary = np.unique(np.array(list(hashes.values()), dtype=np.uint64))
    place = {t: int(np.searchsorted(vocabulary, np.uint64(h))) for t, h in hashes.items()}
    width = max((len(t) for t in by_id.values()), default=1)
    terms = np.full((len(by_id), width), vocabulary.size, dtype=np.int64)
    for row, found in enumerate(by_id.values()):
        terms[row, :len(found)] = sorted(place[t] for t in found)
    return Queries(list(by_id), vocabulary, terms)


def document_postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: its terms with repeats, and the places
    and occurrences of those in the vocabulary. docs: doc_id, text."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            starts, ends, first = find_words(data, bounds, TERMS)
            hashes = hash_words(data, starts, ends)
            place = np.minimum(np.searchsorted(known, hashes), known.size - 1)
            hit = np.flatnonzero(known[place] == hashes)
            doc = np.searchsorted(first, hit, side="right") - 1
            pairs, tfs = np.unique(doc * known.size + place[hit], return_counts=True)
            n = np.diff(first)
            cuts = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * known.size)
            cut = pa.array(cuts, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(cut, pa.array(pairs % known.size, pa.int32())),
                 pa.ListArray.from_arrays(cut, pa.array(tfs, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(kernel, "doc_id bigint, n bigint, terms array<int>, tfs array<int>")


def term_counts(postings: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary; each task adds up its own first."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met])], names=["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    for r in postings.select("terms").mapInArrow(kernel, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


@dataclass
class Weights:
    """What scores need of the whole corpus: documents with a term, their terms, a weight per term."""
    documents: int
    length: int
    of_term: np.ndarray

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 50 + (50 * n * self.documents) // self.length
        return self.of_term[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def corpus_weights(postings: DataFrame, size: int) -> Weights:
    total = postings.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    many, length = total["N"], total["L"] or 0
    weights = [math.floor(1000 * math.log((2 * many + 2) / (2 * df + 1))) for df in term_counts(postings, size).tolist()]
    return Weights(many, length, np.array(weights, dtype=np.int64))


class Best:
    """The k best (score, document) of each query so far: larger scores first, then known and smaller ids."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.unknown = np.empty(0, bool)
        self.doc = np.empty(0, np.int64)
        # A score of ``least`` is needed; at that score, an id below ``limit`` once k documents are there.
        self.floor = np.ones(queries, np.int64) if floor is None else np.maximum(floor, 1)
        self.least = self.floor.copy()
        self.limit = np.full(queries, np.iinfo(np.int64).max)

    def wanted(self, query: np.ndarray, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return (score > self.least[query]) | ((score == self.least[query]) & (doc <= self.limit[query]))

    def add(self, query: np.ndarray, score: np.ndarray, unknown: np.ndarray, doc: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        unknown, doc = np.concatenate([self.unknown, unknown]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, unknown, -score, query))
        first = np.searchsorted(query[order], np.arange(self.least.size + 1))
        order = order[np.arange(order.size) - first[query[order]] < self.k]
        self.query, self.score, self.unknown, self.doc = query[order], score[order], unknown[order], doc[order]
        first = np.searchsorted(self.query, np.arange(self.least.size + 1))
        full = np.flatnonzero(np.diff(first) == self.k)
        last = first[full + 1] - 1
        self.least[full] = np.maximum(self.floor[full], self.score[last])
        tied = self.score[last] == self.least[full]
        self.limit[full] = np.where(tied & ~self.unknown[last], self.doc[last], np.iinfo(np.int64).max)


class Block:
    """Posting lists of some documents, ascending ids, with a sparse table of range maxima."""

    def __init__(self, doc: np.ndarray, unknown: np.ndarray, term: np.ndarray, local: np.ndarray, impact: np.ndarray, vocabulary: int):
        """doc, unknown: by local number; term, local, impact: postings in any order."""
        self.doc, self.unknown, docs = doc, unknown, doc.size
        counts = np.zeros((vocabulary + 1, docs + 1), dtype=np.int32)
        counts[term, local + 1] = 1
        # place[t, d]: where list t has its first posting of document d or a later one
        place = np.cumsum(counts, axis=1, dtype=np.int32)
        place[1:] += np.cumsum(place[:-1, -1], dtype=np.int32)[:, None]
        self.place = place
        order = np.lexsort((local, term))
        top = (impact[order] << _DOC_BITS) | local[order]  # the largest impact and its document
        longest = int(counts.sum(axis=1).max(initial=0))
        self.tables = [np.append(top, 0)]
        for j in range(max(0, longest.bit_length() - 1)):
            last, step = self.tables[-1], 1 << j
            self.tables.append(np.maximum(last, np.append(last[step:], np.zeros(min(step, last.size), np.int64))[:last.size]))
        self.stack = np.stack(self.tables)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of each range of postings the largest impact with its document; 0 for an empty range."""
        size = high - low
        level = np.frexp(np.maximum(size, 1))[1] - 1
        found = np.maximum(self.stack[level, low], self.stack[level, np.maximum(high - (1 << level), 0)])
        return np.where(size > 0, found, 0)

    def search(self, terms: np.ndarray, best: Best) -> int:
        """Adds this block's documents to the best of every query; returns how many were scored."""
        queries, scored = np.arange(len(terms)), 0
        low, high = np.zeros(len(terms), np.int64), np.full(len(terms), self.doc.size, np.int64)
        bound, at = self._bound(self.place[terms, 0], self.place[terms, self.doc.size])
        while True:
            live = (bound > 0) & best.wanted(queries, bound, self.doc[np.minimum(low, self.doc.size - 1)])
            queries, low, high, bound, at = queries[live], low[live], high[live], bound[live], at[live]
            if not queries.size:
                return scored
            order = np.lexsort((-bound, queries))
            first = np.searchsorted(queries[order], np.arange(len(terms)))
            now = np.zeros(queries.size, bool)
            now[order] = np.arange(order.size) - first[queries[order]] < ROUND_INTERVALS
            q, a, b, d = queries[now], low[now], high[now], at[now]
            own = terms[q]
            start, here = self.place[own, a[:, None]], self.place[own, d[:, None]]
            after, stop = self.place[own, d[:, None] + 1], self.place[own, b[:, None]]
            score = (np.where(after > here, self.tables[0][here], 0) >> _DOC_BITS).sum(axis=1)
            scored += q.size
            good = (score > 0) & best.wanted(q, score, self.doc[d])
            if good.any():
                best.add(q[good], score[good], self.unknown[d[good]], self.doc[d[good]])
            left, right = self._bound(start, here), self._bound(after, stop)
            rest = ~now
            queries, low, high = (np.concatenate(x) for x in ((queries[rest], q, q), (low[rest], a, d + 1), (high[rest], d, b)))
            bound, at = (np.concatenate(x) for x in ((bound[rest], left[0], right[0]), (at[rest], left[1], right[1])))

    def _bound(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the range maxima, document of the largest) for each row of ranges."""
        found = self.largest(low, high)
        return (found >> _DOC_BITS).sum(axis=1), found.max(axis=1) & ((1 << _DOC_BITS) - 1)


def _blocks(batches: Iterator[pa.RecordBatch], weights: Weights, vocabulary: int) -> Iterator[Block]:
    """Blocks of up to BLOCK_DOCS documents and about BLOCK_POSTINGS postings."""
    held, rows, size = [], 0, 0

    def built() -> Block:
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t["doc_id"].combine_chunks()
        unknown, doc = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        terms, tfs = t["terms"].combine_chunks(), t["tfs"].combine_chunks()
        many = np.diff(terms.offsets.to_numpy())
        order = np.lexsort((doc, unknown))
        local = np.empty(doc.size, np.int64)
        local[order] = np.arange(doc.size)
        term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
        impact = weights.impacts(term, tf, np.repeat(t["n"].to_numpy(), many))
        return Block(doc[order], unknown[order], term, np.repeat(local, many), impact, vocabulary)

    for batch in batches:
        lengths = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
        batch, lengths = batch.filter(pa.array(lengths > 0)), lengths[lengths > 0]  # the rest has no query term
        at = 0
        while at < batch.num_rows:
            room = int(np.searchsorted(np.cumsum(lengths[at:]), BLOCK_POSTINGS - size, side="right"))
            take = min(BLOCK_DOCS - rows, max(room, 0 if rows else 1), batch.num_rows - at)
            if take:
                held.append(batch.slice(at, take))
                rows, size, at = rows + take, size + int(lengths[at:at + take].sum()), at + take
            if rows == BLOCK_DOCS or at < batch.num_rows:
                yield built()
                held, rows, size = [], 0, 0
    if rows:
        yield built()


def best_documents(postings: DataFrame, queries: Queries, weights: Weights, k: int, floor: np.ndarray | None = None) -> DataFrame:
    """(query, score, doc_id, rank): the k best documents of each query (its number) in the postings,
    of those that score ``floor`` or more."""
    sc = postings.sparkSession.sparkContext
    sent = sc.broadcast((queries.terms, weights, floor))
    size = queries.vocabulary.size

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, floor = sent.value
        best = Best(len(terms), k, floor)
        for block in _blocks(batches, weights, size):
            block.search(terms, best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.query, pa.int32()), pa.array(best.score), pa.array(best.doc, mask=best.unknown)], names=["query", "score", "doc_id"])

    # A search takes long for few bytes of postings, so they are dealt to more tasks than their size asks for.
    tasks = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = postings.repartition(tasks).mapInArrow(kernel, "query int, score bigint, doc_id bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 for each item, equal
    scores by ascending id, ids that are null last.

    A null or empty text has no term: such a document is not counted and never found, such an
    item finds nothing. Items of one id are one query; repeated documents are found each for
    itself. Other columns are ignored, whatever their names; an empty table gives an empty
    result. Items are taken in blocks of about QUERY_BLOCK, each with one pass over the
    texts. Terms are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    blocks = -(-asked.count() // QUERY_BLOCK)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        queries = make_queries([(r["item_id"], r["text"]) for r in rows])
        if not queries.ids:
            continue
        postings = stage(document_postings(src, queries.vocabulary), "search-postings")
        weights = corpus_weights(postings, queries.vocabulary.size)
        if not weights.documents:
            continue
        sample = postings.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE_SHARE)) == 0)
        floor = np.zeros(len(queries.ids), np.int64)
        for r in best_documents(sample, queries, weights, k).where(F.col("rank") == k).select("query", "score").collect():
            floor[r["query"]] = r["score"]
        found = best_documents(postings, queries, weights, k, floor)
        names = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id bigint")  # QUERY_BLOCK rows or so
        out = out.union(found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    return out

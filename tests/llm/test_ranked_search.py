"""Ranked search against scores of all pairs."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from caselake.llm import ranked_search as R
from caselake.llm.common import prepare
from caselake.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def brute(docs, items, k=50):
    """(item, rank, doc, score) rows by scoring every document for every item."""
    counted = [(i, Counter(R.terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    many, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(R.terms_of(t))
    out = Counter()
    for item, terms in asked.items():
        scores = []
        for i, c in counted:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * many) // length
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out[item, rank, i, -s] += 1
    return out


def got(df):
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return Counter(tuple(r) for r in df.collect())


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert got(QUERIES["op11_ranked_search"](spark, SF_SMALL)) == brute(docs, items)


@pytest.mark.parametrize(("k", "block"), [(1, 16), (5, 7), (50, 2048)])
def test_random_texts_with_ties(spark, monkeypatch, k, block):
    monkeypatch.setattr(R, "QUERY_BLOCK", 9)
    rng = random.Random(k)
    vocabulary = [f"w{n}" for n in range(80)]
    weights = [1 / (n + 1) for n in range(80)]
    say = lambda n: " ".join(rng.choices(vocabulary, weights, k=n))
    docs = [(n, say(rng.choice([0, 1, 5, 30, 100]))) for n in range(400)]
    docs += [(1000 + n, docs[n % 3][1]) for n in range(120)] + [(7, docs[7][1]), (None, docs[9][1]), (None, None), (2000, "..."), (-5, docs[9][1])]
    rng.shuffle(docs)
    items = [(n, say(rng.choice([1, 3, 20]))) for n in range(20)] + [(20, None), (21, ""), (3, "w3 w79"), (None, "W1 w2"), (22, "unheard")]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, terms string").repartition(3)
    i = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    assert got(R.ranked_search(d, i, k)) == brute(docs, items, k)
    # The same in blocks of a few documents, where thresholds carry over.
    queries = R.make_queries(items)
    postings = R.document_postings(d.select("doc_id", "text"), queries.vocabulary).cache()
    stats = R.corpus_weights(postings, queries.vocabulary.size)
    best = R.Best(len(queries.ids), k)
    monkeypatch.setattr(R, "BLOCK_DOCS", block)
    monkeypatch.setattr(R, "ROUND_INTERVALS", 2)
    for part in R._blocks(iter(postings.toArrow().to_batches()), stats, queries.vocabulary.size):
        part.search(queries.terms, best)
    want = Counter((item, doc, s) for item, _, doc, s in brute(docs, items, k).elements())
    assert Counter((queries.ids[q], None if u else d, s) for q, s, u, d in zip(best.query.tolist(), best.score.tolist(), best.unknown, best.doc.tolist(), strict=True)) == want


def test_empty_tables_and_long_texts(spark):
    docs = [(1, "Wörter und 漢字-Zeichen " * 30_000 + "needle"), (2, "needle"), (3, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, "NEEDLE 漢字"), (2, "Wörter " * 9000)]
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(R.ranked_search(d, i)) == brute(docs, items)
    assert not got(R.ranked_search(d.where("doc_id < 0"), i)) and not got(R.ranked_search(d, i.where("item_id < 0")))
    assert not got(R.ranked_search(d.where("doc_id = 3"), i))


def test_range_maxima_are_those_of_the_lists():
    rng = np.random.default_rng(4)
    seen = rng.random((6, 200)) < np.array([0, 0.02, 0.3, 0.9, 1, 0.5])[:, None]
    term, local = np.nonzero(seen)
    impact = rng.integers(1, 1 << 34, term.size)
    block = R.Block(np.arange(200), np.zeros(200, bool), term, local, impact, 6)
    table = np.zeros((6, 200), np.int64)
    table[term, local] = impact
    for _ in range(500):
        t, (a, b) = rng.integers(0, 6), np.sort(rng.integers(0, 201, 2))
        found = int(block.largest(block.place[t, a][None], block.place[t, b][None])[0])
        assert found >> R._DOC_BITS == table[t, a:b].max(initial=0)
        assert not found or table[t, found & ((1 << R._DOC_BITS) - 1)] == found >> R._DOC_BITS


def test_a_search_scores_few_documents():
    rng = np.random.default_rng(5)
    seen = rng.random((40, 2000)) < (1 / np.arange(2, 42))[:, None]
    seen[:, :60] = True  # documents that hold every term
    term, local = np.nonzero(seen)
    block = R.Block(np.arange(2000), np.zeros(2000, bool), term, local, rng.integers(900_000, 1_000_000, term.size), 40)
    assert block.search(np.arange(40)[None], R.Best(1, 50)) < 500

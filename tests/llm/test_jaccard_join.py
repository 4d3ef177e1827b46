"""The size-aware Jaccard join against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caselake.llm import jaccard_join
from caselake.llm.common import prepare
from caselake.llm.queries import QUERIES
from caselake.llm.words import SPACED, TERMS, find_words, hash_word, hash_words, text_bytes
from tests.conftest import SF_SMALL

LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def word_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (size, smallest linked id), by all pairs."""
    sets = [word_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                links += sets[a] != sets[b]
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    ids = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(n)] = min(i, ids.get(find(n), i))
    return Counter((i, len(sets[n]), ids.get(find(n))) for n, (i, _) in enumerate(rows)), links


def got(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def mixed_rows(seed, count):
    rng = random.Random(seed)
    pool = [f"v{k}" for k in range(3000)]
    common = rng.choices(pool, k=60)
    texts = []
    for n in range(count):
        base = rng.choices(pool, k=rng.choice([3, 7, 9, 14, 24, 40, 120, 300]))
        if n % 3 == 0:
            base[5:5] = common  # one passage that many texts share
        texts.append(base)
        for _ in range(rng.randrange(5)):
            near = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.randrange(1, max(2, len(base) // 30))):
                near[rng.choice([0, -1, rng.randrange(len(near))])] = "Other"
            texts.append(near)
    return [(n, " ".join(w)) for n, w in enumerate(texts)] + [(9000, None), (9001, " "), (9002, ""), (None, " ".join(texts[0])), (9003, "One"), (9004, "one")]


@pytest.mark.parametrize(("boundary", "long_list", "block_rows"), [(None, 32, 99), (0, 1, 4), (30, 3, 9), (1000, 2, 1000)])
def test_links_are_those_of_all_pairs(spark, boundary, long_list, block_rows):
    rows = mixed_rows(8, 60)
    want, links = brute(rows)
    assert links > 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard_join.jaccard_components(docs, boundary=boundary, long_list=long_list, block_rows=block_rows)) == want


def test_a_group_of_near_copies_and_a_chain(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for n in range(150):  # near copies of one text, each edited in its own place
        words = list(base)
        words[rng.randrange(120)] = f"x{n}"
        rows.append((n, " ".join(words)))
    long = [f"c{k}" for k in range(400)]
    rows += [(1000 - n, " ".join(long[n * 8:n * 8 + 200])) for n in range(20)]  # neighbours are linked, the ends are not
    want, _ = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(jaccard_join.jaccard_components(docs, long_list=4)) == want


def test_edge_rows(spark):
    long = "Überlange Zeile mit vielen Wörtern und 123 Zahlen. " * 400
    rows = [(1, "a b c d"), (2, None), (3, ""), (4, long), (4, long), (None, "a b c d"), (None, None), (5, " \n\t "), (6, "éà 漢字 İ"), (7, "A b c d"), (8, long + "x"),
            (None, "only here")]
    docs = spark.createDataFrame([(i, t, "x", 1, "k") for i, t in rows], "doc_id long, text string, u string, n int, key string")
    assert got(jaccard_join.jaccard_components(docs)) == brute(rows)[0]
    assert jaccard_join.jaccard_components(docs.where("doc_id = -1")).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(QUERIES["op13_jaccard_join"](spark, SF_SMALL)) == brute(rows)[0]


def test_bounds_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(4, 400))
        a = rng.integers(-1 << 62, 1 << 62, n)
        b = np.concatenate([a[: max(1, n - int(rng.integers(0, n // 6 + 1)))], rng.integers(-1 << 62, 1 << 62, int(rng.integers(0, n // 6 + 1)))])
        x, y = np.unique(a), np.unique(b)
        apart = len(np.setxor1d(x, y))
        assert jaccard_join._least_difference(jaccard_join._sketch(x), jaccard_join._sketch(y)) <= apart
        same = len(np.intersect1d(x, y))
        if 5 * same >= 4 * (len(x) + len(y) - same) and apart:
            none = (np.empty(0, np.int64), np.empty(0, np.int64))
            for k in (1, 2):
                first = [set(jaccard_join._ordered(s, none, jaccard_join.part_length(s.size, k))[0].tolist()) for s in (x, y)]
                assert len(first[0] & first[1]) >= k


def test_a_cloud_of_sets_just_below_and_above_the_similarity(spark):
    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for n in range(120):  # one to four edits each: about half of the pairs are linked
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(words[: 150 - rng.randrange(12)])))
    want, links = brute(rows)
    assert 300 < links < 6000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for long_list, block_rows in ((2, 16), (10**6, 16)):
        assert got(jaccard_join.jaccard_components(docs, long_list=long_list, block_rows=block_rows)) == want


def test_pairs_of_a_list_are_all_that_the_bounds_allow():
    rng = np.random.default_rng(2)
    base = rng.integers(-1 << 62, 1 << 62, 90)
    sets = [np.unique(np.concatenate([base[rng.random(90) < 0.93], rng.integers(-1 << 62, 1 << 62, int(rng.integers(0, 14)))])) for _ in range(60)]
    n = np.array([s.size for s in sets])
    at, label = rng.integers(0, 5, 60), np.arange(60) // 2
    sketches = [jaccard_join._folded(jaccard_join._sketch(s), 16) for s in sets]
    for block in (np.zeros(60, int), np.arange(60) % 2):
        a, b = jaccard_join._promising_pairs(np.arange(60), n, at, label, block, sketches)
        found = {(min(x), max(x)) for x in zip(a.tolist(), b.tolist(), strict=True)}
        assert len(found) == a.size
        linked = {(i, j) for j in range(60) for i in range(j) if label[i] != label[j] and (block[0] == block[1] or block[i] != block[j])
                  and 5 * np.intersect1d(sets[i], sets[j]).size >= 4 * np.union1d(sets[i], sets[j]).size
                  and 9 * min(n[i] - at[i], n[j] - at[j]) >= 4 * (n[i] + n[j])}
        assert linked and linked <= found


def test_boundary_goes_by_cost():
    sizes = {n: 100 for n in range(5, 60)}
    assert jaccard_join.choose_boundary(sizes, 0.0, 0.0) < jaccard_join.choose_boundary(sizes, 20.0, 0.0)
    assert jaccard_join.choose_boundary({}, 1.0, 1.0) == 0


def test_words_of_a_batch():
    odd = pa.array(["a b  c", None, "", " x ", "é À\x0bb", "A" * 100 + " q", "end", " ", "w-1_2"])
    for kind, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (TERMS, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        for column in (odd, odd.slice(1, 5), odd.slice(0, 0)):
            data, bounds = text_bytes(column)
            starts, ends, first = find_words(data, bounds, kind)
            hashes = hash_words(data, starts, ends)
            for i, text in enumerate(column.to_pylist()):
                want = re.findall(pattern, (text or "").translate(LOWER))
                mine = range(first[i], first[i + 1])
                assert [bytes(data[starts[k]:ends[k]]).decode() for k in mine] == want
                assert [int(hashes[k]) for k in mine] == [hash_word(w) for w in want]


def test_order_and_boundary_of_all_documents(spark):
    """the order's counts, the sizes and the meetings come from every document, not from a sample."""
    rows = [(i, f"of the people in state {i} x{i} y{i} z{i}") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    (usual, counts), sizes = jaccard_join._common(docs, 5)
    assert sizes == {5: 30_000} and counts.sum() == 150_000
    common = next(jaccard_join.shingle_sets(pa.array(["of the people in state"])))
    own = next(jaccard_join.shingle_sets(pa.array([rows[7][1]])))
    first, often = jaccard_join._ordered(own, (usual, counts), 5)
    assert first[-1] == common[0] and often[-1] == counts[common[0] & (counts.size - 1)] - usual[0] >= 30_000 - usual[0]
    assert 0 <= jaccard_join._boundary(docs, (usual, counts), sizes, 5) <= jaccard_join.LARGEST_LIGHT

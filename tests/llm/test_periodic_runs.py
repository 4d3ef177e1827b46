"""Periodic runs against a definition that tries every period at every place."""

import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest

from caselake.llm import periodic_runs
from caselake.llm.common import prepare
from caselake.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, least=24):
    """By definition: each longest stretch of period q, if no smaller period of it exists."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 3 * q):
                # a smaller period of the stretch would divide q, and was met before
                if (i, length) not in found:
                    found[i, length] = q
            i = max(j, i) + 1
    return sorted(((i, length, q) for (i, length), q in found.items()), key=lambda r: (r[0], r[2]))


def ids_of(words):
    code = {}
    return np.array([code.setdefault(w, len(code)) for w in words], dtype=np.uint64)


@pytest.mark.parametrize("least", [6, 24])
def test_runs_are_those_of_the_definition(least):
    rng = random.Random(least)
    met = 0
    for turn in range(600):
        words = []
        while len(words) < rng.choice([0, 5, 30, 90, 200]):
            part = rng.choices("abc" if turn % 2 else [f"w{k}" for k in range(60)], k=rng.choice([1, 1, 2, 3, 7, 8, 9, 15, 16, 17, 30]))
            words += part * rng.choice([1, 1, 2, 3, 4, 20]) + part[:rng.randrange(len(part))]
            if rng.random() < 0.3:
                words[-3:] = rng.choices("abcd", k=2)
        want = brute_runs(words, least)
        met += len(want)
        assert periodic_runs.find_runs(ids_of(words), least) == want, words
    assert met > 300


def test_one_word_over_and_over_is_one_run():
    assert periodic_runs.find_runs(np.zeros(200_000, dtype=np.uint64)) == [(0, 200_000, 1)]
    nested = (["a"] * 30 + ["b"]) * 40
    assert periodic_runs.find_runs(ids_of(nested)) == brute_runs(nested)


def repeated(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_report(doc_id, text):
    words = repeated(doc_id, words_of(text))
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha256(said.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_periodic_runs"](spark, SF_SMALL)
    assert got.columns == NAMES and [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = sorted(brute_report(r["doc_id"], r["text"]) for r in docs if len(r["text"]) < 30_000)
    ids = {r[0] for r in want}
    found = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(found) == len(docs) and sorted(found[i] for i in ids) == want
    assert sum(r[1] for r in want) > 10


def test_edge_rows(spark, tmp_path):
    long = "Überlange Zeile mit vielen Wörtern und 123 Zahlen. " * 400
    rows = [(i, t) for i in (8, 16, 25, None) for t in (None, "", " \n\t ", "one", "a b c d", long, long, "x " * 30 + "é " * 50, "漢字 \x0b" * 24)]
    tenth = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, t) for i in tenth for t in (None, "", "one", "a b c d", " ".join(map(str, range(90))))]
    assert len(tenth) > 2
    docs = spark.createDataFrame([(i, t, 1, "r", 0) for i, t in rows], "doc_id long, text string, length int, runs string, period int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted((brute_report(i, t) for i, t in rows), key=key)
    collapsed = {r["doc_id"]: r["collapsed"] for r in periodic_runs.collapse_runs(docs.where("text LIKE 'x x%'")).collect()}
    assert set(collapsed.values()) == {"x é"}
    assert periodic_runs.collapse_runs(docs.where("doc_id = -1")).count() == 0

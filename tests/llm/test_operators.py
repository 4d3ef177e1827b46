"""The operators against brute force, on edge rows and on the small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caselake.llm import chat, decontaminate, langid, licenses, packing, pipeline_stages, secret_scan, sharding, simhash_dedup, token_files, winnowing
from caselake.llm.common import prepare
from caselake.llm.components import connected_components
from caselake.llm.queries import QUERIES
from caselake.session import scratch_path
from tests.conftest import SF_SMALL

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = "Überlange Zeile mit vielen Wörtern und 123 Zahlen. " * 400
# Null ids and texts, empty texts, ties, repeated rows and names that operators use inside.
EDGES = [(1, "a b c d"), (2, None), (3, ""), (4, LONG), (4, LONG), (None, "a b c d"), (None, None), (5, " \n\t "), (6, "éà 漢字 <|endoftext|> İ"),
         (7, "a b c d"), (8, LONG + "x")]


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "x", 1, 2, "fp", "de", "src") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, fp int, size int, row string, lang string, source string")


@pytest.fixture(scope="module")
def empty(edges):
    return edges.where("doc_id = -1")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def docs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ── Components and SimHash ──

def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == brute_components({x for p in pairs for x in p}, pairs)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
@pytest.mark.parametrize("members", [3, 4096])
def test_links_have_the_components_of_all_pairs(spark, radius, members):
    if members == 3 and radius > 3:
        pytest.skip("the star enumeration of a radius of 5 is too much for a test")
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for base in list(fps)[:6]:
        for _ in range(12):
            x = base
            for _ in range(rng.randrange(1, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, 1, 7, 15, (1 << 64) - 1}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
    found = simhash_dedup.link_edges(spark.createDataFrame([(x,) for x in signed], "fp long"), radius, members).collect()
    assert brute_components(signed, [tuple(r) for r in found]) == brute_components(signed, near)


def brute_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("source", ["edges", "small"])
def test_near_duplicates(request, source):
    df = request.getfixturevalue(source)
    rows = docs_of(df)
    prints = [brute_simhash(t) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = brute_components(range(len(rows)), linked)
    low = defaultdict(list)
    for n, r in root.items():
        if rows[n][0] is not None:
            low[r].append(rows[n][0])
    want = Counter((rows[n][0], prints[n], min(low[r], default=None)) for n, r in root.items())
    assert Counter((r[0], r[1] % (1 << 64), r[2]) for r in simhash_dedup.near_duplicates(df).collect()) == want


# ── Secrets ──

BASE_PATTERNS = (("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?i:passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
                 ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))


def brute_base(text):
    spans = [(m.start(), n, m.end(), kind) for n, (kind, p, g, least) in enumerate(BASE_PATTERNS)
             for m in re.finditer(p, text or "") if len(m[g]) >= least]
    return sorted(spans)


SECRETS = [
    (1, 'x password = "hunter22" token:abc secret=token:abcdefgh API_KEY : abcdef'), (2, "AKIA" + "A1" * 10 + " AKIASHORT AKIAAKIA" + "Z" * 16),
    (3, "é漢 deadbeef" * 2 + " " + "0123456789abcdef" * 3), (4, None), (5, ""),
    (6, "user: alice01 pass: S3cretpass at https://db.example.com/x"), (7, "user: alice01 and nothing else https://a.example.com/y"),
    (8, "user: alice01 " + "-" * 500 + " pass: S3cretpass"), (9, "host=db1.example.com"), (6, "user: alice01 pass: S3cretpass at https://db.example.com/x"),
    (10, "client_id=abc123 secret=abcdefghij"), (11, "password=İabcdef TOKEN='" + "q" * 50000 + "'"),
]


def test_base_spans(spark, small):
    odd = spark.createDataFrame(SECRETS, "doc_id long, text string")
    for df in (odd, small):
        want = Counter()
        for i, t in docs_of(df):
            spans = brute_base(t)
            text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
            n = Counter(k for *_, k in spans)
            want[i, n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest()] += 1
        assert Counter(tuple(r)[:5] for r in secret_scan.scan_report(df).collect()) == want


def test_weak_parts_need_their_complements(spark, empty):
    rows = secret_scan.scan_report(spark.createDataFrame(SECRETS, "doc_id long, text string")).collect()
    kinds = defaultdict(list)
    for r in rows:
        kinds[r["doc_id"]].append(re.findall(r"[a-z]+", r["spans"]))
    assert kinds[6] == [["user", "pass", "endpoint"]] * 2
    assert kinds[7] == kinds[8] == kinds[9] == [[]]
    assert kinds[10] == [["user", "assign"]]
    assert secret_scan.scan_secrets(empty).count() == 0


def test_long_values_are_whole_spans_and_find_their_complement(spark):
    key = "Ab1+/" * 800
    rows = [(1, f"private_key: {key} login=alice01"), (2, f"login={'a' * 3000} auth={key}"),
            (3, f"https://h.example.com/{'p/' * 2000} user=bob pwd={key}"), (4, f"host=h{'.x' * 2000} pwd=secret99 user=bob")]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert " ".join(text[s["start"]:s["end"]] for s in got[i] if s["rank"] >= len(secret_scan.BASE)) == text


# ── Decontamination ──

def test_matches_are_those_of_all_windows(spark):
    rng = random.Random(1)
    pool = [f"w{k}" for k in range(60)]
    items = [(n, " ".join(rng.choices(pool, k=rng.choice([3, 8, 20, 21, 40])))) for n in range(12)] + [(90, None), (91, ""), (92, "..."), (0, "solo")]
    docs = []
    for n in range(90):
        words = rng.choices(pool, k=rng.randrange(0, 60))
        item = items[rng.randrange(12)][1].split()
        if n % 2:
            for _ in range(rng.randrange(2)):
                item[rng.randrange(len(item))] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," for w in item]
        docs.append((n, " ".join(words)))
    docs += [(100, None), (101, ""), (None, items[5][1]), (102, items[5][1]), (102, items[5][1])]
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.benchmark_matches(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), pass_chars=300).collect()}
    exact, missed = set(), 0
    for i, t in docs:
        words = decontaminate.words_of(t)
        for n, item in items:
            w = decontaminate.words_of(item)
            k = min(5, len(w))
            best = max((decontaminate.similarity(w, words[a:a + len(w)], k) for a in range(len(words) - len(w) + 1)), default=0) if w else 0
            if best >= decontaminate.SIMILARITY:
                exact.add((i, n))
                if (i, n) not in got:
                    missed += 1  # a window at 0.8 may lie beyond the Hamming radius
                elif best == 1:
                    r = got[i, n]
                    assert decontaminate.words_of(t[r["start"]:r["end"]]) == w and r["similarity"] == 1 and r["hamming"] == 0
    assert set(got) <= exact and missed <= 0.05 * len(exact) and len(exact) > 15


def test_long_replacement_words_hide_no_item(spark):
    rng = random.Random(4)
    pool = [f"w{k}" for k in range(400)]
    items = [(n, " ".join(rng.choices(pool, k=rng.choice([3, 12, 30, 60])))) for n in range(30)]
    items += [(100 + n, " ".join(items[0][1].split() + rng.choices(pool, k=25))) for n in range(5)]
    docs = []
    for n in range(150):
        item = items[n % len(items)][1].split()
        for _ in range(rng.randrange(3)):
            item[rng.choice([0, -1, rng.randrange(len(item))])] = "x" * rng.choice([1, 40, 64, 300])
        docs.append((n, " ".join(rng.choices(pool, k=rng.randrange(40)) + item + rng.choices(pool, k=rng.randrange(40)))))
    exact = set()
    for i, t in docs:
        words = decontaminate.words_of(t)
        for n, item in items:
            w = item.split()
            if any(decontaminate.similarity(w, words[a:a + len(w)], min(5, len(w))) >= decontaminate.SIMILARITY for a in range(len(words) - len(w) + 1)):
                exact.add((i, n))
    got = decontaminate.benchmark_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["hamming"] for r in got.collect()}
    assert set(found) == exact and max(found.values()) > decontaminate.RADIUS


def test_multi_index_misses_nothing_within_the_radius():
    rng = random.Random(2)
    index = decontaminate.BenchmarkIndex([(n, " ".join(f"u{n}x{k}" for k in range(10))) for n in range(50)])
    prints, want = [], set()
    for n, p in enumerate(index.prints):
        for far in (0, 7, 19, 20):
            x = int(p)
            for b in rng.sample(range(64), far):
                x ^= 1 << b
            if far <= 19:
                want.add((len(prints), n))
            prints.append(x)
    window, item = index.lookup(np.array(prints, dtype=np.uint64), np.full(len(prints), 10))
    assert want <= set(zip(window.tolist(), item.tolist(), strict=True))


# ── Tokens, files, packing ──

@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(TOKENIZER)


def ids_of(plain, text, end):
    return plain.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
@pytest.mark.parametrize("source", ["edges", "small", "empty"])
def test_token_files(spark, request, plain, source, encoding):
    df = request.getfixturevalue(source)
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(df, path, TOKENIZER, 2, encoding)
    rows = sorted(docs_of(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = Counter(), 0
    for i, t in rows:
        ids = ids_of(plain, t, 2)
        want[i, at, len(ids), crc(ids)] += 1
        at += len(ids)
    files = token_files.read_token_files(spark, path)
    assert Counter(tuple(r) for r in token_files.token_digests(files).collect()) == want
    one = files.where("doc_id = 3").select("tokens")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,3)]" in one._jdf.queryExecution().toString()


@pytest.mark.parametrize("source", ["edges", "small", "empty"])
def test_packing(request, plain, source):
    df = request.getfixturevalue(source)
    rows = packing.pack_documents(df, TOKENIZER).collect()
    want = Counter()
    for i, t in docs_of(df):
        ids = ids_of(plain, t, 1)
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[i, k, at, len(ids[at:at + 4096]), crc(ids[at:at + 4096])] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 4096
    total = sum(r["length"] for r in rows)
    assert len(bins) <= -(-total // 4096) * 1.02 + 1


def test_packed_sequences_hold_the_ids(edges, plain):
    got = packing.packed_sequences(edges, TOKENIZER).collect()
    assert Counter(x for r in got for x in r["ids"]) == Counter(x for _, t in docs_of(edges) for x in ids_of(plain, t, 1))


def test_plan_covers_every_piece_and_meets_the_bound():
    rng = np.random.default_rng(0)
    for size in (rng.integers(1, 4097, 5000), rng.integers(1000, 2500, 5000), np.full(300, 1500), np.array([4096] * 5 + [1])):
        histogram = np.bincount(size, minlength=4097)
        plan = packing.make_plan(histogram)
        assert plan.bins >= plan.bound - 1e-6
        best = sum(n for _, n in packing.best_fit(histogram))
        assert plan.bins <= 1.01 * best + 1


def test_plan_beats_best_fit_where_that_fails():
    """Three lengths that fill a sequence together: taken longest first, two of the longest block it."""
    histogram = np.zeros(4097, dtype=np.int64)
    histogram[[1709, 1367, 1020]] = 2000
    plan = packing.make_plan(histogram)
    assert sum(n for _, n in packing.best_fit(histogram)) >= 2200
    assert plan.bins <= 2020 and plan.bound >= 1999.9


def test_knapsack_is_optimal():
    rng = random.Random(3)
    weight = np.array([0.0] + [rng.choice([0, rng.random()]) for _ in range(20)])
    best, _ = packing.knapsack(weight)
    table = [0.0] * 21
    for c in range(1, 21):
        table[c] = max([0.0] + [table[c - k] + weight[k] for k in range(1, c + 1) if weight[k]])
    assert all(best[c] <= table[c] + 1e-9 for c in range(21)) and best[20] == pytest.approx(max(table))


# ── Winnowing ──

def brute_winnow(grams, w):
    """(position, hash) by the definition: of each window the least rank, the rightmost of equals."""
    rank = [(g >> 31, -i) for i, g in enumerate(grams)]
    windows = [range(s, s + w) for s in range(len(grams) - w + 1)] if len(grams) > w else [range(len(grams))]
    return sorted({min(x, key=lambda i: rank[i]) for x in windows})


@pytest.mark.parametrize("w", [1, 4, 7, 16])
def test_winnowing_selects_by_definition(spark, w):
    rng = random.Random(w)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (1, 4, 5, 6, 12, 40, 200)] + ["漢字かな交じり文です", "...", "  "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    single = f"(?:{winnowing._SINGLE})"
    for text, got in df.select("text", winnowing.fingerprint(F.col("text"), 5, w)).collect():
        words = re.findall(rf"{single}|[^\W_]+", text)
        pos = [p["pos"] for p in got]
        if len(words) < 5:
            assert pos == [0]
            continue
        seen = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        hashes = spark.createDataFrame([s for s in seen], "a string, b string, c string, d string, e string").select(
            "*", F.xxhash64("a", "b", "c", "d", "e").alias("h")).distinct().collect()
        by = {tuple(r)[:5]: r["h"] for r in hashes}
        assert pos == brute_winnow([by[s] for s in seen], w)
        assert [p["hash"] for p in got] == [by[seen[p]] for p in pos]


@pytest.mark.parametrize("source", ["edges", "small", "empty"])
def test_edited_neighbours(request, source):
    df = request.getfixturevalue(source)
    rows = sorted(((i, t or "") for i, t in docs_of(df)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = Counter()
    for n, (i, t) in enumerate(rows):
        half = len(t) // 2
        want[i, t, t[:len(t) - half] + rows[(n + 1) % len(rows)][1][:half]] += 1
    got = winnowing.fingerprint_neighbours(df).withColumn("like", winnowing.likeness(F.col("prints"), F.col("edited_prints"))).collect()
    assert Counter((r["doc_id"], r["text"], r["edited"]) for r in got) == want
    assert all(0 <= r["like"] <= 1 and (r["text"] != r["edited"] or r["like"] == 1) for r in got)
    by = {r["text"]: r["prints"] for r in got}
    assert all(r["prints"] == by[r["text"]] for r in got)


def test_range_number(spark):
    bounds = [-5, 0, 3, 4, 10, 11, 50]
    df = spark.createDataFrame([(x,) for x in (None, -6, -5, -1, 0, 3, 9, 10, 11, 49, 50, 99)], "x long")
    for x, n in df.select("x", winnowing.range_number(F.col("x"), bounds)).collect():
        assert n == (0 if x is None else sum(b <= x for b in bounds))


# ── Sharding ──

@pytest.mark.parametrize("source", ["edges", "small", "empty"])
def test_shards(request, source):
    df = request.getfixturevalue(source)
    rows = sharding.assign_shards(df, 4, carry=("text",)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(docs_of(df))
    for r in rows:
        body = (r["text"] or "").encode()
        assert r["size"] == len(body) + 8 and r["text_crc32"] == zlib.crc32(body)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) and 0 <= k < 4 for k, s in slots.items())
    if source == "small":
        load = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(4)]
        assert max(load) - min(load) <= 2 * max(r["size"] for r in rows)


def test_hot_group_is_split_evenly(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, F.lit("same text")).otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    load = Counter()
    for r in sharding.assign_shards(df, 8).collect():
        load[r["shard"]] += r["size"]
    assert len(load) == 8 and max(load.values()) <= 1.05 * min(load.values())


# ── Chat ──

def test_branches_are_ranked(spark):
    rows = [(1, 1, None, 0.0, "user", "root"), (1, 2, 1, 5.0, "assistant", "good <x> # \\0"), (1, 3, 1, 1.0, "assistant", "bad"),
            (1, 4, 2, 1.0, "user", None), (1, 5, 3, 9.0, "user", "saves the bad branch"), (1, 6, 5, 0.0, "Assistant", "end"),
            (2, 1, 2, 0.0, "user", "on a"), (2, 2, 1, 0.0, "user", "cycle"), (3, 7, 99, 0.0, None, "orphan"), (4, 1, None, 1.0, "a: b", "")]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string")
    got = {(r["tree"], r["branch"]): r for r in chat.format_conversations(nodes, best=2).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    turns = {k: [tuple(t) for t in r["turns"]] for k, r in got.items()}
    assert turns == {(1, 6): [("user", "root"), ("assistant", "bad"), ("user", "saves the bad branch"), ("Assistant", "end")],
                     (1, 4): [("user", "root"), ("assistant", "good <x> # \\0"), ("user", "")], (3, 7): [("", "orphan")], (4, 1): [("a: b", "")]}
    assert got[1, 4]["loss"] == "good <x> # \\0" and got[1, 6]["loss"] == "badend" and got[3, 7]["loss"] == ""
    assert {k for k in chat.format_conversations(nodes).select("tree", "branch").collect()} == {(1, 6), (3, 7), (4, 1)}
    assert chat.format_conversations(nodes.where("tree = 0")).count() == 0


def test_conversations_come_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 1, "assistant", "tie"), (2, 0, None, None)]
    rows += [(3, k, "user" if k % 2 == 0 else "assistant", f"turn {k} </turn>\n### user: ") for k in range(70)] + [(4, 0, "user", "x"), (4, 0, "user", "x")]
    nodes = chat.conversation_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = chat.format_conversations(nodes).select("tree", chat.read_turns(F.col("formatted")), chat.masked_text(F.col("formatted"), F.col("mask"))).collect()
    want = defaultdict(list)
    for c, k, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert {c: [tuple(t) for t in turns] for c, turns, _ in got} == dict(want)
    assert {c: loss for c, _, loss in got} == {c: "".join(t for r, t in turns if r == "assistant") for c, turns in want.items()}


def test_rows_without_a_conversation_are_one_conversation(spark):
    rows = [(None, 0, "user", "hi"), (None, 1, "assistant", "ho"), (None, 2, "user", "hm"), (1, 0, "user", "x"), (0, 0, "user", "y")]
    nodes = chat.conversation_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["tree"]: [tuple(t) for t in r["turns"]] for r in chat.format_conversations(nodes).select(
        "tree", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: [("user", "hi"), ("assistant", "ho"), ("user", "hm")], 1: [("user", "x")], 0: [("user", "y")]}


# ── Language and licences ──

def test_languages(spark, small, edges, empty):
    model = langid.train_text_model(small)
    rows = {r["doc_id"]: r for r in langid.identify_languages(small, model, declared=F.col("lang"), address=F.col("source")).collect()}
    truth = {r["doc_id"]: r["lang"] for r in small.collect()}
    assert len(rows) == len(truth)
    assert sum(rows[i]["lang"] == lang and rows[i]["accepted"] for i, lang in truth.items()) >= 0.98 * len(truth)
    odd = langid.identify_languages(edges, model, declared=F.col("lang"), address=F.col("source")).collect()
    assert len(odd) == len(EDGES)
    assert not any(r["accepted"] for r in odd if r["text_lang"] is None) and all(0 < r["posterior"] <= 1 for r in odd)
    assert langid.identify_languages(empty, model).count() == 0
    assert langid.identify_languages(small, langid.train_text_model(empty)).where("accepted").count() == 0


def test_every_label_is_a_language(spark):
    rows = []
    for n in range(90):
        letters = [chr(0x4E00 + 40 * n + k) for k in range(40)]
        rng = random.Random(n)
        rows += [(1000 * n + k, "".join(rng.choices(letters, k=200)), f"l{n:02d}") for k in range(3 + (n < 64))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify_languages(df, langid.train_text_model(df)).collect()}
    assert all(got[i]["lang"] == lang and got[i]["accepted"] for i, _, lang in rows) and len(got) == len(rows)


def test_host_and_declaration_decide_a_doubtful_text(spark):
    rows = [(n, "the and of with that this from", "en", "http://news.example.com/a") for n in range(60)]
    rows += [(100 + n, "le la des les une dans pour que", "fr", "http://journal.example.fr/b") for n in range(60)]
    rows += [(900, "xa", "fr", "http://journal.example.fr/c"), (901, "xa", "en", "https://news.example.com:80/d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string")
    got = {r["doc_id"]: r["lang"] for r in langid.identify_languages(
        df, langid.train_text_model(df), declared=F.col("lang"), address=F.col("url")).collect()}
    assert got[900] == "fr" and got[901] == "en" and got[0] == "en" and got[100] == "fr"


def test_page_helpers(spark):
    html = "<!DOCTYPE html><HTML lang='fr-CA'><style>p{x}</style><script>var t='</p>';</script><p>Bon&amp;jour</p><!-- x -->"
    row = spark.createDataFrame([(html,), (None,), ("",)], "h string").select(langid.html_language(F.col("h")), langid.html_words(F.col("h"))).collect()
    assert row[0][0] == "fr" and row[0][1].split() == ["Bon", "jour"] and row[1] == (None, None) and row[2][0] is None


@pytest.fixture(scope="module")
def licence_model(small):
    return licenses.train_licence_model(small)


def test_licences(spark, licence_model, edges, empty):
    model = licence_model
    lines = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.",
             "This work is licensed under the GNU General Public License, version 3.", "All rights reserved, copyright Example Corp.",
             "You need a license to drive here."]
    df = spark.createDataFrame([(n, f"Some text before.\n{line}\nand after") for n, line in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"]: (r["paragraph"], r["family"]) for r in licenses.scan_licences(df, model).collect() if r["line"] is not None}
    want = ["mit", "cc-by-nc", "apache-2.0", "gpl", "unknown", "unknown"]
    assert {n: got.get(n, (1, "unknown")) for n in range(len(lines))} == dict(enumerate((1, f) for f in want))
    assert licenses.scan_licences(edges, model).count() == 0 and licenses.scan_licences(empty, model).count() == 0
    bare = licenses.train_licence_model(empty, copies=8)
    assert licenses.scan_licences(df, bare, only_possible=False).where("line IS NOT NULL").count() == 3 * len(lines)


WRAPPED = {
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.example/MPL/2.0/.",
    "bsd": "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the following conditions\n// are met:",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice appears in all copies.",
    "mit": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the Software), to deal.",
}


def test_wrapped_notices_are_found(spark, licence_model):
    model = licence_model
    rows = [(n, f"Prose before it.\n\n{text}\n\nProse after it.", family) for n, (family, text) in enumerate(WRAPPED.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lines string")
    got = {r["doc_id"]: r["family"] for r in licenses.scan_licences(df, model).where("family <> 'unknown'").collect()}
    assert got == {n: family for n, _, family in rows}


def test_what_is_not_scored_could_not_be_confirmed(spark, small, licence_model):
    """Every paragraph scored gives the same families as those that may match."""
    rng = random.Random(3)
    model = licence_model
    rows = []
    for n in range(400):
        family, template = rng.choice([(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts])
        own = template.split(" ")
        kept = [w for w in own if rng.random() < rng.choice([0.5, 0.7, 0.9, 1.0])] or own
        rows.append((n, " ".join([*rng.choices(["word", "text", "the", "of", "ille"], k=rng.randrange(6)), *kept])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(small.where("doc_id < 12").select("doc_id", "text"))
    cols = ["doc_id", "paragraph", "line", "part", "family", "template", "share"]
    sure = [Counter(tuple(r) for r in licenses.scan_licences(docs, model, only_possible=p).where("family <> 'unknown'").select(*cols).collect()) for p in (True, False)]
    assert sure[0] == sure[1] and sum(sure[0].values()) > 150
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            left = [g for g in licenses._template_grams(t) if not any(w in g for w in licenses.TELLING)]
            assert len(left) < licenses.TEMPLATE_SHARE * len(licenses._template_grams(t)), (family, t)


def test_licence_probabilities_are_calibrated_on_held_out_rows(spark, licence_model):
    """Accuracy and calibration on notices with words left out by another draw than in training."""
    rng = random.Random(11)
    model = licence_model
    rows = []
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            for _ in range(6):
                kept = [w for w in t.split(" ") if rng.random() > 0.08]
                rows.append((len(rows), " ".join([*rng.choices(["lorem", "ipsum", "dolor"], k=rng.randrange(4)), *kept]), family))
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["family"], r["probability"]) for r in licenses.scan_licences(df, model).collect()}
    right = [got.get(i, ("unknown", 1.0))[0] == family for i, _, family in rows]
    recall = sum(right) / len(right)
    wrong = sum(got.get(i, ("unknown", 1.0))[0] not in (family, "unknown") for i, _, family in rows) / len(rows)
    said = sum(got.get(i, ("unknown", 1.0))[1] for i, _, _ in rows) / len(rows)
    print(f"licences: recall {recall:.3f}, wrong family {wrong:.3f}, mean probability {said:.3f}")
    assert recall >= 0.85 and wrong <= 0.05 and abs(said - recall) < 0.15


def test_queries_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10 and "pipeline" in QUERIES


# ── Pipeline stages ──

def test_near_dedup_stage_keeps_one_row_of_each_simhash_class(spark):
    rng = random.Random(8)
    pool = [f"v{k}" for k in range(3000)]
    texts = []
    for _ in range(60):
        base = rng.choices(pool, k=rng.choice([2, 7, 120, 300, 900]))
        texts.append(base)
        for _ in range(rng.randrange(5)):
            near = list(rng.choice([base, texts[-1]]))
            near[rng.randrange(len(near))] = "other"
            texts.append(near)
    rows = [(n, " ".join(w)) for n, w in enumerate(texts)] + [(9000, None), (9001, " ")]
    prints = [simhash_dedup.simhash(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    assert sum(prints[a] != prints[b] for a, b in pairs) > 20
    want = set(brute_components(range(len(rows)), pairs).values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in pipeline_stages.keep_one_per_group(spark, docs, "").collect()]
    assert sorted(kept) == sorted(rows[n][0] for n in want)


@pytest.mark.parametrize("name", ["keep_identified", "keep_one_per_group", "keep_uncontaminated", "keep_secret_free"])
def test_stages_return_every_column_and_take_empty_tables(spark, edges, empty, name):
    stage_of = getattr(pipeline_stages, name)
    clashing = edges.withColumn("class", F.lit("c")).withColumn("row_", F.lit(1)).withColumn("spans", F.lit("s"))
    got = stage_of(spark, clashing, SF_SMALL)
    assert got.columns == clashing.columns and got.dtypes == clashing.dtypes
    assert {r["row"] for r in got.collect()} <= {"fp"}
    assert stage_of(spark, empty, SF_SMALL).count() == 0


def test_rows_of_files_are_numbered_where_they_lie(spark, edges, tmp_path):
    for n, part in enumerate((edges, edges.where("doc_id > 3"), edges.where("doc_id = -1"))):
        part.coalesce(1).write.parquet(str(tmp_path / f"t/part={n}"))
    rows = spark.read.schema(edges.schema).parquet(*[str(tmp_path / f"t/part={n}") for n in range(3)])
    numbered, name = pipeline_stages._numbered(rows)
    assert name == "row_" and numbered.columns == [*rows.columns, "row_"]
    first, again = (sorted((r["row_"], r["doc_id"] or -1, r["text"] or "") for r in x.collect()) for x in (numbered, numbered.repartition(5)))
    assert first == again and len({r[0] for r in first}) == len(first) == rows.count()
    assert "FileScan" in numbered._jdf.queryExecution().executedPlan().toString()
    hidden, _ = pipeline_stages._numbered(rows.withColumnRenamed("source", "_metadata"))
    assert hidden.count() == rows.count()


def test_pack_stage_takes_edge_rows_and_empty_tables(spark, edges, empty):
    rows = pipeline_stages.pack_kept(spark, edges, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(i for i, _ in EDGES)
    assert pipeline_stages.pack_kept(spark, empty, SF_SMALL).count() == 0


def test_stages_decide_by_row(spark):
    rng = random.Random(9)
    prose = lambda: " ".join(rng.choices([f"w{k}" for k in range(500)], k=40))
    copied, clean, item = prose(), prose(), " ".join(f"item{k}" for k in range(20))
    docs = spark.createDataFrame([(2, copied), (None, copied), (3, copied), (3, clean), (None, prose()), (None, item), (4, item), (4, prose()),
                                  (None, "token=abcdefgh"), (5, "token=abcdefgh"), (5, prose())], "doc_id long, text string")

    def kept(stage_of, rows, sf_dir=""):
        return Counter((r["doc_id"], r["text"]) for r in stage_of(spark, rows, sf_dir).collect())

    of = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    once = kept(pipeline_stages.keep_one_per_group, docs)
    assert once == Counter({k: n for k, n in of.items() if k not in ((None, copied), (3, copied), (None, item), (None, "token=abcdefgh"))})
    assert kept(pipeline_stages.keep_secret_free, docs) == Counter({k: n for k, n in of.items() if "token=" not in k[1]})
    sf_dir = scratch_path(spark, "test-stage")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    assert kept(pipeline_stages.keep_uncontaminated, docs, sf_dir) == Counter({k: n for k, n in of.items() if k[1] != item})
    spoken = docs.selectExpr("doc_id", "CASE WHEN text LIKE 'token%' THEN '123' ELSE text END AS text", "'en' AS lang", "'' AS source")
    assert sum(kept(pipeline_stages.keep_identified, spoken).values()) == 9

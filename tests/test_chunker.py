"""Chunker contract: edge rows, cross-implementation agreement and properties."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caselake.functions.chunking import (
    _units,
    chunk_text,
    fixed_chunks,
    legal_chunks,
    legal_chunks_native,
    paragraph_chunks,
    recursive_chunks,
)
from tests.conftest import SF_MID


def spark_chunks(spark, texts, native):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    fn = legal_chunks_native if native else legal_chunks
    return [r[0] for r in df.orderBy("i").select(fn("t")).collect()]


EDGE = [
    "", "   ", "x",
    "a" * 2998, "a" * 2999, "a" * 3000,
    "b" * 3001,
    "c" * 2000 + "\n\n" + "d" * 2000,
    "one\r\ntwo\r\n\r\nthree",
    "p1\n\n\n\np2",
]


def test_edge_rows_python():
    got = [chunk_text(t) for t in EDGE]
    assert got[0] == [] and got[1] == [] and got[2] == ["x"]
    assert [[len(x) for x in c] for c in got[3:6]] == [[2998], [2999], [3000]]
    assert got[6] == ["b" * 3001]
    first, second = got[7]
    assert first == "c" * 2000
    # the second chunk starts with the last 500 chars of the (unstripped) buffer
    assert second.startswith(("c" * 2000 + "\n\n")[-500:].strip()) and second.endswith("d" * 2000)
    assert got[8] == ["one\ntwo\n\nthree"]
    assert got[9] == ["p1\n\np2"]


def test_edge_rows_spark_agree(spark):
    want = [chunk_text(t) for t in EDGE]
    assert spark_chunks(spark, EDGE, native=False) == want
    assert spark_chunks(spark, EDGE, native=True) == want


def test_sentence_path_and_overlap():
    sent = "Alpha beta gamma. " * 400  # one long paragraph -> sentence units
    chunks = chunk_text(sent.strip())
    assert len(chunks) > 1
    assert all(len(c) <= 3000 + 500 for c in chunks)
    # every sentence unit lands in at least one chunk
    for unit, _ in _units(sent, 3000):
        assert any(unit in c for c in chunks)


def test_native_matches_arrow_on_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    both = docs.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    for df in (docs, both):
        diff = df.select(legal_chunks("text").alias("a"), legal_chunks_native("text").alias("b")).where("a <> b")
        assert diff.count() == 0


words = st.sampled_from(["Alpha", "beta.", "Gamma!", "delta?", "x" * 700, "End.", "y", ""])
seps = st.sampled_from([" ", "\n", "\n\n", "\n\n\n", "\r\n", "  "])
texts = st.lists(st.tuples(words, seps), max_size=60).map(lambda xs: "".join(w + s for w, s in xs))


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(min_value=50, max_value=400), st.integers(min_value=0, max_value=60))
def test_properties(text, size, overlap):
    chunks = chunk_text(text, size, overlap)
    units = _units(text, size)
    # empty input, no chunks; chunks are stripped and non-empty
    assert (not units) == (not chunks)
    assert all(c and c == c.strip() for c in chunks)
    # every unit's text is held whole by some chunk (units are never cut)
    for unit, _ in units:
        assert any(unit.strip() in c for c in chunks)
    # a chunk only exceeds size when carrying overlap plus one unit
    longest_unit = max((len(u) + len(s) for u, s in units), default=0)
    assert all(len(c) <= max(size, overlap + longest_unit) for c in chunks)


def test_python_semantics_against_spec():
    # chunk_text must equal a direct rendering of the written contract
    def spec(text, size=3000, overlap=500):
        text = re.sub(r"\n{3,}", "\n\n", re.sub(r"\r\n", "\n", text)).strip()
        if not text:
            return []
        out, cur = [], ""
        for p in re.split(r"\n\n+", text):
            p = p.strip()
            if not p:
                continue
            pieces = re.split(r"(?<=[.!?])\s+(?=[A-Z])", p) if len(p) > size else [p]
            sep = " " if len(p) > size else "\n\n"
            for u in pieces:
                if len(cur) + len(u) + len(sep) <= size:
                    cur += u + sep
                else:
                    if cur.strip():
                        out.append(cur.strip())
                    cur = (cur[-overlap:] if len(cur) > overlap else cur) + u + sep
        if cur.strip():
            out.append(cur.strip())
        return out

    samples = EDGE + ["Sentence one. Sentence two! " * 300, ("para " * 100 + "\n\n") * 40]
    for t in samples:
        assert chunk_text(t) == spec(t)


def test_design_chunkers(spark):
    df = spark.createDataFrame([("abcdefghij",), ("",), ("p1\n\np2\n\n" + "q" * 20,)], "t string")
    fx = [r[0] for r in df.select(fixed_chunks("t", 4, 3)).collect()]
    assert fx[0] == ["abcd", "defg", "ghij", "j"] and fx[1] == []
    pc = [r[0] for r in df.select(paragraph_chunks("t", 12)).collect()]
    assert pc[2] == ["p1\n\np2", "q" * 20]
    rc = [r[0] for r in spark.createDataFrame([("a b c d e f g",)], "t string")
          .select(recursive_chunks("t", 3, 1)).collect()]
    assert rc[0] == ["a b c d e f g"]  # one unit is never split by the token budget
    rc2 = [r[0] for r in spark.createDataFrame([("a b\n\nc d\n\ne f",)], "t string")
           .select(recursive_chunks("t", 4, 1)).collect()]
    assert rc2[0] == ["a b c d", "d e f"]


def test_spans_are_where_the_chunks_lie():
    import random

    from caselake.functions.chunking import chunk_spans, chunk_text

    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices(["word ", "Long. Sentence here. ", "\n\n", "\r\n", "A", "é", "  ", "x" * 40], k=rng.choice([0, 3, 40, 200])))
        for size, overlap in ((60, 20), (60, 0), (300, 50)):
            packed, spans = chunk_spans(text, size, overlap)
            assert [packed[a:b] for a, b in spans] == chunk_text(text, size, overlap)
    assert chunk_spans(None) == ("", [])


def test_cuts_are_the_matches_that_no_chunk_holds(spark):
    import re

    from caselake.functions.chunking import _outside, chunk_spans, cut_matches
    from caselake.functions.text import CITATION_RE

    for cite in ("123 S.C. 456", "123 S.E.2d 456", "18 U.S.C. § 1030", "12 F. Supp. 345", "410 U. S. 113"):
        assert re.fullmatch(CITATION_RE, cite)
    text = " ".join(f"Sentence {10 ** (n % 7)} see 12 F. Supp. {n}." for n in range(60))
    rows = spark.createDataFrame([(1, text), (2, None), (3, "none")], "id long, text string")
    got = {r["id"]: (r["c"]["matches"], r["c"]["cuts"]) for r in rows.select("id", cut_matches("text", CITATION_RE, [(100, 50), (100, 0)]).alias("c")).collect()}
    assert got[2] == (0, [0, 0]) == got[3] and got[1][0] == 60 and got[1][1][0] == 0 < got[1][1][1]
    packed, spans = chunk_spans(text, 100, 0)
    at = [m.span() for m in re.finditer(CITATION_RE, packed)]
    assert got[1][1][1] == _outside(at, spans) == sum(not any(a <= s and e <= b for a, b in spans) for s, e in at)
    plan = rows.select(cut_matches("text", CITATION_RE, [(100, 50)]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan

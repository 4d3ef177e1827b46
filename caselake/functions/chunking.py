"""Text chunkers (Column -> array<string>), exploded by the caller with posexplode.

The main contract (F11) packs paragraph units, or sentence units of paragraphs
longer than ``size``, greedily into chunks; when a unit does not fit, the
buffer is emitted and its last ``overlap`` characters (the whole buffer if it
is shorter) start the next chunk. Chunks can exceed ``size`` by design.

Two interchangeable forms exist:
  * ``legal_chunks``        — Arrow-batched pandas UDF (faster, the default);
  * ``legal_chunks_native`` — a JVM ``aggregate`` fold, used as a cross-check.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from caselake.functions.text import (
    normalize_newlines,
    split_paragraphs,
    split_sentences,
    strip,
)
from caselake.session import release_memory

# ── Fixed values (the chunk contract: sizes, separators, patterns) ──────────
CHUNK_SIZE = 3000
CHUNK_OVERLAP = 500
PARAGRAPH_SEP = "\n\n"
SENTENCE_SEP = " "
_CRLF = re.compile(r"\r\n")
_MANY_LF = re.compile(r"\n{3,}")
_PARA_BREAK = re.compile(r"\n\n+")
_SENTENCE_BREAK = re.compile(r"(?<=[.!?])\s+(?=[A-Z])")
# ── End of fixed values ─────────────────────────────────────────────────────


def _units(text: str, size: int) -> list[tuple[str, str]]:
    """(unit, separator) pairs of a document after newline normalization."""
    text = _MANY_LF.sub("\n\n", _CRLF.sub("\n", text)).strip()
    out: list[tuple[str, str]] = []
    if not text:
        return out
    for para in _PARA_BREAK.split(text):
        para = para.strip()
        if not para:
            continue
        if len(para) > size:
            out.extend((s, SENTENCE_SEP) for s in _SENTENCE_BREAK.split(para))
        else:
            out.append((para, PARAGRAPH_SEP))
    return out


def chunk_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Pure-Python form of the F11 contract (per-row helper inside the Arrow UDF)."""
    if not text:
        return []
    units = _units(text, size)
    if not units:
        return []
    # Fast path: everything fits in one buffer -> one chunk, no fold needed.
    if sum(len(u) + len(s) for u, s in units) <= size:
        return ["".join(u + s for u, s in units).strip()]
    chunks: list[str] = []
    buf = ""
    for unit, sep in units:
        if len(buf) + len(unit) + len(sep) <= size:
            buf += unit + sep
            continue
        done = buf.strip()
        if done:
            chunks.append(done)
        carry = buf if len(buf) <= overlap else buf[len(buf) - overlap:]
        buf = carry + unit + sep
    last = buf.strip()
    if last:
        chunks.append(last)
    return chunks


def chunk_spans(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> tuple[str, list[tuple[int, int]]]:
    """(packed, spans): all units with their separators as one string, and the part of it that each chunk
    of F11 holds, as (start, end), blanks at its ends aside. A chunk that carries the last
    characters of the one before starts that much earlier."""
    units = _units(text, size) if text else []
    packed = "".join(u + s for u, s in units)
    spans, start, end = [], 0, 0

    def emit() -> None:
        held = packed[start:end]
        if held.strip():
            spans.append((end - len(held.lstrip()), start + len(held.rstrip())))

    for unit, sep in units:
        n = len(unit) + len(sep)
        if end - start + n > size:
            emit()
            start = end - min(overlap, end - start)
        end += n
    emit()
    return packed, spans


def legal_chunk_spans(col, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Where the chunks of F11 lie in the packed text: array<struct<start,end>>, one a chunk."""

    @pandas_udf("array<struct<start:int,end:int>>")
    def _spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b} for a, b in chunk_spans(t, size, overlap)[1]])

    return _spans(F.col(col) if isinstance(col, str) else col)


def cut_matches(col, pattern: str, settings: list[tuple[int, int]]) -> Column:
    """struct(matches, cuts): how many matches of the pattern the packed text holds, and for each
    (size, overlap) how many of them lie whole in no chunk.

    A match is compared with the chunks' spans, so where a cut is does not depend on what else the
    text says. Row by row: nothing is shuffled or joined. The packed text is that of the first
    setting's size, which decides what is split at sentences; all settings need that size."""
    if len({size for size, _ in settings}) != 1:
        raise ValueError("settings with one chunk size are compared")
    found = re.compile(pattern)

    @pandas_udf("matches int, cuts array<int>")
    def _cuts(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            cuts = []
            for size, overlap in settings:
                packed, spans = chunk_spans(text, size, overlap)
                at = [m.span() for m in found.finditer(packed)]
                cuts.append(_outside(at, spans))
            rows.append((len(at), cuts))
        return pd.DataFrame(rows, columns=["matches", "cuts"])

    return _cuts(F.col(col) if isinstance(col, str) else col)


def _outside(at: list[tuple[int, int]], spans: list[tuple[int, int]]) -> int:
    """How many of the ordered ranges ``at`` no span contains; starts and ends of spans both rise."""
    out, n = 0, 0
    for start, end in at:
        while n < len(spans) and spans[n][1] < end:
            n += 1
        # The first span that reaches the end starts earliest of all that do.
        out += n == len(spans) or spans[n][0] > start
    return out


def legal_chunks(col, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """F11 as an Arrow pandas UDF: one Arrow batch of texts per call."""

    @pandas_udf(ArrayType(StringType()))
    def _chunk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: chunk_text(t, size, overlap))
        release_memory()

    return _chunk(F.col(col) if isinstance(col, str) else col)


def _unit_structs(col, size: int) -> Column:
    """array<struct<u,sep>>: paragraph units, or sentence units of long paragraphs."""
    paras = split_paragraphs(normalize_newlines(col))
    per_para = F.transform(
        paras,
        lambda p: F.when(
            F.length(p) > F.lit(size),
            F.transform(
                split_sentences(p),
                lambda s: F.struct(s.alias("u"), F.lit(SENTENCE_SEP).alias("sep")),
            ),
        ).otherwise(F.array(F.struct(p.alias("u"), F.lit(PARAGRAPH_SEP).alias("sep")))),
    )
    return F.flatten(per_para)


def _emit(chunks: Column, buf: Column) -> Column:
    done = strip(buf)
    return F.when(done != F.lit(""), F.array_append(chunks, done)).otherwise(chunks)


def legal_chunks_native(col, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """F11 as a JVM ``aggregate`` fold over the unit array (no Python)."""
    c = F.col(col) if isinstance(col, str) else col
    init = F.struct(
        F.array().cast("array<string>").alias("chunks"),
        F.lit("").alias("buf"),
    )

    def step(acc, x):
        fits = F.length(acc.buf) + F.length(x.u) + F.length(x.sep) <= F.lit(size)
        # Last `overlap` chars of the unstripped buffer, or all of it when shorter.
        carry = F.when(
            F.length(acc.buf) > F.lit(overlap),
            F.substring(acc.buf, -overlap, overlap) if overlap > 0 else F.lit(""),
        ).otherwise(acc.buf)
        return F.when(
            fits,
            F.struct(acc.chunks.alias("chunks"), F.concat(acc.buf, x.u, x.sep).alias("buf")),
        ).otherwise(
            F.struct(
                _emit(acc.chunks, acc.buf).alias("chunks"),
                F.concat(carry, x.u, x.sep).alias("buf"),
            )
        )

    return F.aggregate(_unit_structs(c, size), init, step, lambda acc: _emit(acc.chunks, acc.buf))


# ── Design-prose chunkers (no reference code; semantics stated here) ────────


def fixed_chunks(col, size: int = 2000, stride: int | None = None) -> Column:
    """character windows ``text[i:i+size]`` for i = 0, stride, 2*stride, ..."""
    c = F.col(col) if isinstance(col, str) else col
    step = stride or size
    starts = F.sequence(F.lit(0), F.length(c) - F.lit(1), F.lit(step))
    return F.when(
        F.length(c) > F.lit(0),
        F.transform(starts, lambda i: F.substring(c, i + F.lit(1), size)),
    ).otherwise(F.array().cast("array<string>"))


def paragraph_chunks(col, size: int = CHUNK_SIZE) -> Column:
    """pack raw paragraphs (split on blank lines) while the buffer stays
    strictly under ``size``; no overlap, no sentence split. Empty chunks dropped."""
    c = F.col(col) if isinstance(col, str) else col
    paras = F.split(c, "\n\n+")
    init = F.struct(F.array().cast("array<string>").alias("chunks"), F.lit("").alias("buf"))

    def step(acc, p):
        fits = F.length(acc.buf) + F.length(p) < F.lit(size)
        return F.when(
            fits,
            F.struct(acc.chunks.alias("chunks"), F.concat(acc.buf, p, F.lit(PARAGRAPH_SEP)).alias("buf")),
        ).otherwise(
            F.struct(
                _emit(acc.chunks, acc.buf).alias("chunks"),
                F.concat(p, F.lit(PARAGRAPH_SEP)).alias("buf"),
            )
        )

    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.aggregate(paras, init, step, lambda acc: _emit(acc.chunks, acc.buf))
    )


def recursive_chunks(col, max_tokens: int = 1000, overlap_tokens: int = 100) -> Column:
    """token-budget splitter. Paragraph units (sentences for paragraphs over
    the budget) packed up to ``max_tokens`` whitespace tokens; the next chunk
    starts with the last ``overlap_tokens`` tokens of the previous one."""
    c = F.col(col) if isinstance(col, str) else col
    para_units = split_paragraphs(normalize_newlines(c))

    def n_tokens(s):
        return F.size(F.filter(F.split(s, r"(?U)\s+"), lambda t: t != F.lit("")))

    units = F.flatten(
        F.transform(
            para_units,
            lambda p: F.when(n_tokens(p) > F.lit(max_tokens), split_sentences(p)).otherwise(F.array(p)),
        )
    )
    init = F.struct(
        F.array().cast("array<string>").alias("chunks"),
        F.array().cast("array<string>").alias("toks"),
    )

    def step(acc, u):
        toks = F.filter(F.split(u, r"(?U)\s+"), lambda t: t != F.lit(""))
        fits = F.size(acc.toks) + F.size(toks) <= F.lit(max_tokens)
        emit = F.when(F.size(acc.toks) > F.lit(0), F.array_append(acc.chunks, F.array_join(acc.toks, " "))).otherwise(
            acc.chunks
        )
        tail = F.slice(acc.toks, F.greatest(F.size(acc.toks) - F.lit(overlap_tokens) + F.lit(1), F.lit(1)), overlap_tokens) if overlap_tokens > 0 else F.array().cast("array<string>")
        return F.when(
            fits | (F.size(acc.toks) == F.lit(0)),
            F.struct(acc.chunks.alias("chunks"), F.concat(acc.toks, toks).alias("toks")),
        ).otherwise(F.struct(emit.alias("chunks"), F.concat(tail, toks).alias("toks")))

    def finish(acc):
        return F.when(
            F.size(acc.toks) > F.lit(0), F.array_append(acc.chunks, F.array_join(acc.toks, " "))
        ).otherwise(acc.chunks)

    return F.aggregate(units, init, step, finish)

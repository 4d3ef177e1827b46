"""Chunk headers (F12, F13, F25) as concat/concat_ws expressions.

``concat_ws`` skips null arguments, so optional header parts are written as
``when(cond, part)`` without an ``otherwise``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake.functions.text import strip

# ── Fixed values (header formats) ───────────────────────────────────────────
HEADER_OPEN, HEADER_SEP, HEADER_CLOSE = "[", " | ", "]\n\n"
CHUNK_LABELS = ("Source: ", "Court: ", "Year: ", "Opinion Type: ", "Citation: ")
STATUTE_LABELS = ("SC Code § ", "Title ", ": ", "Chapter ")
# ── End of fixed values ─────────────────────────────────────────────────────


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _s(col) -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def enrich_chunk(chunk, case_name, court_label, year, opinion_type, citation) -> Column:
    """'[Source: n | Court: c | Year: y | Opinion Type: t( | Citation: x)]\\n\\n' + chunk.

    The Citation part appears only when the citation is non-empty.
    """
    cit = _s(citation)
    src, court, yr, typ, cite = CHUNK_LABELS
    header = F.concat_ws(
        HEADER_SEP,
        F.concat(F.lit(src), _s(case_name)),
        F.concat(F.lit(court), _s(court_label)),
        F.concat(F.lit(yr), _s(year)),
        F.concat(F.lit(typ), _s(opinion_type)),
        F.when(cit != F.lit(""), F.concat(F.lit(cite), cit)),
    )
    return F.concat(F.lit(HEADER_OPEN), header, F.lit(HEADER_CLOSE), _s(chunk))


def _present(col) -> Column:
    """Truthiness of an optional string field: non-null and non-empty."""
    c = _c(col).cast("string")
    return c.isNotNull() & (c != F.lit(""))


def statute_body(body_text, text) -> Column:
    """body_text if non-empty, else text, else ''; stripped."""
    b, t = _c(body_text), _c(text)
    picked = F.coalesce(F.when(b != F.lit(""), b), F.when(t != F.lit(""), t), F.lit(""))
    return strip(picked)


def enrich_statute(section_id, title_num, title_name, chapter_num, short_title, body) -> Column:
    """'[SC Code § id( | Title n: name| | name)( | Chapter n)( | short)]\\n\\n' + body."""
    name = F.coalesce(strip(_c(title_name)), F.lit(""))
    short = F.coalesce(strip(_c(short_title)), F.lit(""))
    has_name = name != F.lit("")
    code, title, colon, chapter = STATUTE_LABELS
    title_part = F.when(
        _present(title_num) & has_name,
        F.concat(F.lit(title), _c(title_num).cast("string"), F.lit(colon), name),
    ).when(has_name, name)
    header = F.concat_ws(
        HEADER_SEP,
        F.concat(F.lit(code), _s(section_id)),
        title_part,
        F.when(_present(chapter_num), F.concat(F.lit(chapter), _c(chapter_num).cast("string"))),
        F.when(short != F.lit(""), short),
    )
    return F.concat(F.lit(HEADER_OPEN), header, F.lit(HEADER_CLOSE), _s(body))


def enrich_variant(style: str, chunk, case_name, court_label, year, citation) -> Column:
    """alternative header layouts from the design notes.

    style="case_court_date":  '[Case: n | Court: c | Date: y]\\n\\n' + chunk
    style="source_sentence":  'Source: n(, citation). Court: c. Date: y.\\n\\n' + chunk
    """
    cit = _s(citation)
    if style == "case_court_date":
        header = F.concat(
            F.lit("[Case: "), _s(case_name), F.lit(" | Court: "), _s(court_label),
            F.lit(" | Date: "), _s(year), F.lit("]"),
        )
    elif style == "source_sentence":
        source = F.concat_ws(", ", _s(case_name), F.when(cit != F.lit(""), cit))
        header = F.concat(
            F.lit("Source: "), source, F.lit(". Court: "), _s(court_label),
            F.lit(". Date: "), _s(year), F.lit("."),
        )
    else:
        raise ValueError(f"unknown header style: {style!r}")
    return F.concat(header, F.lit("\n\n"), _s(chunk))

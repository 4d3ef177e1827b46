"""Scalar text functions (Column -> Column), all JVM-side regex/string builtins.

Whitespace follows Python's ``str.strip`` / ``\\s`` (Unicode-aware). Java's
plain ``\\s`` and Spark's ``trim`` only handle ASCII, so every pattern here uses
``(?U)`` plus the four ASCII separators U+001C..U+001F that Python also counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ── Fixed values (patterns, defaults and formats the results depend on) ─────
TAG_RE = r"<[^>]+>"
DATE_RE = r"(\d{4}-\d{2}-\d{2})"
PARAGRAPH_BREAK_RE = "\n\n+"
MANY_NEWLINES_RE = "\n{3,}"
UNKNOWN_CASE_NAME = "Unknown"
DEFAULT_OPINION_TYPE = "Lead"
UNKNOWN_SNAPSHOT = "unknown"
SIZE_UNITS = (" KB", " MB", " GB")
# ── End of fixed values ─────────────────────────────────────────────────────

# Python-compatible whitespace class (inside a (?U) pattern).
WS = r"[\s\x{1C}-\x{1F}]"
# The same set as literal characters (every code point for which Python's
# str.isspace() holds; all lie below U+3001), for btrim's end scan.
WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
_DIGITS_RE = r"^[0-9]+$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace. Null stays null.

    ``btrim`` with the explicit character set scans only the two ends (no regex).
    """
    return F.btrim(_c(col), F.lit(WS_CHARS))


def collapse_ws(col) -> Column:
    """Every whitespace run becomes one space (Python ``re.sub(r"\\s+", " ", s)``)."""
    return F.regexp_replace(_c(col), rf"(?U){WS}+", " ")


def is_blank(col) -> Column:
    """True when null or only whitespace."""
    return F.coalesce(strip(col) == F.lit(""), F.lit(True))


def nullif_blank(col) -> Column:
    """Stripped value, or null when null/blank."""
    s = strip(col)
    return F.when(s != F.lit(""), s)


def default_blank(col) -> Column:
    """null -> ''."""
    return F.coalesce(_c(col), F.lit(""))


def strip_html(col) -> Column:
    """tags -> space, whitespace runs -> one space, strip; null -> ''.

    Entities and script/style bodies stay, exactly as the tag regex implies.
    """
    no_tags = F.regexp_replace(_c(col), TAG_RE, " ")
    return F.coalesce(strip(collapse_ws(no_tags)), F.lit(""))


def effective_text(plain, html, rule: str = "chunk", min_len: int = 150) -> Column:
    """the text an opinion contributes (divergence D1).

    rule="lake":  stripped plain text if it has at least ``min_len`` chars,
                  else stripped HTML.
    rule="chunk": stripped plain text if non-blank, else stripped HTML
                  (blank HTML gives '').
    """
    plain_s = F.coalesce(strip(_c(plain)), F.lit(""))
    html_text = strip_html(html)
    if rule == "lake":
        return F.when(F.length(plain_s) >= min_len, plain_s).otherwise(html_text)
    if rule == "chunk":
        return F.when(plain_s != F.lit(""), plain_s).otherwise(html_text)
    raise ValueError(f"unknown effective_text rule: {rule!r}")


def year_of(col) -> Column:
    """first four characters as int; 0 when null, shorter, or not numeric."""
    c = _c(col)
    head = F.substring(c, 1, 4).try_cast("int")
    return F.when(F.length(c) >= 4, F.coalesce(head, F.lit(0))).otherwise(F.lit(0)).cast("int")


def best_case_name(name, short, full) -> Column:
    """first non-blank of the three names (stripped), else 'Unknown' (D6)."""
    return F.coalesce(nullif_blank(name), nullif_blank(short), nullif_blank(full), F.lit(UNKNOWN_CASE_NAME))


def citation_parts_present(volume, reporter, page) -> Column:
    """Volume, reporter and page are all non-null and non-blank."""
    return ~is_blank(volume) & ~is_blank(reporter) & ~is_blank(page)


def cite_string(volume, reporter, page) -> Column:
    """'volume reporter page' from the stripped parts."""
    return F.concat_ws(" ", strip(volume), strip(reporter), strip(page))


def opinion_type(col, blank_is_lead: bool = False) -> Column:
    """stripped type, null -> 'Lead'; '' stays '' unless ``blank_is_lead``."""
    s = strip(col)
    if blank_is_lead:
        s = F.when(s != F.lit(""), s)
    return F.coalesce(s, F.lit(DEFAULT_OPINION_TYPE))


def normalize_newlines(col) -> Column:
    """F8: CRLF -> LF, three or more LF -> two, strip."""
    t = F.regexp_replace(_c(col), "\r\n", "\n")
    t = F.regexp_replace(t, MANY_NEWLINES_RE, "\n\n")
    return strip(t)


def split_paragraphs(col) -> Column:
    """paragraphs split on blank lines, stripped, empties dropped -> array<string>."""
    parts = F.split(_c(col), PARAGRAPH_BREAK_RE)
    return F.filter(F.transform(parts, lambda p: strip(p)), lambda p: p != F.lit(""))


# Sentence boundary (fixed): whitespace after . ! ? and before an ASCII capital,
# with Python's whitespace class.
SENTENCE_SPLIT_RE = r"(?U)(?<=[.!?])" + WS + r"+(?=[A-Z])"


def split_sentences(col) -> Column:
    """sentence units of one paragraph -> array<string>."""
    return F.split(_c(col), SENTENCE_SPLIT_RE)


def int_or_zero(col, default: int = 0) -> Column:
    """all-digit string -> bigint; anything else (or overflow) -> ``default``."""
    c = F.trim(_c(col).cast("string"))
    as_long = F.when(c.rlike(_DIGITS_RE), c.try_cast("bigint"))
    return F.coalesce(as_long, F.lit(default).cast("bigint"))


def truncate(col, n: int) -> Column:
    """F16: first ``n`` characters (code points)."""
    return F.substring(_c(col), 1, n)


def fit(col, widths: dict, name: str) -> Column:
    """F16 where the caller asks for it: cut to ``widths[name]``, or the value whole."""
    return truncate(col, widths[name]) if name in widths else _c(col)


def path_tail_id(col) -> Column:
    """last non-empty path segment of a URL as an int id, else 0."""
    return int_or_zero(F.regexp_extract(_c(col), r"([^/]+)/*$", 1))


def snapshot_date(col) -> Column:
    """S3: first YYYY-MM-DD in a path, else 'unknown'."""
    d = F.regexp_extract(_c(col), DATE_RE, 1)
    return F.when(d != F.lit(""), d).otherwise(F.lit(UNKNOWN_SNAPSHOT))


def format_bytes(col) -> Column:
    """'<n//1000> KB' below 1e6, '%.1f MB' below 1e9, else '%.2f GB'.

    ``format_number`` rounds the exact binary double half-even, which is what
    Python's ``%.1f`` does; ``format_string`` would round the shortest decimal
    half-up and disagree on values like 1.05.
    """
    n = _c(col).cast("bigint")
    kb_u, mb_u, gb_u = SIZE_UNITS
    kb = F.concat((n / F.lit(1000)).cast("bigint").cast("string"), F.lit(kb_u))
    mb = F.concat(F.regexp_replace(F.format_number(n / F.lit(1e6), 1), ",", ""), F.lit(mb_u))
    gb = F.concat(F.regexp_replace(F.format_number(n / F.lit(1e9), 2), ",", ""), F.lit(gb_u))
    return F.when(n < F.lit(1_000_000), kb).when(n < F.lit(1_000_000_000), mb).otherwise(gb)


def percent_done(done, total) -> Column:
    """round(done/total*100, 1), 0 when total is 0 or null."""
    d, t = _c(done), _c(total)
    raw = d.cast("double") / t.cast("double") * F.lit(100.0)
    # Python's round() works on the exact binary value (half-even on true ties);
    # format_number does the same, F.round would round the shortest decimal half-up.
    pct = F.regexp_replace(F.format_number(raw, 1), ",", "").cast("double")
    return F.when(t > F.lit(0), pct).otherwise(F.lit(0.0))


def year_label(start: int | None, end: int | None) -> str:
    """human label for an optional closed year range (driver-side constant)."""
    if start and end:
        return f"{start}–{end}"
    if start:
        return f"from {start}"
    if end:
        return f"up to {end}"
    return "all years"


def year_label_of(start, end) -> Column:
    """F18 over columns: the label of each row's optional year range."""
    a, b = _c(start), _c(end)
    has_a, has_b = F.coalesce(a != 0, F.lit(False)), F.coalesce(b != 0, F.lit(False))
    a, b = a.cast("string"), b.cast("string")
    return (F.when(has_a & has_b, F.concat(a, F.lit("–"), b)).when(has_a, F.concat(F.lit("from "), a))
            .when(has_b, F.concat(F.lit("up to "), b)).otherwise(F.lit("all years")))


def year_tag_of(start, end) -> Column:
    """F18 over columns: the path-safe tag of each row's optional year range."""
    part = lambda c: F.coalesce(F.when(c != 0, c.cast("string")), F.lit("all"))
    return F.concat(part(_c(start)), F.lit("_"), part(_c(end)))


def year_tag(start: int | None, end: int | None) -> str:
    """path-safe tag for stage caching, e.g. '2000_all'."""
    return f"{start or 'all'}_{end or 'all'}"


def remove_boilerplate(col, phrases) -> Column:
    """remove listed boilerplate phrases (literal, case-sensitive), then collapse spaces."""
    import re

    if not phrases:
        return _c(col)
    pattern = "|".join(re.escape(p) for p in phrases)
    # re.escape output is a valid Java pattern for plain phrases.
    out = F.regexp_replace(_c(col), pattern, " ")
    return strip(F.regexp_replace(out, r"[ \t]{2,}", " "))


# Citation shape used by the boundary audit: '123 S.C. 456', '123 S.E.2d 456', '18 U.S.C. § 1030',
# '12 F. Supp. 345', '410 U. S. 113'.
CITATION_RE = r"[0-9]+ [A-Z][A-Za-z.0-9]*(?: [A-Z][A-Za-z.0-9]*){0,3}(?: §)? [0-9]+"


def citations_in(col, pattern: str = CITATION_RE) -> Column:
    """All citation-shaped substrings of a text -> array<string>."""
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(pattern), 0)

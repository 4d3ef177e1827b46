"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong patterns are reported as they stand. Weak candidates (identifiers, passwords without
a telling name, endpoints) are reported only when complementary parts lie in one scope: an
identifier and a secret whose intervals, widened by ``scope``, overlap. The linking is an
interval join on (document, position bin), so it neither gathers a document in one task nor
forms all pairs of its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import stage

# The base patterns; a match whose tested part is shorter than ``least`` is dropped.
BASE = (
    ("assign", r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
               r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # A run of hex digits is matched whole, so asking for the length in the pattern changes nothing
    # but spares all the short runs that prose is full of.
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Weak parts: kind, role, pattern. None is reported alone.
WEAK = (
    ("user", "identifier", r"(?i)\b(?:user(?:name)?|login|client_?id|account)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}"),
    ("pass", "secret", r"(?i)\b(?:pass|pwd|pw|private_?key|auth|credential)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=!@#$%^&*-]{6,}"),
    ("endpoint", "endpoint", r"(?i)\b(?:[a-z][a-z0-9+]{1,15}://[^\s\"'<>]{4,}|(?:host|server|endpoint|url)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9][A-Za-z0-9.:/_-]{3,})"),
)
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret"} | {kind: role for kind, role, _ in WEAK}
KINDS = [kind for kind, *_ in BASE] + [kind for kind, *_ in WEAK]
SCOPE = 200  # code points between complementary parts


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<rank, nth, gap, n, ok>> of the leftmost non-overlapping matches: characters
    between the match before and this one, its own length, whether it passes the test. The
    pieces between matches and the matches, in turn, make up the text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("gap"), tested.alias("t"))
    rows = F.transform(F.filter(zipped, lambda x: x["m"].isNotNull()), lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("rank"), i.alias("nth"), F.length(x["gap"]).alias("gap"),
        F.length(x["m"]).alias("n"), (F.length(x["t"]) >= least).alias("ok")))
    return F.when(F.regexp_like(text, F.lit(pattern)), rows).otherwise(
        F.array().cast("array<struct<rank:int,nth:int,gap:int,n:int,ok:boolean>>"))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id), ``row`` telling rows apart, and the spans (row, rank, start, end) of
    the base and weak patterns in their whole texts; code points, end exclusive."""
    src = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    each = [_matches(F.col("_t"), *spec) for spec in BASE] + [_matches(F.col("_t"), kind, pattern, 0, 1) for kind, _, pattern in WEAK]
    parts = stage(src.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*each).alias("m")), "secret-parts")
    # Running lengths give positions; only matches take part, and a sorted window streams them.
    so_far = Window.partitionBy("row", "rank").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        parts.select("row", F.explode("m").alias("m")).select("row", "m.*")
        .withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far)).where("ok")
        .select("row", "rank", (F.col("end") - F.col("n")).cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    )
    return parts.select("row", "doc_id"), stage(spans, "secret-spans")


def link_weak(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row, rank, start, end): the weak spans that take part in a credential.

    A weak identifier needs a secret, weak or base, with fewer than ``scope`` code points between
    them, a weak secret an identifier, and an endpoint both. The weak side is filed under every
    position bin that its interval, widened by ``scope``, touches, the other under the bins it
    covers. Spans of a kind do not overlap, so what meets in a bin is bounded by its width.
    """
    role = F.create_map(*[F.lit(x) for rank, kind in enumerate(KINDS) for x in (rank, ROLES[kind])])
    spans = spans.withColumn("role", role[F.col("rank")])
    left = spans.where(F.col("rank") >= len(BASE)).withColumn("bin", F.explode(F.sequence(
        F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
    right = spans.where("role <> 'endpoint'").select(
        "row", F.col("start").alias("start2"), F.col("end").alias("end2"), F.col("role").alias("role2"),
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope))).alias("bin"))
    near = left.join(right, ["row", "bin"]).where(
        (F.col("start2") < F.col("end") + scope) & (F.col("start") < F.col("end2") + scope) & (F.col("role") != F.col("role2")))
    met = near.groupBy("row", "rank", "start", "end", "role").agg(
        F.max(F.col("role2") == "secret").alias("secret"), F.max(F.col("role2") == "identifier").alias("identifier"))
    return met.where(
        "CASE role WHEN 'identifier' THEN secret WHEN 'secret' THEN identifier ELSE secret AND identifier END"
    ).select("row", "rank", "start", "end")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, spans) for every row: array of struct(start, rank, end), by start, then rank;
    ``KINDS[rank]`` is the kind, and ranks below ``len(BASE)`` are strong matches. A null text is
    empty and has none; repeated rows and null ids stay; other columns are ignored, whatever
    their names; an empty table gives an empty result.
    """
    rows, spans = find_spans(docs, id_col, text_col)
    kept = spans.where(F.col("rank") < len(BASE)).unionByName(link_weak(spans, scope))
    lists = stage(kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end"))).alias("spans")), "secret-lists")
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return rows.join(lists, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["rank"]], s["start"], s["end"])), ",")


def scan_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: the digests of ``scan_secrets``."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    ranks = F.transform("spans", lambda s: s["rank"])
    count = [(F.size(ranks) - F.size(F.array_remove(ranks, n))).cast("bigint").alias(f"n_{BASE[n][0]}") for n in range(len(BASE))]
    return scan_secrets(docs, **options).select(
        "doc_id", *count, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))

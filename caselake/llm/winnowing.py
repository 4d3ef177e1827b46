"""Winnowing fingerprints in DataFrame functions.

Every run of ``k`` words is hashed; of each ``w`` neighbouring hashes the smallest is kept, the
rightmost of equals, with its position. Any passage of w + k - 1 words that two texts share
therefore leaves a common fingerprint, and none shorter than k words does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import stage

K = 5
W = 16
RANGES_PER_PARTITION = 4
WORD = r"[\p{L}\p{M}\p{N}]+"
# Scripts written without spaces (Thai to Myanmar, Khmer, CJK) count a character as a word.
_SINGLE = "[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF]"
_POSITION = (1 << 31) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _each(count: Column, body: Callable[[Column], Column]) -> Column:
    """``body(i)`` for i = 0 .. count - 1, where count is at least 1. Elements are reached by ``get``:
    ``slice`` would copy the whole array for each of them."""
    return F.transform(F.sequence(F.lit(0), count - 1), body)


def _window_minima(values: Column, w: int) -> Column:
    """Minimum of each w neighbours (of all, if fewer): of each ``inner`` first, then of those."""
    inner = next(n for n in range(int(w ** 0.5), 0, -1) if w % n == 0)

    def least(v: Column, step: int, n: int) -> Column:
        if n == 1:
            return v
        return _each(F.size(v) - step * (n - 1), lambda i: F.least(*[F.get(v, i + step * j) for j in range(n)]))

    whole = _let(least(values, 1, inner), lambda m: least(m, inner, w // inner))
    return F.when(F.size(values) <= w, F.array(F.array_min(values))).otherwise(whole)


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """array<struct<pos, hash>> by position: the winnowed word k-grams of the whole text.

    Words are runs of letters, marks and digits, lower-cased; a text with fewer than k words is
    one gram of them all, one without words a gram of the whole text, and a null or empty
    text has no fingerprint. A gram's rank is the top 33 bits of its hash, equal ranks are told apart
    by position, later first, so one integer minimum picks the rightmost.
    """
    return _let(F.lower(F.coalesce(text.cast("string"), F.lit(""))), lambda body: _winnow(body, k, w))


def _winnow(body: Column, k: int, w: int) -> Column:

    def rank(gram: Column, i: Column | int) -> Column:
        return gram.bitwiseAND(F.lit(~_POSITION)).bitwiseOR((F.lit(_POSITION) - i).cast("bigint"))

    def hash_at(words: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(k)])

    def from_words(words: Column) -> Column:
        whole = F.when(F.size(words) > 0, F.xxhash64(words)).otherwise(F.xxhash64(body))
        short = F.array(F.struct(F.lit(0).alias("pos"), whole.alias("hash")))
        ranks = _each(F.size(words) - (k - 1), lambda i: rank(hash_at(words, i), i))
        chosen = F.array_distinct(_let(ranks, lambda r: _window_minima(r, w)))
        place = F.transform(chosen, lambda r: (F.lit(_POSITION) - r.bitwiseAND(F.lit(_POSITION))).cast("int"))
        usual = F.transform(place, lambda p: F.struct(p.alias("pos"), hash_at(words, p).alias("hash")))
        return F.when(F.size(words) >= k, usual).otherwise(short)

    spaced = F.when(F.regexp_like(body, F.lit(_SINGLE)), F.regexp_replace(body, f"({_SINGLE})", " $1 ")).otherwise(body)
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return F.when(body == "", none).otherwise(_let(F.regexp_extract_all(spaced, F.lit(WORD), F.lit(0)), from_words))


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Every row's fingerprint, that of its edited text and of the next document.

    Columns: doc_id, text, edited (the last floor(n/2) code points replaced by the first as many,
    or all, of the next document), prints, edited_prints, next_prints. Documents are ordered by id,
    equal ids by text, null ids first; after the last comes the first, and a lone document is
    its own next. A null text is empty; repeated rows stay; an empty table gives an empty result;
    other columns are ignored, whatever their names.

    Rows are dealt by ranges of the id, and the first row of a range goes to the range before as
    well, so each text is shuffled once and every row finds its next one in its own range.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = stage(src.select("doc_id"), "winnow-ids")
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = ids.repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id().alias("part")).agg(
        F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("null"))
    lows = sorted({None if r["null"] else r["low"] for r in parts.collect()}, key=lambda x: (x is not None, x))  # a row per range
    bounds = F.lit(lows[1:] or [0]).cast("array<bigint>")
    place = range_number(F.col("doc_id"), lows[1:])
    low = F.when(place == 0, F.lit(lows[0] if lows else None).cast("bigint")).otherwise(F.get(bounds, place - 1))
    before = F.pmod(place - 1, F.lit(max(1, len(lows))))
    both = F.array(F.struct(place.alias("range"), F.lit(0).alias("extra")), F.struct(before.alias("range"), F.lit(1).alias("extra")))
    dealt = src.withColumn("r", F.explode(F.when(F.col("doc_id").eqNullSafe(low), both).otherwise(F.slice(both, 1, 1))))
    dealt = dealt.select("doc_id", "text", "r.range", "r.extra").repartition("range")
    order = Window.partitionBy("range").orderBy("extra", F.col("doc_id").asc_nulls_first(), "text")
    own = dealt.withColumn("prints", fingerprint(F.col("text"), k, w))
    after = own.withColumn("next_text", F.lead("text").over(order)).withColumn("next_prints", F.lead("prints").over(order)).where("extra = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    return after.withColumn("edited", edited).withColumn("edited_prints", fingerprint(F.col("edited"), k, w)).select(
        "doc_id", "text", "edited", "prints", "edited_prints", "next_prints")


def range_number(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``value`` (null: none), found in two steps
    of about sqrt(bounds) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = F.lit(bounds).cast("array<bigint>")
    coarse = F.lit(bounds[::step]).cast("array<bigint>")
    at = lambda array: F.size(F.filter(array, lambda b: b <= value))
    skip = F.greatest(at(coarse) - 1, F.lit(0)) * step
    return F.when(value.isNull(), 0).otherwise(_let(skip, lambda s: s + at(F.slice(fine, s + 1, step))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' distinct hashes; 1 for two empty ones."""
    x, y = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    return _let(F.size(F.array_intersect(x, y)), lambda both: F.when(
        F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(both / (F.size(x) + F.size(y) - both)))


def fingerprint_text(prints: Column) -> Column:
    """position:hash pairs, hashes in hex, comma-joined."""
    return F.array_join(F.transform(prints, lambda p: F.concat_ws(":", p["pos"], F.lower(F.hex(p["hash"])))), ",")

"""Language identification by Bayesian fusion of text, markup, address and host evidence.

Text likelihoods come from a character-trigram model trained on a bounded sample of labelled
rows. Three further sources are estimated from the whole corpus by grouped aggregation: how
often a declared language goes with each text language, how often an address suffix does, and
a prior per host, smoothed towards its domain and that towards the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.common import lean, stage

BUCKETS = 1 << 15
TRAIN_ROWS = 2000      # labelled rows per language the text model sees, the lowest by hash
TEMPER = 0.25          # trigrams overlap, so their log-likelihoods are not independent
UNKNOWN = "und"        # evenly spread trigrams: what is no known language
UNKNOWN_PRIOR = 0.01
HOST_WEIGHT = 20.0     # rows a parent's distribution counts for at the level below
TABLE_WEIGHT = 1.0     # the same for the declared-language and suffix tables
ACCEPT = 0.5           # least posterior of an accepted language
_CHUNK = 1 << 18


def _trigrams(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of the character trigrams, a chunk at a time; case is folded, a run of other
    characters than letters counts as one space, and texts without letters have none."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = (raw >= 0xAA) & (raw != 0xD7) & (raw != 0xF7) & ~((raw >= 0x2000) & (raw < 0x2070)) | (raw >= 97) & (raw <= 122)
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first of each run that is no letter stays, as a space
    codes = np.where(letter, raw, 32)[kept]
    if not letter.any():
        return
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
    for at in range(0, codes.size - 2, _CHUNK):
        c = codes[at:at + _CHUNK + 2]
        mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1]) * np.uint64(0x85EBCA77) + c[2:]
        yield ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)


class TextModel:
    """Log-probability of each trigram bucket under each language; the last row is UNKNOWN."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, np.ascontiguousarray(logs.T)

    def score(self, text: str | None) -> tuple[np.ndarray, int]:
        """Log-likelihoods by language and the number of trigrams; zeros for a text without letters."""
        total, n = np.zeros(self.logs.shape[1]), 0
        for buckets in _trigrams(text or ""):
            total += self.logs[buckets].sum(axis=0)
            n += buckets.size
        return total, n


def train_text_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang",
                     rows: int = TRAIN_ROWS) -> TextModel:
    """Trigram model of every label, from at most ``rows`` labelled texts of each: those of the
    lowest hash, so that the choice does not depend on partitions. Null labels and null texts are
    no training rows. The model holds 256 KB per label."""
    usable = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.lower(F.trim(F.col(label_col))).alias("label"), F.col(text_col).cast("string").alias("text"))
    top = usable.groupBy("label").count().collect()
    names = sorted(r["label"] for r in top)
    if not names:
        return TextModel([UNKNOWN], np.full((1, BUCKETS), -np.log(BUCKETS)))
    # A hash threshold keeps about twice the rows asked for before the exact cut, so that no
    # language is ranked in one task as a whole.
    counts = {r["label"]: r["count"] for r in top}
    share = F.create_map(*[F.lit(x) for n in names for x in (n, min(1.0, 2.0 * rows / counts[n] + 100.0 / counts[n]))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    likely = usable.where(draw < share[F.col("label")])
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.pmod(F.xxhash64("text"), F.lit(1 << 20)), "text"))
    sample = likely.withColumn("rank", rank).where(F.col("rank") <= rows).select("label", "text").repartition("label", F.length("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = sums.setdefault(label, np.zeros(BUCKETS, dtype=np.int64))
                for buckets in _trigrams(text.as_py()):
                    own += np.bincount(buckets, minlength=BUCKETS)
        for label, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * at.size, pa.string()), pa.array(at, pa.int32()), pa.array(own[at])],
                names=["label", "bucket", "n"])

    counted = sample.mapInArrow(lean(kernel), "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table, place = np.zeros((len(names), BUCKETS)), {n: i for i, n in enumerate(names)}
    for r in counted.collect():  # at most languages x buckets rows
        table[place[r["label"]], r["bucket"]] = r["n"]
    everywhere = table.sum(axis=0) + 1.0
    backing = 200.0 * everywhere / everywhere.sum()
    table = (table + backing) / (table.sum(axis=1, keepdims=True) + 200.0)
    return TextModel([*names, UNKNOWN], np.log(np.vstack([table, np.full(BUCKETS, 1.0 / BUCKETS)])))


def html_language(html: Column) -> Column:
    """The language that the html element or a content-language tag declares, or null."""
    tag = F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", 1)
    meta = F.regexp_extract(html, r"(?i)<meta[^>]*content-language[^>]*content\s*=\s*[\"']?([A-Za-z]+)", 1)
    return F.nullif(F.when(tag != "", tag).otherwise(meta), F.lit(""))


def html_words(html: Column) -> Column:
    """Text of a page: scripts, styles, comments, tags and entities become spaces."""
    no_code = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(no_code, r"<[^>]*>", " "), r"&#?\w{1,10};", " ")


def _host_parts(address: Column) -> tuple[Column, Column, Column]:
    """(host, domain, suffix) of a URL or bare host; the empty string where there is none. The
    domain is the last two labels of the host, the suffix the last."""
    bare = F.regexp_extract(F.lower(F.coalesce(address, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]*)", 1)
    domain = F.regexp_extract(bare, r"([^.]+\.[^.]+)\.?$", 1)
    suffix = F.regexp_extract(bare, r"\.([^.]+)\.?$", 1)
    return bare, domain, suffix


def identify_languages(docs: DataFrame, model: TextModel, id_cols: tuple[str, ...] = ("doc_id",), text: Column | None = None,
                       declared: Column | None = None, address: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: the id columns, ``lang`` (most probable language or "und"),
    ``posterior``, ``text_lang`` (by the text alone), ``accepted``.

    A row is accepted if its text has letters and a language other than "und" reaches a
    posterior of ACCEPT. A null text is empty; its language follows from the other evidence, but
    it is never accepted. Missing declarations, suffixes and hosts are neutral; rows without a host
    share the host "". Of equal posteriors the alphabetically first language wins. Repeated rows and
    null ids stay; an empty table gives an empty result; columns that are not named are ignored.
    """
    names = model.languages
    text = F.col("text") if text is None else text
    declared = F.lit(None).cast("string") if declared is None else declared
    address = F.lit(None).cast("string") if address is None else address
    ids = [f"_id{i}" for i in range(len(id_cols))]
    host, domain, suffix = _host_parts(address)
    src = docs.select(
        text.cast("string").alias("_text"),
        F.lower(F.regexp_extract(F.coalesce(declared, F.lit("")), r"^\s*([A-Za-z]+)", 1)).alias("_declared"),
        host.alias("_host"), domain.alias("_domain"), suffix.alias("_suffix"),
        *[F.col(c).cast("bigint").alias(i) for c, i in zip(id_cols, ids, strict=True)])
    others = src.columns[1:]
    schema = ", ".join(f"{c} {t}" for c, t in src.dtypes[1:]) + ", _scores array<double>, _n bigint"
    scored = stage(src.mapInArrow(lean(_scorer(model, others)), schema), "langid-scores")

    best = F.array_position(F.col("_scores"), F.array_max("_scores")).cast("int")  # the first of equals
    scored = scored.withColumn("_best", F.when(F.col("_n") > 0, best).otherwise(F.lit(len(names))))
    votes = [F.sum((F.col("_best") == i + 1).cast("bigint")) for i in range(len(names))]
    count = F.array(*votes).alias("_votes")

    hosts = stage(scored.groupBy("_host", "_domain", "_suffix").agg(count), "langid-hosts")
    add = lambda: F.array(*[F.sum(F.col("_votes")[i]) for i in range(len(names))])
    total = [int(x or 0) for x in hosts.agg(add().alias("v")).first()["v"]]
    known = max(1, sum(total[:-1]))
    prior = [(1 - UNKNOWN_PRIOR) * (t + 1.0) / (known + len(names) - 1) for t in total[:-1]] + [UNKNOWN_PRIOR]
    prior = [p / sum(prior) for p in prior]

    # Lists by language stay in higher-order functions, so plans grow with the languages, not their square.
    def summed(votes: Column) -> Column:
        return F.aggregate(votes, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def smoothed(rows: DataFrame, parent: Column, weight: float, name: str) -> DataFrame:
        return rows.withColumn("_all", summed(F.col("_votes"))).withColumn(name, F.zip_with(
            F.col("_votes"), parent, lambda v, p: (v + F.lit(weight) * p) / (F.col("_all") + F.lit(weight)))).drop("_all")

    flat = F.array(*[F.lit(p) for p in prior])
    domains = smoothed(hosts.groupBy("_domain").agg(add().alias("_votes")), flat, HOST_WEIGHT, "_parent").select("_domain", "_parent")
    whole = float(max(1, sum(total)))
    zeros = F.array(*[F.lit(0.0)] * len(names))
    suffixes = hosts.groupBy("_suffix").agg(add().alias("_votes")).withColumn("_share", summed(F.col("_votes")) / F.lit(whole))
    by_suffix = suffixes.select("_suffix", F.when(F.col("_suffix") == "", zeros).otherwise(F.zip_with(
        F.col("_votes"), F.array(*[F.lit(t) for t in total]),
        lambda v, t: F.log((v + F.lit(TABLE_WEIGHT) * F.col("_share")) / (t + F.lit(TABLE_WEIGHT))))).alias("_by_suffix"))
    priors = stage(
        smoothed(hosts.join(domains, "_domain").join(by_suffix, "_suffix"), F.col("_parent"), HOST_WEIGHT, "_prior")
        .select("_host", "_prior", "_by_suffix"), "langid-priors")

    # How a declaration goes with the text language: known languages and "other" only.
    code = F.when(F.col("_declared").isin(names[:-1]), F.col("_declared")).when(F.col("_declared") != "", F.lit("*"))
    table = {r["d"]: r["_votes"] for r in scored.where("_declared <> ''").groupBy(code.alias("d")).agg(count).collect()}
    by_code = []
    seen = max(1, sum(map(sum, table.values())))
    said = np.sum(list(table.values()), axis=0) if table else None
    for d, v in table.items():
        part = sum(v) / seen
        by_code.append((d, [float(np.log((v[i] + TABLE_WEIGHT * part) / (said[i] + TABLE_WEIGHT))) for i in range(len(names))]))
    spoken = F.broadcast(docs.sparkSession.createDataFrame(by_code, "_code string, _spoken array<double>"))  # a row per language

    joined = scored.join(priors, "_host").join(spoken, code == F.col("_code"), "left").withColumn("_spoken", F.coalesce("_spoken", zeros))
    sums = F.zip_with("_scores", "_prior", lambda s, p: F.lit(TEMPER) * s + F.log(p))
    for more in ("_by_suffix", "_spoken"):
        sums = F.zip_with(sums, F.col(more), lambda a, x: a + x)
    logs = joined.withColumn("_sum", sums).withColumn("_top", F.array_max("_sum"))
    weight = F.aggregate("_sum", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("_top")))
    place = F.array_position(F.col("_sum"), F.col("_top")).cast("int")
    label = F.array(*[F.lit(n) for n in names])
    done = logs.select(
        *[F.col(i).alias(c) for c, i in zip(id_cols, ids, strict=True)],
        F.element_at(label, place).alias("lang"), (F.lit(1.0) / weight).alias("posterior"),
        F.when(F.col("_n") > 0, F.element_at(label, F.col("_best"))).alias("text_lang"), F.col("_n").alias("_letters"))
    accepted = (F.col("_letters") > 0) & (F.col("lang") != UNKNOWN) & (F.col("posterior") >= ACCEPT)
    return done.withColumn("accepted", accepted).drop("_letters")


def _scorer(model: TextModel, others: list[str]):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = model.logs.shape[1]
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column(0)]
            scores = np.concatenate([s for s, _ in found]) if found else np.empty(0)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(scores), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], lists, pa.array([n for _, n in found], pa.int64())], names=[*others, "_scores", "_n"])
    return kernel

"""Licence families of paragraphs by sparse word n-gram logistic regression, in DataFrame functions
and Spark's own ML transformers.

The classes are the families and "unknown". Training rows are made from the public wording of
licence notices set among a bounded sample of corpus paragraphs, with words left out at random;
unknown rows are corpus paragraphs and notices that name no licence. A held-out share sets the
temperature of the probabilities. A prediction counts only if the paragraph also holds enough of a
template of that family.

Lines are scored, and sentences of long ones; lines that were wrapped, which end without a stop, are
also taken together and scored by sentence. What cannot hold TEMPLATE_SHARE of any template's
n-grams needs no score: see ``telling_words``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import stage

UNKNOWN = "unknown"
# Public wording of licence notices by family.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2.0", "apache license version 2.0 january 2004",
                   "you may not use this file except in compliance with the apache license"),
    "mit": ("released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    "gpl": ("this work is licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
            "licensed under the gnu general public license version 2"),
    "lgpl": ("licensed under the gnu lesser general public license", "under the terms of the gnu lesser general public license version 2.1"),
    "agpl": ("licensed under the gnu affero general public license version 3", "under the terms of the gnu affero general public license"),
    "bsd": ("licensed under the bsd 3 clause license", "redistribution and use in source and binary forms with or without modification are permitted",
            "released under the bsd license"),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2.0", "licensed under the mozilla public license 2.0"),
    "cc-by": ("licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    "cc-by-sa": ("licensed under cc by sa 4.0", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    "cc-by-nc": ("licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    "cc0": ("released under cc0 1.0 universal public domain dedication", "this work is dedicated to the public domain under cc0"),
    "isc": ("licensed under the isc license", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "released under the unlicense"),
}
# Notices that name no licence family.
NO_FAMILY = ("copyright all rights reserved", "licensed under the terms below", "a license is required to drive", "released under license",
             "this license may not be transferred", "the public library is open", "commercial license available on request",
             "licensed to the customer named above", "permission denied", "creative work of the license holder")
BACKGROUND_ROWS = 400      # corpus paragraphs the training rows are set among, the lowest by hash ...
BACKGROUND_DOCS = 1600     # ... of about so many documents, drawn by hash, each taken whole
COPIES = 24                # training rows per template
LONG_WORDS = 80            # a longer paragraph is cut at sentence ends
ACCEPT = 0.5               # least calibrated probability of a family
TEMPLATE_SHARE = 0.6       # least share of a template's n-grams that the paragraph holds
COMMON_WORDS = frozenset("a an and any are as at by for from in into is it of on or out not the this to under use with without you".split())
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 3.0)


@dataclass
class LicenceModel:
    families: list[str]
    features: CountVectorizerModel
    regression: LogisticRegressionModel
    temperature: float


def words(text: Column) -> Column:
    """Lower-cased words; a dot between digits stays."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\d+(?:\.\d+)+|[\p{L}\p{N}]+"), F.lit(0))


def grams(tokens: Column) -> Column:
    """Distinct words and word pairs."""
    def of(t: Column) -> Column:
        pairs = F.when(F.size(t) > 1, F.transform(
            F.sequence(F.lit(0), F.size(t) - 2), lambda i: F.concat_ws(" ", F.get(t, i), F.get(t, i + 1))))
        return F.array_distinct(F.concat(t, F.coalesce(pairs, F.array().cast("array<string>"))))

    # A list of one is transformed, so that the words of a long text are found once and not for each pair.
    return F.get(F.transform(F.array(tokens), of), 0)


def _template_grams(template: str) -> list[str]:
    own = template.split(" ")
    return list(dict.fromkeys([*own, *map(" ".join, zip(own, own[1:], strict=False))]))


def telling_words(templates: dict[str, tuple[str, ...]], share: float = TEMPLATE_SHARE) -> list[str]:
    """Words of which a paragraph must hold one to hold ``share`` of any template's words and pairs.

    For each template so many of its words are named that the n-grams without any of them are
    fewer than ``share``: a paragraph that lacks all the named words misses the template. Words that
    many templates hold come first, common ones of the language last."""
    used: dict[str, int] = {}
    for ts in templates.values():
        for t in ts:
            for w in dict.fromkeys(t.split(" ")):
                used[w] = used.get(w, 0) + 1
    named: set[str] = set()
    for ts in templates.values():
        for t in ts:
            all_grams = _template_grams(t)
            own: set[str] = set()
            for w in sorted(dict.fromkeys(t.split(" ")), key=lambda w: (w in COMMON_WORDS or w.replace(".", "").isdigit(), w not in named, -used[w], w)):
                if sum(not own & set(g.split(" ")) for g in all_grams) < share * len(all_grams):
                    break
                own.add(w)
            named |= own
    return sorted(w for w in named if not any(o != w and o in w for o in named))  # a part of a word stands for it


TELLING = telling_words(TEMPLATES)


def _may_match(text: Column) -> Column:
    """False only for texts that hold too little of every template."""
    def any_of(lower: Column) -> Column:
        found = F.contains(lower, F.lit(TELLING[0]))
        for w in TELLING[1:]:
            found = found | F.contains(lower, F.lit(w))
        return found

    # A list of one is transformed, so that a text is lower-cased once and not for each word.
    return F.get(F.transform(F.array(F.lower(text)), any_of), 0)


# A line end inside a paragraph: the line does not end in a stop, and neither it nor the next one is
# blank. Marks of a comment at the next line's start go with it.
WRAP = r"(?<=[^\s.!?:;|])[ \t]*\r?\n[ \t]*(?:(?:[#*;%]+|//+|--+)[ \t]*)?(?=[^\s])"
_MARK = "\u0001"


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", only_possible: bool = True) -> DataFrame:
    """(doc_id, paragraph, line, part, body) of every whole text. A paragraph is a line, or several that
    were wrapped (WRAP); paragraphs and the lines in one are numbered from 0. Each line is a row, in
    sentences (``part``) if it has over LONG_WORDS words, and a paragraph of several lines comes
    once more as a whole, in sentences, with a null line. The control character U+0001 in a text counts
    as a line end inside a paragraph. ``only_possible`` leaves out what cannot
    match any template."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("_t"))
    if only_possible:
        src = src.where(_may_match(F.col("_t")))
    marked = F.regexp_replace("_t", WRAP, _MARK)
    blocks = src.select("doc_id", F.posexplode(F.split(marked, r"\r?\n")).alias("paragraph", "block"))
    if only_possible:
        blocks = blocks.where(_may_match(F.col("block")))
    single = blocks.select("doc_id", "paragraph", F.posexplode(F.split("block", _MARK)).alias("line", "body"))
    whole = blocks.where(F.contains("block", F.lit(_MARK))).select(
        "doc_id", "paragraph", F.lit(None).cast("int").alias("line"), F.replace("block", F.lit(_MARK), F.lit(" ")).alias("body"))
    rows = single.union(whole)
    if only_possible:
        rows = rows.where(_may_match(F.col("body")))
    long = F.col("line").isNull() | (F.size(F.split("body", r"\s+")) > LONG_WORDS)
    cut = F.when(long, F.split("body", r"(?<=[.!?;])\s+")).otherwise(F.array("body"))
    parts = rows.select("doc_id", "paragraph", "line", F.posexplode(cut).alias("part", "body")).where(F.trim("body") != "")
    return parts.where(_may_match(F.col("body"))) if only_possible else parts


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(UNKNOWN, t) for t in NO_FAMILY]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{f}', '{t}')" for f, t in rows) + " AS t(family, template)")


def train_licence_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        background_rows: int = BACKGROUND_ROWS, copies: int = COPIES) -> LicenceModel:
    """Fit on templates set among at most ``background_rows`` paragraphs that cannot match one, those of
    the lowest hash among about BACKGROUND_DOCS documents drawn by a hash of their text; without
    any the templates stand alone."""
    spark = docs.sparkSession
    every = max(1, docs.count() // BACKGROUND_DOCS)
    drawn = docs.where(F.pmod(F.xxhash64(F.col(text_col)), F.lit(every)) == 0)
    plain = paragraphs(drawn, id_col, text_col, only_possible=False).where(F.col("line").isNotNull() & ~_may_match(F.col("body")))
    background = plain.select("body").distinct().orderBy(F.xxhash64("body"), "body").limit(background_rows)
    numbered = background.select(words(F.col("body")).alias("around"), F.pmod(F.xxhash64("body"), F.lit(copies)).cast("int").alias("copy"))
    near = numbered.groupBy("copy").agg(F.max("around").alias("around"))  # a paragraph for each copy
    copy = _templates(spark).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).join(F.broadcast(near), "copy", "left")
    draw = lambda *xs: F.pmod(F.xxhash64(*xs), F.lit(1000))
    kept = F.filter(words(F.col("template")), lambda w, i: draw(w, i, F.col("copy"), F.col("template")) >= F.when(F.col("copy") % 3 == 0, 0).otherwise(80))
    context = F.slice(F.coalesce("around", F.array().cast("array<string>")), 1, F.col("copy") % 12)
    made = copy.select("family", "copy", F.when(F.col("copy") % 2 == 0, F.concat(context, kept)).otherwise(F.concat(kept, context)).alias("tokens"))
    plain = numbered.select(F.lit(UNKNOWN).alias("family"), "copy", F.col("around").alias("tokens"))
    families = [*TEMPLATES, UNKNOWN]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    rows = stage(made.unionByName(plain).select(label.cast("double").alias("label"), "copy", grams(F.col("tokens")).alias("grams")).where(F.size("grams") > 0), "licence-train")
    fit, held = rows.where("copy % 4 <> 3"), rows.where("copy % 4 = 3")
    features = CountVectorizer(inputCol="grams", outputCol="features", minDF=2.0, binary=True).fit(fit)
    regression = LogisticRegression(regParam=0.001, maxIter=60).fit(features.transform(fit).select("label", "features"))
    model = LicenceModel(families, features, regression, 1.0)
    scored = stage(_logits(held, model).select("label", "logits"), "licence-held")
    loss = [F.avg(-F.log(F.greatest(F.get(_softmax(F.col("logits"), t), F.col("label").cast("int")), F.lit(1e-12)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]
    losses = scored.agg(*loss).first()
    model.temperature = min(zip(losses, TEMPERATURES, strict=True), key=lambda x: x[0])[1] if losses[0] is not None else 1.0
    return model


def _logits(rows: DataFrame, model: LicenceModel) -> DataFrame:
    done = model.regression.transform(model.features.transform(rows))
    return done.withColumn("logits", vector_to_array("rawPrediction")).drop("features", "rawPrediction", "probability", "prediction")


def _softmax(logits: Column, temperature: float) -> Column:
    top = F.array_max(logits)
    weight = F.transform(logits, lambda x: F.exp((x - top) / F.lit(temperature)))
    return F.transform(weight, lambda x: x / F.aggregate(weight, F.lit(0.0), lambda a, b: a + b))


def scan_licences(docs: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text",
                  only_possible: bool = True) -> DataFrame:
    """(doc_id, paragraph, line, part, family, probability, template, share): a row for each line and each
    paragraph of several lines (see ``paragraphs``) that may match a template, or with
    ``only_possible=False`` for every one. family is "unknown", and template and share are null,
    unless a family reaches ACCEPT and TEMPLATE_SHARE of one of its templates.

    Null, empty and blank texts give no row; repeated rows give a row each; of equally probable
    families the first listed wins, of equal templates the first; null ids are carried; other columns
    are ignored, whatever their names; an empty table gives none.
    """
    parts = paragraphs(docs, id_col, text_col, only_possible).withColumn("grams", grams(words(F.col("body"))))
    # A list of one is transformed, so that the logits are worked out once.
    judged = F.get(F.transform(F.array("logits"), lambda z: F.struct(
        (F.exp(F.array_max(z) / F.lit(model.temperature)) / F.aggregate(z, F.lit(0.0), lambda a, x: a + F.exp(x / F.lit(model.temperature)))).alias("probability"),
        (F.array_position(z, F.array_max(z)) - 1).cast("int").alias("place"))), 0)
    best = _logits(parts, model).withColumn("judged", judged).withColumn("probability", F.col("judged.probability")).withColumn(
        "guess", F.get(F.array(*[F.lit(f) for f in model.families]), F.col("judged.place")))
    compared = F.lit(None).cast("struct<share:double,order:int,template:string>")
    for family, templates in TEMPLATES.items():
        rows = []
        for n, t in enumerate(templates):
            wanted = F.array(*[F.lit(g) for g in _template_grams(t)])
            share = F.size(F.array_intersect(wanted, F.col("grams"))) / F.size(wanted)
            rows.append(F.struct(share.alias("share"), F.lit(-n).alias("order"), F.lit(t).alias("template")))
        compared = F.when(F.col("guess") == family, F.array_max(F.array(*rows))).otherwise(compared)
    confirmed = (F.col("guess") != UNKNOWN) & (F.col("probability") >= ACCEPT) & (F.col("found.share") >= TEMPLATE_SHARE)
    return best.withColumn("found", compared).withColumn("sure", F.coalesce(confirmed, F.lit(False))).select(
        "doc_id", "paragraph", "line", "part", F.when(F.col("sure"), F.col("guess")).otherwise(F.lit(UNKNOWN)).alias("family"), "probability",
        F.when(F.col("sure"), F.col("found.template")).alias("template"), F.when(F.col("sure"), F.col("found.share")).alias("share"))

"""Registered queries for operators the reference describes only in its design
notes (fixed windows, paragraph packing, token-budget splitting, boilerplate
removal, citation-boundary audit, header layouts), plus snapshot/JSONL
round-trips and ready-made vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from caselake.functions.chunking import cut_matches, fixed_chunks, paragraph_chunks, recursive_chunks
from caselake.functions.enrich import enrich_variant
from caselake.functions.text import CITATION_RE, remove_boilerplate, snapshot_date, year_label_of, year_tag_of
from caselake.plans import sqlparts as Q
from caselake.plans.chunks import explode_chunks, text_bearing
from caselake.plans.queries import LAKE_PREFIX, lake_opinions, register, staged_clusters
from caselake.functions.chunking import legal_chunks
from caselake.sources import standins as S
from caselake.sources.courts import court_label

BOILERPLATE = ("IT IS SO ORDERED",)


def _docs(spark, d):
    return S.text_table(spark, d, "documents", "doc_id")


def _para_docs(spark, d):
    return _docs(spark, d).select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


PARA_DOCS_SQL = f"(SELECT doc_id, replace(text, {Q.NL}, {Q.NL2}) AS text FROM documents)"


def _explode_sql(source: str, list_expr: str) -> str:
    return f"""
    SELECT doc_id, chunk_index, chunk, CAST(length(chunk) AS INTEGER) AS chunk_len FROM (
        SELECT doc_id, CAST(unnest(generate_series(0, len(ch) - 1)) AS INTEGER) AS chunk_index, unnest(ch) AS chunk
        FROM (SELECT doc_id, {list_expr} AS ch FROM {source}))"""


@register("fixed_chunks", _explode_sql(
    "documents", "list_transform(range(0, length(text), 2500), lambda i: substr(text, i + 1, 3000))"))
def q_fixed_chunks(spark, d):
    """3000-character windows every 2500 characters."""
    out = explode_chunks(_docs(spark, d), fixed_chunks("text", 3000, 2500), ["doc_id"])
    return out.withColumn("chunk_len", F.length("chunk"))


_PARA_STEP = (
    "lambda acc, p: CASE WHEN length(acc.buf) + length(p) < 3000 "
    f"THEN {{'chunks': acc.chunks, 'buf': acc.buf || p || {Q.NL2}}} "
    f"ELSE {{'chunks': CASE WHEN {Q.strip('acc.buf')} <> '' THEN list_append(acc.chunks, {Q.strip('acc.buf')}) "
    f"ELSE acc.chunks END, 'buf': p || {Q.NL2}}} END"
)
_PARA_STATE = f"list_reduce(string_split_regex(text, '\\n\\n+'), {_PARA_STEP}, {{'chunks': []::VARCHAR[], 'buf': ''}})"


@register("paragraph_chunks", _explode_sql(f"(SELECT doc_id, {_PARA_STATE} AS st FROM {PARA_DOCS_SQL})",
                                           Q.chunk_finish("st")))
def q_paragraph_chunks(spark, d):
    """raw paragraphs packed strictly under 3000 chars, no overlap (lines as paragraphs)."""
    out = explode_chunks(_para_docs(spark, d), paragraph_chunks("text", 3000), ["doc_id"])
    return out.withColumn("chunk_len", F.length("chunk"))


def _rec_sql(max_tokens: int = 1000, overlap: int = 100) -> str:
    toks = "list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"
    paras = (f"list_filter(list_transform(string_split_regex({Q.normalize_newlines('text')}, '\\n\\n+'), "
             f"lambda x: {Q.strip('x')}), lambda x: x <> '')")
    sentences = ("string_split(regexp_replace(x, '([.!?])\\s+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1))")
    units = (f"flatten(list_transform({paras}, lambda x: CASE WHEN len({toks.format(x='x')}) > {max_tokens} "
             f"THEN {sentences} ELSE [x] END))")
    ut = toks.format(x="u")
    tail = f"list_slice(acc.toks, greatest(len(acc.toks) - {overlap} + 1, 1), len(acc.toks))"
    step = (f"lambda acc, u: CASE WHEN len(acc.toks) + len({ut}) <= {max_tokens} OR len(acc.toks) = 0 "
            f"THEN {{'chunks': acc.chunks, 'toks': list_concat(acc.toks, {ut})}} "
            f"ELSE {{'chunks': list_append(acc.chunks, array_to_string(acc.toks, ' ')), "
            f"'toks': list_concat({tail}, {ut})}} END")
    state = f"list_reduce({units}, {step}, {{'chunks': []::VARCHAR[], 'toks': []::VARCHAR[]}})"
    finish = "CASE WHEN len(st.toks) > 0 THEN list_append(st.chunks, array_to_string(st.toks, ' ')) ELSE st.chunks END"
    return _explode_sql(f"(SELECT doc_id, {state} AS st FROM {PARA_DOCS_SQL})", finish)


@register("recursive_chunks", _rec_sql())
def q_recursive_chunks(spark, d):
    """paragraph/sentence units packed to 1000 whitespace tokens with 100 tokens of overlap."""
    out = explode_chunks(_para_docs(spark, d), recursive_chunks("text", 1000, 100), ["doc_id"])
    return out.withColumn("chunk_len", F.length("chunk"))


# Stand-in orders: a phrase in the middle, at the end, twice in a row, in another case, or not at all.
SQL_ORDERED = """
    ordered AS (SELECT doc_id, CASE doc_id % 5
        WHEN 0 THEN left(text, 40) || ' IT IS SO ORDERED ' || substr(text, 41)
        WHEN 1 THEN text || ' \t IT IS SO ORDERED'
        WHEN 2 THEN 'IT IS SO ORDERED' || 'IT IS SO ORDERED' || text
        WHEN 3 THEN text || ' it is so ordered' ELSE text END AS text FROM documents)"""


def _ordered_docs(spark, d):
    phrase, t, n = F.lit(BOILERPLATE[0]), F.col("text"), F.col("doc_id") % 5
    text = (F.when(n == 0, F.concat(F.substring(t, 1, 40), F.lit(" "), phrase, F.lit(" "), F.expr("substring(text, 41)")))
            .when(n == 1, F.concat(t, F.lit(" \t "), phrase)).when(n == 2, F.concat(phrase, phrase, t))
            .when(n == 3, F.concat(t, F.lit(" it is so ordered"))).otherwise(t))
    return _docs(spark, d).select("doc_id", text.alias("text"))


@register("boilerplate", "WITH " + SQL_ORDERED.replace("\t", "' || chr(9) || '") + f"""
    SELECT doc_id,
           {Q.strip("regexp_replace(regexp_replace(text, 'IT IS SO ORDERED', ' ', 'g'), '[ \\t]{2,}', ' ', 'g')")} AS text
    FROM ordered""")
def q_boilerplate(spark, d):
    """a boilerplate phrase removed from documents, three in five of which hold it."""
    return _ordered_docs(spark, d).select("doc_id", remove_boilerplate("text", BOILERPLATE).alias("text"))


# Stand-in citations: reporters whose points look like sentence ends, so that chunks may end inside one.
CITED = ". See 12 F. Supp. 345 and 410 U. S. 113; "
AUDIT_SIZE, AUDIT_OVERLAPS = 1200, (500, 10, 0)


def _cut_sql(overlap):
    fold = (f"list_reduce({Q.units('text', AUDIT_SIZE)}, lambda acc, x: CASE WHEN acc.e - acc.s + length(x.u) + length(x.sep) <= {AUDIT_SIZE} "
            "THEN {'spans': acc.spans, 's': acc.s, 'e': acc.e + length(x.u) + length(x.sep)} "
            "ELSE {'spans': list_append(acc.spans, {'s': acc.s, 'e': acc.e}), "
            f"'s': acc.e - least({overlap}, acc.e - acc.s), 'e': acc.e + length(x.u) + length(x.sep)}} END, "
            "{'spans': []::STRUCT(s BIGINT, e BIGINT)[], 's': 0::BIGINT, 'e': 0::BIGINT})")
    return fold


SQL_CITED = f"""
    cited AS (SELECT doc_id, replace(text, '. ', '{CITED}') AS text FROM documents),
    packed AS (SELECT doc_id, array_to_string(list_transform({Q.units('text', AUDIT_SIZE)}, lambda x: x.u || x.sep), '') AS p,
                      {", ".join(f"{_cut_sql(o)} AS st{o}" for o in AUDIT_OVERLAPS)} FROM cited),
    parts AS (SELECT *, string_split(regexp_replace(p, '{CITATION_RE}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS part FROM packed),
    placed AS (SELECT *, list_transform(range(2, len(part) + 1), lambda i: {{
                      's': list_sum(list_transform(part[1:i - 1], lambda x: length(x))) - (i - 2),
                      'e': list_sum(list_transform(part[1:i - 1], lambda x: length(x))) - (i - 2) + position(chr(2) IN part[i]) - 1}}) AS hits
               FROM parts)"""


def _count_cut_sql(overlap):
    spans = f"list_append(st{overlap}.spans, {{'s': st{overlap}.s, 'e': st{overlap}.e}})"
    return (f"CAST(len(list_filter(hits, lambda c: len(list_filter({spans}, lambda x: x.s <= c.s AND x.e >= c.e)) = 0)) AS INTEGER) "
            f"AS cut_overlap_{overlap}")


@register("citation_audit", "WITH " + SQL_CITED + f"""
    SELECT doc_id, CAST(len(hits) AS INTEGER) AS citations, {", ".join(map(_count_cut_sql, AUDIT_OVERLAPS))} FROM placed""")
def q_citation_audit(spark, d):
    """citations of each document and how many lie whole in no chunk, for three overlaps."""
    cited = _docs(spark, d).select("doc_id", F.replace("text", F.lit(". "), F.lit(CITED)).alias("text"))
    audit = cited.select("doc_id", cut_matches("text", CITATION_RE, [(AUDIT_SIZE, o) for o in AUDIT_OVERLAPS]).alias("a"))
    return audit.select(
        "doc_id", F.col("a.matches").alias("citations"), *[F.col("a.cuts")[n].alias(f"cut_overlap_{o}") for n, o in enumerate(AUDIT_OVERLAPS)])


@register("header_variants", LAKE_PREFIX + f""",
    tb AS (SELECT opinion_id, case_name, court, year, citation,
                  {Q.effective_text('plain_text', 'html_with_citations', 'chunk')} AS body FROM lake),
    tb2 AS (SELECT * FROM tb WHERE length(body) >= 150),
    ch AS ({Q.chunks_cte('tb2', 'opinion_id, case_name, court, year, citation', 'body')})
    SELECT opinion_id, CAST(chunk_index AS INTEGER) AS chunk_index,
           '[Case: ' || case_name || ' | Court: ' || {Q.court_label('court')} || ' | Date: ' || CAST(year AS VARCHAR)
               || ']' || {Q.NL2} || chunk AS case_court_date,
           'Source: ' || concat_ws(', ', case_name, CASE WHEN citation <> '' THEN citation END)
               || '. Court: ' || {Q.court_label('court')} || '. Date: ' || CAST(year AS VARCHAR) || '.'
               || {Q.NL2} || chunk AS source_sentence
    FROM ch""")
def q_header_variants(spark, d):
    """both alternative header layouts over every opinion chunk."""
    tb = text_bearing(lake_opinions(spark, d))
    ch = explode_chunks(tb, legal_chunks("body"), ["opinion_id", "case_name", "court", "year", "citation"])
    label = court_label("court")
    return ch.select(
        "opinion_id", "chunk_index",
        enrich_variant("case_court_date", "chunk", "case_name", label, "year", "citation").alias("case_court_date"),
        enrich_variant("source_sentence", "chunk", "case_name", label, "year", "citation").alias("source_sentence"),
    )


@register("snapshot_csv_roundtrip", S.standin_ctes("opinions_raw") + """
    SELECT nullif(id, '') AS id, nullif(cluster_id, '') AS cluster_id, nullif(type, '') AS type,
           nullif(plain_text, '') AS plain_text, nullif(html_with_citations, '') AS html_with_citations
    FROM opinions_raw""")
def q_snapshot_csv_roundtrip(spark, d):
    """Opinions written as a bz2 CSV snapshot (multi-line, quoted) and read back."""
    from caselake.session import scratch_path
    from caselake.sources.snapshots import SNAPSHOT_COLUMNS, scan_snapshot_csv

    path = scratch_path(spark, "opinions-snapshot")
    (S.opinions_raw(spark, d).write.option("header", True).option("escape", '"')
     .option("compression", "bzip2").mode("overwrite").csv(path))
    return scan_snapshot_csv(spark, path, SNAPSHOT_COLUMNS["opinions"])


@register("snapshot_by_header", S.standin_ctes("opinions_raw") + """
    SELECT nullif(id, '') AS id, nullif(cluster_id, '') AS cluster_id, nullif(type, '') AS type,
           nullif(plain_text, '') AS plain_text, nullif(html_with_citations, '') AS html_with_citations
    FROM opinions_raw""")
def q_snapshot_by_header(spark, d):
    """A snapshot whose files list more columns, in another order, and hold malformed rows."""
    from caselake.session import scratch_path
    from caselake.sources.snapshots import SNAPSHOT_COLUMNS, scan_snapshot_csv

    path = scratch_path(spark, "wide-snapshot")
    rows = S.opinions_raw(spark, d)
    wide = rows.select(
        F.lit("2020-01-01").alias("date_created"), "html_with_citations", "type", "id",
        F.concat(F.lit("line one\nof \""), "id", F.lit('"')).alias("notes"), "plain_text", "cluster_id")
    wide.write.option("header", True).option("escape", '"').option("compression", "bzip2").csv(path)
    # A row of two fields next to each record: the header asks for seven. Each task writes its own file.
    heading = ",".join(wide.columns)

    def with_header(batches):
        import pyarrow as pa

        for n, batch in enumerate(batches):
            first = [heading] if n == 0 else []
            yield pa.RecordBatch.from_arrays([pa.array(first + batch.column(0).to_pylist())], names=["value"])

    broken = rows.select(F.concat(F.lit("broken"), "id", F.lit(",row")).alias("value")).mapInArrow(with_header, "value string")
    broken.write.mode("append").option("compression", "bzip2").text(path)
    return scan_snapshot_csv(spark, path, SNAPSHOT_COLUMNS["opinions"])


@register("export_jsonl", LAKE_PREFIX.split(",\n    o AS")[0] + " SELECT * FROM clusters")
def q_export_jsonl(spark, d):
    """K9: enriched clusters exported as JSON lines and read back with their schema."""
    from caselake.operators.sinks import export_jsonl
    from caselake.session import scratch_path

    clusters = staged_clusters(spark, d)
    path = scratch_path(spark, "clusters-jsonl")
    export_jsonl(clusters, path)
    return spark.read.schema(clusters.schema).json(path)


@register("scan_vectors", "WITH " + Q.hash_vectors("dv", "documents", "doc_id", "text", 64) + """,
    made AS (SELECT d.doc_id, list(coalesce(dv.v, CAST(0 AS FLOAT)) ORDER BY g.b) AS vector
             FROM documents d CROSS JOIN range(64) g(b) LEFT JOIN dv ON dv.id = d.doc_id AND dv.b = g.b GROUP BY d.doc_id)
    SELECT d.doc_id, d.lang, e.label, CAST(len(coalesce(e.embedding, made.vector)) AS INTEGER) AS dims, e.vec_id IS NULL AS missing,
           coalesce(CAST(e.embedding AS FLOAT[]), made.vector) AS vector
    FROM documents d LEFT JOIN embeddings e ON d.doc_id = e.vec_id JOIN made ON made.doc_id = d.doc_id""")
def q_scan_vectors(spark, d):
    """Every document with its ready-made vector, or with a computed one where there is none."""
    import os

    from caselake.sources.lake import attach_vectors, scan_vectors

    e = scan_vectors(spark, os.path.join(d, "embeddings.parquet")).select(
        F.col("vec_id").alias("doc_id"), "label", F.col("embedding").cast("array<float>").alias("vector"))
    return attach_vectors(_docs(spark, d).select("doc_id", "lang", "text"), e, "doc_id").select(
        "doc_id", "lang", "label", F.size("vector").alias("dims"), "missing", "vector")


@register("lake_publish", LAKE_PREFIX + """
    SELECT opinion_id, court, year, 'before' AS reader FROM lake WHERE year < 1997
    UNION ALL SELECT opinion_id, court, year, 'after' AS reader FROM lake
    UNION ALL SELECT CAST(max(year) AS VARCHAR) || '-12-31' AS opinion_id, 'marker' AS court, max(year) AS year, 'after' AS reader FROM lake""")
def q_lake_publish(spark, d):
    """K6 K3: a lake is published, a reader resolves it, the lake is rewritten, another reader resolves
    it; the marker of the newest year is read from its own folder."""
    from caselake.operators.sinks import publish_version, published_path, write_by_court, write_marker
    from caselake.session import scratch_path

    root, opinions = scratch_path(spark, "published-lake"), lake_opinions(spark, d)
    publish_version(spark, root, lambda folder: write_by_court(opinions.where("year < 1997"), folder))
    before = spark.read.parquet(published_path(spark, root))
    publish_version(spark, root, lambda folder: write_by_court(opinions, folder))
    after = spark.read.parquet(published_path(spark, root))
    newest = after.agg(F.max("year")).first()[0]
    write_marker(spark, f"{newest}-12-31", f"{root}-marker")
    marker = spark.read.text(f"{root}-marker").select(
        F.col("value").alias("opinion_id"), F.lit("marker").alias("court"), F.left("value", F.lit(4)).cast("int").alias("year"), F.lit("after").alias("reader"))
    rows = [x.select("opinion_id", "court", "year", F.lit(name).alias("reader")) for x, name in ((before, "before"), (after, "after"))]
    return rows[0].union(rows[1]).union(marker)


@register("court_folders", LAKE_PREFIX + """,
    asked AS (SELECT unnest(['BUILDING', 'MACHINERY', 'nowhere']) AS court)
    SELECT a.court, count(l.opinion_id) AS opinions, a.court NOT IN (SELECT court FROM lake) AS missing
    FROM asked a LEFT JOIN lake l ON l.court = a.court GROUP BY a.court""")
def q_court_folders(spark, d):
    """Three courts are asked for, one of which has no folder: it is named, the others are read."""
    import warnings

    from caselake.operators.sinks import write_by_court
    from caselake.session import scratch_path
    from caselake.sources.lake import missing_courts, scan_courts

    path, asked = scratch_path(spark, "court-lake"), ["BUILDING", "MACHINERY", "nowhere"]
    write_by_court(lake_opinions(spark, d), path)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        read = scan_courts(spark, path, asked)
    counts = read.groupBy("court").agg(F.count(F.lit(1)).alias("opinions"))
    missing = missing_courts(spark, path, asked)
    courts = spark.createDataFrame([(c, c in missing) for c in asked], "court string, missing boolean")
    return courts.join(counts, "court", "left").select("court", F.coalesce("opinions", F.lit(0)).alias("opinions"), "missing")


@register("snapshot_dates", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS snapshot_date FROM orders""")
def q_snapshot_dates(spark, d):
    """S3: the date in a snapshot's path, which every third path does not have."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.lit("opinions-2024-2-9")).otherwise(F.concat(F.lit("opinions-"), day, F.lit("-to-2031-01-01")))
    path = F.concat(F.lit("s3a://bulk/v1/"), name, F.lit(".csv.bz2"))
    return S.table(spark, d, "orders").select("o_orderkey", snapshot_date(path).alias("snapshot_date"))


@register("title_files", """
    SELECT DISTINCT 'sc_title_' || role || '.jsonl' AS file_name FROM conversations""")
def q_title_files(spark, d):
    """Title files on disk, beside training splits and other files, listed without those."""
    from caselake.session import scratch_path
    from caselake.sources.statutes import discover_title_files

    root, parts = scratch_path(spark, "title-files"), scratch_path(spark, "title-parts")
    lines = S.statute_lines(spark, d)
    roles = [r["file"].removeprefix("sc_title_").removesuffix(".jsonl") for r in lines.select("file").distinct().collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(conf)
    fs.mkdirs(path(root))
    names = [n for r in roles for n in (f"sc_title_{r}.jsonl", f"sc_title_{r}_train.jsonl", f"sc_title_{r}_val.jsonl", f"other_{r}.jsonl")]
    kinds = F.transform(F.array(*[F.lit(x) for x in ("", "_train", "_val", "other")]), lambda k: F.when(
        k == "other", F.replace("file", F.lit("sc_title"), F.lit("other"))).otherwise(F.concat(F.substring_index("file", ".", 1), k, F.lit(".jsonl"))))
    # A file is a group of its own name's lines, so each name has one.
    lines.select(F.explode(kinds).alias("name"), "value").repartition("name").write.partitionBy("name").text(parts)
    for name in names:
        for n, found in enumerate(fs.globStatus(path(f"{parts}/name={name}/part-*"))):
            assert n == 0
            fs.rename(found.getPath(), path(f"{root}/{name}"))
    return discover_title_files(spark, root).select("file_name")


@register("stage_counts", LAKE_PREFIX + """
    SELECT 'dockets' AS stage, (SELECT count(*) FROM d) AS rows
    UNION ALL SELECT 'clusters', (SELECT count(*) FROM clusters) UNION ALL SELECT 'opinions', (SELECT count(*) FROM lake)""")
def q_stage_counts(spark, d):
    """A5 K1 K2: the three stages of the lake written one after another; their rows as the writes counted them."""
    from caselake.plans.lake_etl import run_lake_etl
    from caselake.session import scratch_path

    counts = run_lake_etl(spark, S.dockets_raw(spark, d), S.clusters_raw(spark, d), S.citations_raw(spark, d), S.opinions_raw(spark, d),
                          scratch_path(spark, "counted-lake"), courts=S.STANDIN_COURTS, publish=True)
    return spark.createDataFrame(list(counts.items()), "stage string, rows bigint")


@register("year_labels", """
    WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 1990 + c_custkey % 7 END AS a, CASE WHEN c_custkey % 4 > 0 THEN 2000 + c_custkey % 9 ELSE 0 END AS b FROM customer)
    SELECT c_custkey, CASE WHEN a IS NOT NULL AND b > 0 THEN a || '–' || b WHEN a IS NOT NULL THEN 'from ' || a
                           WHEN b > 0 THEN 'up to ' || b ELSE 'all years' END AS label,
           coalesce(CAST(a AS VARCHAR), 'all') || '_' || CASE WHEN b > 0 THEN CAST(b AS VARCHAR) ELSE 'all' END AS tag FROM r""")
def q_year_labels(spark, d):
    """label and tag of year ranges that are open at either end, both or none."""
    key = F.col("c_custkey")
    a = F.when(key % 3 > 0, F.lit(1990) + key % 7)
    b = F.when(key % 4 > 0, F.lit(2000) + key % 9).otherwise(0)
    return S.table(spark, d, "customer").select("c_custkey", year_label_of(a, b).alias("label"), year_tag_of(a, b).alias("tag"))


@register("stream_batches", LAKE_PREFIX + """
    SELECT count(*) AS input_rows, true AS one_file_each, count(DISTINCT court) AS files FROM lake""")
def q_stream_batches(spark, d):
    """A lake of one file for each court, streamed file by file; rows by the query's own progress."""
    from caselake.session import scratch_path
    from caselake.streaming.incremental import incremental_chunks

    lake, sink, done = (scratch_path(spark, f"batches-{x}") for x in ("lake", "sink", "ckpt"))
    # Small row groups, so that one file's batch is read by many tasks.
    lake_opinions(spark, d).repartition("court").write.partitionBy("court").option("parquet.block.size", str(16 << 20)).parquet(lake)
    query = incremental_chunks(spark, lake, spark.read.parquet(lake).schema, sink, done, max_files_per_trigger=1)
    query.awaitTermination()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    files = len(spark.read.parquet(lake).inputFiles())
    return spark.createDataFrame([(sum(batches), len(batches) == files, files)], "input_rows bigint, one_file_each boolean, files bigint")

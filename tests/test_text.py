"""Edge rows for the scalar functions, joins and aggregates (FIXTURES §3)."""

import pytest
from pyspark.sql import functions as F

from caselake.functions import text as T
from caselake.functions.enrich import enrich_chunk, enrich_statute, statute_body
from caselake.operators.aggregates import (
    aggregate_citations,
    court_docket_counts,
    court_storage_estimate,
    grand_totals,
)
from caselake.operators.dedup import dedup_first, dedup_last, insert_or_ignore
from caselake.operators.joins import attach_citations, skip_done
from caselake.sources.courts import court_label, court_dimension, search_courts
from caselake.sources.lake import filter_year_range


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_year_of(spark):
    assert col_values(spark, ["1999-05-01", "1999", "abc", "ab12-01-01", None], T.year_of) == [1999, 1999, 0, 0, 0]


def test_best_case_name(spark):
    df = spark.createDataFrame([(" ", "S", None), (None, None, None), (" A ", "x", "y")], "a string, b string, c string")
    assert [r[0] for r in df.select(T.best_case_name("a", "b", "c")).collect()] == ["S", "Unknown", "A"]


def test_citation_parts_and_aggregate(spark):
    cites = spark.createDataFrame(
        [("1", "1", "S.C.", "2"), ("2", "1", " ", "2"), ("3", None, "S.C.", "2"), ("4", "b", "x", "1"), ("4", "a", "x", "1")],
        "cluster_id string, volume string, reporter string, page string")
    agg = {r["cluster_id"]: r["citation"] for r in aggregate_citations(cites).collect()}
    assert agg == {"1": "1 S.C. 2", "4": "a x 1, b x 1"}
    clusters = spark.createDataFrame([("4",), ("9",)], "cluster_id string")
    out = {r["cluster_id"]: r["citation"] for r in attach_citations(clusters, aggregate_citations(cites)).collect()}
    assert out == {"4": "a x 1, b x 1", "9": ""}


def test_effective_text_rules(spark):
    html = "<p>" + "h" * 200 + "</p>"
    df = spark.createDataFrame([("p" * 149, html), ("q" * 150, html), ("  ", " ")], "plain string, html string")
    lake = [r[0] for r in df.select(T.effective_text("plain", "html", "lake")).collect()]
    assert lake == ["h" * 200, "q" * 150, ""]
    chunk = [r[0] for r in df.select(T.effective_text("plain", "html", "chunk")).collect()]
    assert chunk[0] == "p" * 149 and len(chunk[0]) < 150  # dropped later by the 150 limit


def test_strip_html(spark):
    got = col_values(spark, ["a<b>c</b>\n d", "<script>x</script>", "&amp;", None], T.strip_html)
    assert got == ["a c d", "x", "&amp;", ""]


def test_strip_unicode(spark):
    assert col_values(spark, ["  a  ", "\n\ta\t\n", "\x1ca\x1f"], T.strip) == ["a", "a", "a"]


def test_opinion_type(spark):
    assert col_values(spark, [None, "", " Lead "], T.opinion_type) == ["Lead", "", "Lead"]
    assert col_values(spark, [""], lambda c: T.opinion_type(c, blank_is_lead=True)) == ["Lead"]
    assert col_values(spark, ["x" * 60], lambda c: T.truncate(T.opinion_type(c), 50)) == ["x" * 50]


def test_year_range(spark):
    df = spark.createDataFrame([(y,) for y in (1999, 2000, 2010, 2011, 0)], "year int")
    assert sorted(r[0] for r in filter_year_range(df, 2000, 2010).collect()) == [2000, 2010]
    assert sorted(r[0] for r in filter_year_range(df, 2000, 2010, keep_unknown=True).collect()) == [0, 2000, 2010]
    assert len(filter_year_range(df).collect()) == 5


def test_int_or_zero(spark):
    assert col_values(spark, ["12", "5A", "", None, "9" * 30], T.int_or_zero) == [12, 0, 0, 0, 0]
    assert col_values(spark, [None, "", "0", "3"], lambda c: T.int_or_zero(c, default=1)) == [1, 1, 0, 3]
    assert col_values(spark, ["https://x/y/123/", "https://x/abc"], T.path_tail_id) == [123, 0]


def test_format_bytes(spark):
    vals = [999, 999_999, 1_000_000, 1_000_000_000, 1_050_000, 1_250_000, 2_675_000_000, 1_234_567_890_123]
    got = col_values(spark, vals, T.format_bytes, "bigint")
    want = [f"{n // 1000} KB" if n < 1e6 else f"{n / 1e6:.1f} MB" if n < 1e9 else f"{n / 1e9:.2f} GB" for n in vals]
    assert got == want
    assert got[:4] == ["0 KB", "999 KB", "1.0 MB", "1.00 GB"]


def test_court_estimate(spark):
    dockets = spark.createDataFrame([("x",)] * 10 + [(" ",), (None,)], "court_id string")
    row = court_storage_estimate(court_docket_counts(dockets)).collect()
    assert [tuple(r) for r in row] == [("x", 10, 22, 66, 330000, "330 KB")]
    tot = grand_totals(dockets).first()
    assert (tot["total_dockets"], tot["total_courts"]) == (12, 1)
    # int(n * 2.2) parity over a range of counts
    counts = spark.range(1, 5001).select(F.lit("c").alias("court_id"), F.col("id").alias("dockets"))
    got = [r["est_opinions"] for r in court_storage_estimate(counts).orderBy("dockets").collect()]
    assert got == [int(n * 2.2) for n in range(1, 5001)]


def test_percent_done(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (1, 16), (2, 3)], "d bigint, t bigint")
    got = [r[0] for r in df.select(T.percent_done("d", "t")).collect()]
    assert got == [0.0, 33.3, round(1 / 16 * 100, 1), round(2 / 3 * 100, 1)]


def test_enrich_chunk(spark):
    df = spark.createDataFrame([("c", "N", "sc", 2001, "Lead", ""), ("c", "N", "zz", 2001, "Lead", "1 S.C. 2")],
                               "chunk string, name string, court string, year int, t string, cit string")
    got = [r[0] for r in df.select(enrich_chunk("chunk", "name", court_label("court"), "year", "t", "cit")).collect()]
    assert got == ["[Source: N | Court: SC Supreme Court | Year: 2001 | Opinion Type: Lead]\n\nc",
                   "[Source: N | Court: zz | Year: 2001 | Opinion Type: Lead | Citation: 1 S.C. 2]\n\nc"]


def test_enrich_statute(spark):
    df = spark.createDataFrame([("1-2", "5", " Motor ", "3", " DMV ", "b"), ("1-2", None, "Motor", None, None, "b"),
                                ("1-2", None, None, "", "", "b")],
                               "s string, tn string, name string, ch string, short string, body string")
    got = [r[0] for r in df.select(enrich_statute("s", "tn", "name", "ch", "short", "body")).collect()]
    assert got == ["[SC Code § 1-2 | Title 5: Motor | Chapter 3 | DMV]\n\nb",
                   "[SC Code § 1-2 | Motor]\n\nb", "[SC Code § 1-2]\n\nb"]
    b = spark.createDataFrame([("", " t "), ("  ", "t"), (None, None)], "a string, b string")
    assert [r[0] for r in b.select(statute_body("a", "b")).collect()] == ["t", "", ""]


def test_statute_filter_and_parse(spark):
    from caselake.plans.statutes import active_statutes
    from caselake.sources.statutes import parse_statute_lines

    lines = spark.createDataFrame([
        ('{"doc_id": "1", "status": "repealed", "body_text": "' + "x" * 60 + '"}',),
        ('{"doc_id": "2", "body_text": "' + "x" * 60 + '"}',),
        ('{"doc_id": "3", "body_text": "' + "x" * 49 + '"}',),
        ('{"doc_id": "4", "body_text": "' + "x" * 50 + '", "title_num": 5}',),
        ("{not json",),
        ("   ",),
        ('{"doc_id": "5", "status": null, "text": "' + "y" * 50 + '"}',),
    ], "value string")
    recs = parse_statute_lines(lines)
    assert sorted(r["doc_id"] for r in recs.collect()) == ["1", "2", "3", "4", "5"]
    kept = active_statutes(recs)
    assert sorted(r["doc_id"] for r in kept.collect()) == ["2", "4", "5"]
    assert [r["title_num"] for r in recs.where("doc_id = '4'").collect()] == ["5"]


def test_dedup_and_insert_or_ignore(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "z")], "k int, o int, p string")
    assert sorted(tuple(r) for r in dedup_first(df, "k", "o").collect()) == [(1, 1, "a"), (2, 5, "z")]
    assert sorted(tuple(r) for r in dedup_last(df, "k", "o").collect()) == [(1, 2, "b"), (2, 5, "z")]
    target = spark.createDataFrame([(1, 9, "t")], "k int, o int, p string")
    assert [tuple(r) for r in insert_or_ignore(df, target, "k", "o").collect()] == [(2, 5, "z")]


def test_resume_anti(spark):
    src = spark.createDataFrame([("1",), ("2",), ("3",)], "opinion_id string")
    done = spark.createDataFrame([("1",), ("3",)], "opinion_id string")
    assert [r[0] for r in skip_done(src, done, "opinion_id").collect()] == ["2"]
    assert skip_done(src, src, "opinion_id").count() == 0


def test_court_dimension_and_search(spark):
    dim = court_dimension(spark)
    assert dim.count() == 106
    sc = {r["id"]: r for r in dim.collect()}
    assert sc["sc"]["label"] == "SC Supreme Court" and sc["sc"]["in_ingest"] and sc["ala"]["label"] == "ala"
    assert {r["group"] for r in sc.values()} == {None}  # groups come with names only, never by a guess
    assert {r["id"] for r in search_courts(dim, " SUPREME ").collect()} == {"sc", "scotus"}
    assert search_courts(dim, "  ").count() == 106


def test_label_courts_join(spark):
    from caselake.operators.joins import label_courts

    dim = court_dimension(spark)
    rows = spark.createDataFrame([("sc",), ("zz",), ("ca4",)], "court string")
    got = {r["court"]: r["court_label"] for r in label_courts(rows, dim).collect()}
    assert got == {"sc": "SC Supreme Court", "zz": "zz", "ca4": "4th Circuit Court of Appeals"}


def test_latest_snapshot(spark, tmp_path):
    from caselake.sources.snapshots import latest_snapshot, latest_snapshot_path

    for name in ("dockets-2024-01-31.csv.bz2", "dockets-2024-03-31.csv.bz2", "dockets-2025-01-01.csv.gz",
                 "opinions-2026-01-01.csv.bz2"):
        (tmp_path / name).write_bytes(b"x")
    row = latest_snapshot(spark, str(tmp_path), "dockets").first()
    assert row["file_name"] == "dockets-2024-03-31.csv.bz2" and row["snapshot_date"] == "2024-03-31"
    with pytest.raises(FileNotFoundError):
        latest_snapshot_path(spark, str(tmp_path), "citations")


def test_snapshot_csv_malformed_rows(spark, tmp_path):
    from caselake.sources.snapshots import scan_snapshot_csv

    p = tmp_path / "s.csv"
    p.write_text('id,court_id\n1,sc\n2,"multi\nline"\n3\n4,"a ""q"" b"\n')
    got = scan_snapshot_csv(spark, str(p), ("id", "court_id"))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "sc"), ("2", "multi\nline"), ("4", 'a "q" b')]
    # same rows whatever the projection (no pruning-dependent DROPMALFORMED)
    assert got.select("id").count() == 3


def test_court_dimension_with_names(spark):
    names = spark.createDataFrame([("sc", "South Carolina Supreme Court", "State")], "id string, name string, group string")
    dim = {r["id"]: r for r in court_dimension(spark, names=names).collect()}
    assert dim["sc"]["name"] == "South Carolina Supreme Court" and dim["sc"]["group"] == "State"
    assert dim["sc"]["label"] == "SC Supreme Court" and dim["ala"]["name"] == "ala"


def test_truncate_counts_code_points(spark):
    vals = ["\U0001F600abc", "é" * 70, None]
    got = col_values(spark, vals, lambda c: T.truncate(c, 2))
    assert got == ["\U0001F600a", "éé", None]
    assert got[:2] == [v[:2] for v in vals[:2]]  # same as Python slicing (D13)

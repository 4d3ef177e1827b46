"""File-level pipeline: CSV snapshots -> staged Parquet -> lake stages; statute files; sinks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from caselake.functions.text import year_label, year_tag
from caselake.operators.aggregates import ingest_progress
from caselake.operators.joins import lookup_or_default
from caselake.operators.sinks import (
    check_sink_schema,
    write_chunk_vectors,
    write_marker,
    write_stage,
    write_stats_json,
)
from caselake.plans import queries as QQ
from caselake.plans.lake_etl import run_lake_etl
from caselake.plans.stats import court_stats, court_totals
from caselake.sources import standins as S
from caselake.sources.lake import scan_courts, stage_done, stage_path
from caselake.sources.snapshots import SNAPSHOT_COLUMNS, latest_snapshot_path, stage_snapshot
from caselake.sources.statutes import discover_title_files, scan_statutes_jsonl, title_file_paths
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_snapshot_to_lake(spark, tmp_path):
    raw = {
        "dockets": S.dockets_raw(spark, SF_SMALL),
        "opinion-clusters": S.clusters_raw(spark, SF_SMALL),
        "citations": S.citations_raw(spark, SF_SMALL),
        "opinions": S.opinions_raw(spark, SF_SMALL),
    }
    snaps = tmp_path / "snapshots"
    staged = {}
    for prefix, df in raw.items():
        for date in ("2024-01-31", "2024-02-29"):
            out = str(snaps / f"tmp-{prefix}-{date}")
            df.coalesce(1).write.option("header", True).option("escape", '"').option("compression", "bzip2").csv(out)
            part = [f for f in os.listdir(out) if f.endswith(".csv.bz2")][0]
            os.rename(os.path.join(out, part), str(snaps / f"{prefix}-{date}.csv.bz2"))
        path = latest_snapshot_path(spark, str(snaps), f"{prefix}-")
        assert path.endswith(f"{prefix}-2024-02-29.csv.bz2")
        staged[prefix] = stage_snapshot(spark, path, SNAPSHOT_COLUMNS[prefix], str(tmp_path / "staged" / prefix), 4)

    out_root = str(tmp_path / "lake")
    counts = run_lake_etl(spark, staged["dockets"], staged["opinion-clusters"], staged["citations"],
                          staged["opinions"], out_root, courts=S.STANDIN_COURTS, salt_buckets=2)
    lazy = QQ.lake_opinions(spark, SF_SMALL)
    # CSV turns '' into null; the lake stage maps both to '' again, so the lake matches
    assert counts["opinions"] == lazy.count()
    assert counts["dockets"] == QQ.lake_dockets(spark, SF_SMALL).count()
    lake = scan_courts(spark, os.path.join(out_root, "opinions"))
    assert _rows(lake.select(*lazy.columns)) == _rows(lazy)
    assert stage_done(spark, os.path.join(out_root, "clusters"))
    one = scan_courts(spark, os.path.join(out_root, "opinions"), ["BUILDING"])
    assert {r["court"] for r in one.select("court").distinct().collect()} == {"BUILDING"}
    with pytest.raises(ValueError):
        scan_courts(spark, os.path.join(out_root, "opinions"), [])


def test_statute_files(spark, tmp_path):
    recs = S.statute_lines(spark, SF_SMALL).collect()
    for r in recs:
        with open(tmp_path / r["file"].replace("sc_title_", "sc_title_01_"), "a") as f:
            f.write(r["value"] + "\n")
    (tmp_path / "sc_title_01_user.jsonl").open("a").write("\n{broken\n")
    (tmp_path / "sc_title_02_x_train.jsonl").write_text(json.dumps({"doc_id": "t"}) + "\n")
    names = [r["file_name"] for r in discover_title_files(spark, str(tmp_path)).collect()]
    assert names == sorted(names) and not any(n.endswith("_train.jsonl") for n in names)
    got = scan_statutes_jsonl(spark, title_file_paths(spark, str(tmp_path)))
    assert got.count() == len(recs)
    from caselake.sources.snapshots import row_total

    assert row_total(spark, title_file_paths(spark, str(tmp_path))).first()["rows"] == len(recs) + 1
    assert set(r["file"] for r in got.select("file").distinct().collect()) == set(names)
    with pytest.raises(FileNotFoundError):
        title_file_paths(spark, str(tmp_path / "none"))


def test_sinks_and_helpers(spark, tmp_path):
    chunks = QQ.QUERIES["enriched_opinion_chunks"](spark, SF_SMALL)
    from caselake.operators.sinks import OPINION_CHUNK_COLUMNS, STATUTE_CHUNK_COLUMNS

    check_sink_schema(chunks, OPINION_CHUNK_COLUMNS)
    check_sink_schema(QQ.QUERIES["statute_chunks"](spark, SF_SMALL), STATUTE_CHUNK_COLUMNS)
    with pytest.raises(ValueError):
        check_sink_schema(chunks, ["vector"])
    assert check_sink_schema(chunks, ["vector"], recreate=True) is False
    vec = chunks.withColumn("vector", F.array(F.lit(0.5).cast("float")))
    write_chunk_vectors(vec, str(tmp_path / "vectors"))
    back = spark.read.parquet(str(tmp_path / "vectors"))
    assert back.count() == chunks.count()
    prog = ingest_progress(back).first()
    assert prog["chunks_written"] == chunks.count()
    assert prog["opinions_processed"] == chunks.select("opinion_id").distinct().count()

    write_stage(QQ.lake_dockets(spark, SF_SMALL), str(tmp_path / "lake" / "dockets"))
    write_marker(spark, "2024-02-29", str(tmp_path / "lake" / "_snapshot"))
    assert os.path.isdir(tmp_path / "lake" / "dockets")  # the marker does not clobber siblings (D14)
    assert spark.read.text(str(tmp_path / "lake" / "_snapshot")).first()[0] == "2024-02-29"

    d = S.dockets_raw(spark, SF_SMALL)
    write_stats_json(court_stats(d), court_totals(d), str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats" / "courts")).count() == 5
    assert "scanned_at" in spark.read.json(str(tmp_path / "stats" / "totals")).columns

    base = spark.createDataFrame([("https://x/op/5/",), ("https://x/op/zz",)], "url string")
    from caselake.functions.text import path_tail_id
    keyed = base.withColumn("cluster_id", path_tail_id("url"))
    look = spark.createDataFrame([(5, "Roe")], "cluster_id long, case_name string")
    got = {r["cluster_id"]: r["case_name"] for r in lookup_or_default(keyed, look, "cluster_id",
                                                                      {"case_name": "Unknown"}).collect()}
    assert got == {5: "Roe", 0: "Unknown"}

    assert [year_label(2000, 2010), year_label(2000, None), year_label(None, 2010), year_label(None, None)] == \
        ["2000–2010", "from 2000", "up to 2010", "all years"]
    assert year_tag(2000, None) == "2000_all"
    assert stage_path("/r", "clusters", "2024-02-29", year_tag(2000, None)) == "/r/clusters_2024-02-29_2000_all"


def test_ingest_jobs_are_idempotent(spark, tmp_path):
    from caselake.operators.sinks import write_by_court
    from caselake.plans.chunks import opinion_chunks
    from caselake.plans.ingest import run_opinion_ingest, run_statute_ingest, sink_progress

    lake_root = str(tmp_path / "lake")
    opinions = QQ.lake_opinions(spark, SF_SMALL)
    write_by_court(opinions.where(F.col("year") <= 1998), lake_root)
    sink = str(tmp_path / "vectors")
    courts = list(S.STANDIN_COURTS)
    n1 = run_opinion_ingest(spark, lake_root, sink, courts=courts, dim=16)
    assert n1 == opinion_chunks(opinions.where(F.col("year") <= 1998)).count()
    assert run_opinion_ingest(spark, lake_root, sink, courts=courts, dim=16) == 0  # rerun adds nothing
    write_by_court(opinions.where(F.col("year") > 1998), lake_root, mode="append")
    n3 = run_opinion_ingest(spark, lake_root, sink, courts=courts, dim=16)
    total = opinion_chunks(opinions).count()
    assert n1 + n3 == total
    back = spark.read.parquet(sink)
    assert back.select("opinion_id", "chunk_index").distinct().count() == total
    assert back.where(F.size("vector") != 16).count() == 0
    assert sink_progress(spark, sink).first()["chunks_written"] == total

    titles = tmp_path / "titles"
    titles.mkdir()
    for r in S.statute_lines(spark, SF_SMALL).collect():
        with open(titles / r["file"], "a") as f:
            f.write(r["value"] + "\n")
    ssink = str(tmp_path / "statute_vectors")
    m1 = run_statute_ingest(spark, str(titles), ssink, dim=8)
    assert m1 == QQ.QUERIES["statute_chunks"](spark, SF_SMALL).count()
    assert run_statute_ingest(spark, str(titles), ssink, dim=8) == 0


def test_command_line_jobs(spark, tmp_path):
    from caselake.jobs import main

    snaps = tmp_path / "snaps"
    raw = {
        "dockets": S.dockets_raw(spark, SF_SMALL),
        "opinion-clusters": S.clusters_raw(spark, SF_SMALL),
        "citations": S.citations_raw(spark, SF_SMALL),
        "opinions": S.opinions_raw(spark, SF_SMALL),
    }
    for prefix, df in raw.items():
        out = str(snaps / f"tmp-{prefix}")
        df.coalesce(1).write.option("header", True).option("escape", '"').option("compression", "bzip2").csv(out)
        part = [f for f in os.listdir(out) if f.endswith(".csv.bz2")][0]
        os.rename(os.path.join(out, part), str(snaps / f"{prefix}-2024-02-29.csv.bz2"))
    lake = str(tmp_path / "lake")
    res = main(["lake-etl", "--snapshots", str(snaps), "--out", lake, "--courts", ",".join(S.STANDIN_COURTS)])
    assert res["snapshot_date"] == "2024-02-29"
    assert res["opinions"] == QQ.lake_opinions(spark, SF_SMALL).count()
    staged = os.path.join(lake, "_staged", "opinions_2024-02-29")
    stamp = os.path.getmtime(os.path.join(staged, "_SUCCESS"))
    again = main(["lake-etl", "--snapshots", str(snaps), "--out", lake, "--courts", ",".join(S.STANDIN_COURTS)])
    assert again["opinions"] == res["opinions"]
    assert os.path.getmtime(os.path.join(staged, "_SUCCESS")) == stamp  # same-date stage reused (S9)
    stats = main(["court-stats", "--snapshots", str(snaps), "--out", str(tmp_path / "stats")])
    assert stats["source"].endswith("dockets-2024-02-29.csv.bz2")
    ing = main(["ingest-opinions", "--lake", os.path.join(lake, "opinions"), "--sink", str(tmp_path / "vec"),
                "--courts", "BUILDING", "--start-year", "1996", "--dim", "8"])
    from caselake.plans.chunks import opinion_chunks

    want = opinion_chunks(QQ.lake_opinions(spark, SF_SMALL).where("court = 'BUILDING' AND year >= 1996")).count()
    assert ing["inserted"] == want


def test_snapshot_columns_come_by_header_name(spark, tmp_path):
    import pytest

    from caselake.sources.snapshots import scan_snapshot_csv, stage_snapshot

    p = tmp_path / "dockets.csv"
    p.write_text('court_id,date_created,id,notes\nscotus,2020,1,"a ""b""\nc"\nbroken,row\nca9,2021,2,\n')
    got = [tuple(r) for r in scan_snapshot_csv(spark, str(p), ("id", "court_id")).orderBy("id").collect()]
    assert got == [("1", "scotus"), ("2", "ca9")]
    assert stage_snapshot(spark, str(p), ("court_id",), str(tmp_path / "staged")).count() == 2
    with pytest.raises(ValueError, match="no column docket_number"):
        scan_snapshot_csv(spark, str(p), ("id", "docket_number"))


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from caselake.session import checkpoint_dir

    context = SimpleNamespace(applicationId="none", getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(conf={}, sparkContext=context))


def test_long_sentence_survives_whole(spark):
    from caselake.plans.chunks import opinion_chunks
    from caselake.plans.statutes import statute_chunk_rows

    words = "word " * 14_000 + "end"
    row = ("1", "2", "N" * 600, "a_court_with_a_long_identifier", 2000, "Lead", words, "", "C" * 600)
    lake = spark.createDataFrame([row], "opinion_id string, cluster_id string, case_name string, court string, year int, "
                                        "opinion_type string, plain_text string, html_with_citations string, citation string")
    got = opinion_chunks(lake).collect()
    assert any(words in r["text"] for r in got) and got[0]["court"] == row[3] and got[0]["case_name"] == row[2]
    assert max(len(r["text"]) for r in opinion_chunks(lake, widths={"text": 100}).collect()) == 100
    fields = "doc_id section_id title_num title_name chapter_num short_title body_text text status chunk_index chunk_total url".split()
    value = {"section_id": "s" * 70, "body_text": words, "status": "active"}
    one = spark.createDataFrame([tuple(value.get(f) for f in fields)], ", ".join(f"{f} string" for f in fields))
    kept = statute_chunk_rows(one).first()
    assert kept["section_id"] == "s" * 70 and kept["text"].endswith(words)


def test_a_missing_court_is_named_and_none_at_all_is_an_error(spark, tmp_path):
    import pytest

    from caselake.sources.lake import missing_courts

    root = str(tmp_path / "lake")
    rows = spark.createDataFrame([("1", "sc", 2000), ("2", "ca 9/x", 2001)], "opinion_id string, court string, year int")
    rows.write.partitionBy("court").parquet(root)
    with pytest.warns(UserWarning, match="no court scotus, zz"):
        got = scan_courts(spark, root, ["zz", "sc", "scotus", "ca 9/x"])
    assert sorted(r["court"] for r in got.collect()) == ["ca 9/x", "sc"]
    assert missing_courts(spark, root, ["sc", "zz"]) == ["zz"]
    with pytest.raises(FileNotFoundError, match="none of the courts scotus, zz"):
        scan_courts(spark, root, ["zz", "scotus"])


def test_readers_of_a_published_lake_see_one_version_whole(spark, tmp_path):
    import pytest

    from caselake.operators.sinks import publish_version, published_path

    root = str(tmp_path / "lake")
    rows = lambda n, court: spark.createDataFrame([(str(k), court, 2000) for k in range(n)], "opinion_id string, court string, year int")
    write = lambda df: lambda folder: df.write.partitionBy("court").parquet(folder)
    assert published_path(spark, root) == root
    first = publish_version(spark, root, write(rows(3, "sc")))
    before = scan_courts(spark, root)
    second = publish_version(spark, root, write(rows(5, "ca9")))
    assert published_path(spark, root) == second != first
    assert before.count() == 3 and scan_courts(spark, root, ["ca9"]).count() == 5

    def dies(folder):
        rows(9, "x").write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish_version(spark, root, dies)
    assert scan_courts(spark, root).count() == 5  # the old version is the current one
    publish_version(spark, root, write(rows(1, "sc")), keep=1)
    assert scan_courts(spark, root).count() == 1 and not os.path.exists(first) and not os.path.exists(second)


def test_status_is_carried_from_the_snapshot_to_the_chunks(spark):
    from caselake.operators.search import metadata_filter
    from caselake.plans.chunks import opinion_chunks
    from caselake.plans.lake_etl import clusters_stage, opinions_stage

    clusters = clusters_stage(S.clusters_raw_with_status(spark, SF_SMALL), QQ.staged_dockets(spark, SF_SMALL), S.citations_raw(spark, SF_SMALL))
    chunks = opinion_chunks(opinions_stage(S.opinions_raw(spark, SF_SMALL), clusters))
    status = {int(r["id"]): r["precedential_status"] or "" for r in S.clusters_raw_with_status(spark, SF_SMALL).collect()}
    rows = chunks.select("cluster_id", "precedential_status", "opinion_type").collect()
    assert rows and all(status[r["cluster_id"]] == r["precedential_status"] for r in rows)
    kept = chunks.where(metadata_filter(statuses=["Published"], opinion_types=["en"])).collect()
    assert len(kept) == sum(r["precedential_status"] == "Published" and r["opinion_type"] == "en" for r in rows) > 0
    assert "precedential_status" not in QQ.lake_clusters(spark, SF_SMALL).columns


def test_only_texts_without_a_vector_are_encoded(spark, tmp_path):
    import numpy as np

    from caselake.sources.lake import attach_vectors

    folder = str(tmp_path)

    def factory():
        def encode(texts):
            for t in texts:
                open(os.path.join(folder, t), "w").close()
            return np.ones((len(texts), 2))
        return encode

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, text string")
    vectors = spark.createDataFrame([(1, [0.5, 0.5]), (9, [0.1, 0.1])], "id long, vector array<float>")
    got = {r["id"]: (r["vector"], r["missing"]) for r in attach_vectors(rows, vectors, "id", encoder_factory=factory, dim=2).collect()}
    assert got == {1: ([0.5, 0.5], False), 2: ([1.0, 1.0], True), 3: ([1.0, 1.0], True)}
    assert sorted(os.listdir(folder)) == ["b", "c"]

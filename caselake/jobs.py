"""Command-line jobs (run with ``spark-submit`` or ``python -m caselake.jobs``).

    lake-etl          newest dockets/clusters/citations/opinions snapshots -> lake
    ingest-opinions   lake courts (+ year range) -> chunk rows with vectors
    ingest-statutes   statute title files -> headed rows with vectors
    court-stats       newest dockets snapshot -> per-court estimates (JSON)

Each job only composes library operators; sizes come from the cluster's
configuration (see ``session.recommended_conf``).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a script (spark-submit caselake/jobs.py ...)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caselake.session import get_session  # noqa: E402


def _lake_etl(spark, args) -> dict:
    from caselake.operators.sinks import write_marker
    from caselake.plans.lake_etl import run_lake_etl
    from caselake.sources.courts import LAKE_COURTS
    from caselake.sources.snapshots import SNAPSHOT_COLUMNS, latest_snapshot_path, scan_snapshot_csv, snapshot_columns, spread_rows
    from caselake.functions.text import DATE_RE, UNKNOWN_SNAPSHOT
    from caselake.sources.lake import stage_path
    from caselake.sources.stages import reuse_or_build

    import re

    staged, date = {}, UNKNOWN_SNAPSHOT
    for prefix in SNAPSHOT_COLUMNS:
        path = latest_snapshot_path(spark, args.snapshots, f"{prefix}-")
        columns = snapshot_columns(spark, path, prefix)
        m = re.search(DATE_RE, path)
        snap = m.group(1) if m else UNKNOWN_SNAPSHOT
        if prefix == "dockets":
            date = snap
        # A snapshot staged from the same file with the same columns is reused, not re-read
        target = stage_path(os.path.join(args.out, "_staged"), prefix, snap)
        staged[prefix] = reuse_or_build(
            spark, target, [path], {"columns": columns, "partitions": args.partitions},
            lambda path=path, columns=columns: spread_rows(scan_snapshot_csv(spark, path, columns), args.partitions))
    courts = args.courts.split(",") if args.courts else LAKE_COURTS
    counts = run_lake_etl(spark, staged["dockets"], staged["opinion-clusters"], staged["citations"],
                          staged["opinions"], args.out, courts=courts, salt_buckets=args.salt_buckets, publish=True)
    write_marker(spark, date, os.path.join(args.out, "_snapshot_date"))
    return {"snapshot_date": date, **counts}


def _ingest_opinions(spark, args) -> dict:
    from caselake.plans.ingest import run_opinion_ingest
    from caselake.sources.courts import INGEST_COURTS

    courts = args.courts.split(",") if args.courts else INGEST_COURTS
    n = run_opinion_ingest(spark, args.lake, args.sink, courts, args.start_year, args.end_year, dim=args.dim)
    return {"inserted": n}


def _ingest_statutes(spark, args) -> dict:
    from caselake.plans.ingest import run_statute_ingest

    return {"inserted": run_statute_ingest(spark, args.titles, args.sink, dim=args.dim)}


def _court_stats(spark, args) -> dict:
    from caselake.operators.sinks import write_stats_json
    from caselake.plans.stats import court_stats, court_totals
    from caselake.sources.snapshots import latest_snapshot_path, scan_snapshot_csv

    path = latest_snapshot_path(spark, args.snapshots, "dockets-")
    dockets = scan_snapshot_csv(spark, path, ("id", "court_id"))
    write_stats_json(court_stats(dockets), court_totals(dockets), args.out)
    return {"source": path, "out": args.out}


def main(argv=None) -> dict:
    parser = argparse.ArgumentParser(prog="caselake")
    sub = parser.add_subparsers(dest="job", required=True)
    p = sub.add_parser("lake-etl")
    p.add_argument("--snapshots", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--courts", default=None, help="comma-separated; default: the lake court set")
    p.add_argument("--partitions", type=int, default=None, help="spread of each staged snapshot")
    p.add_argument("--salt-buckets", type=int, default=None)
    p = sub.add_parser("ingest-opinions")
    p.add_argument("--lake", required=True)
    p.add_argument("--sink", required=True)
    p.add_argument("--courts", default=None, help="comma-separated; default: the ingest court set")
    p.add_argument("--start-year", type=int, default=None)
    p.add_argument("--end-year", type=int, default=None)
    p.add_argument("--dim", type=int, default=768)
    p = sub.add_parser("ingest-statutes")
    p.add_argument("--titles", required=True)
    p.add_argument("--sink", required=True)
    p.add_argument("--dim", type=int, default=768)
    p = sub.add_parser("court-stats")
    p.add_argument("--snapshots", required=True)
    p.add_argument("--out", required=True)
    args = parser.parse_args(argv)

    spark = get_session(app_name=f"caselake-{args.job}")
    jobs = {"lake-etl": _lake_etl, "ingest-opinions": _ingest_opinions,
            "ingest-statutes": _ingest_statutes, "court-stats": _court_stats}
    result = jobs[args.job](spark, args)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()

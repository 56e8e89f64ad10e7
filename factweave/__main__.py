"""spark-submit entry: `run` exports contacts from a table of fetched pages, `filter` keeps decision makers of a people file.

Exit codes: 0 done, 2 bad input, 3 nothing to export.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from .plans import run
from .sources.writers import NothingVerified


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="factweave")
    sub = p.add_subparsers(dest="what", required=True)
    r = sub.add_parser("run")
    r.add_argument("--fetches", required=True, help="Parquet: page_id, url, status_code, mime, html, fetched_at, blocked_by_robots")
    r.add_argument("--rendered", help="Parquet: page_id, html")
    r.add_argument("--include-all", action="store_true")
    r.add_argument("--decision-only", action="store_true")
    r.add_argument("--allow-free", action="store_true")
    r.add_argument("--print-ecr-summary", action="store_true")
    r.add_argument("--ecr-threshold", type=float, default=0.95)
    f = sub.add_parser("filter")
    f.add_argument("--people", required=True)
    for x in (r, f):
        x.add_argument("--out", required=True)
        x.add_argument("--min-level", choices=("C_SUITE", "VP_PLUS", "MGMT"), default="VP_PLUS")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if a.what == "filter":
            print(json.dumps({"kept": run.run_filter(spark, a.people, a.out, a.min_level)}))
            return 0
        rendered = spark.read.parquet(a.rendered) if a.rendered else None
        contacts = run.contacts_of(spark.read.parquet(a.fetches), rendered, a.allow_free)
        stats = run.export_all(contacts, a.out, run.Options(a.include_all, a.decision_only, a.min_level, a.allow_free, a.ecr_threshold))
        if a.print_ecr_summary:
            print(json.dumps(stats, default=str))
        return 0
    except NothingVerified as none:
        print(none, file=sys.stderr)
        return 3
    except AnalysisException as bad:
        print(bad.getMessage()[:500], file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

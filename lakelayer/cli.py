"""Command-line entry point for the marketplace pipeline.

    spark-submit --py-files lakelayer.zip lakelayer/cli.py all --landing <landing-dir> --lake <lake-dir> \
        --batch-id 2024-01-01 [--as-of 2024-01-01] [--quality fail]

``bronze`` ingests ``<landing>/<source>.csv`` (or a directory per source) for
every contract present; ``silver`` cleans, deduplicates, checks and upserts;
``gold`` builds the dimensions and the fact; ``all`` runs the three in order.
The session is whatever ``spark-submit`` configures; nothing is set here.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _sources(spark: SparkSession, landing: str) -> dict[str, str]:
    from lakelayer.plans import olist
    from lakelayer.sinks.store import path_exists

    out = {}
    base = landing.rstrip("/")
    for name in olist.SOURCES:
        for candidate in (f"{base}/{name}.csv", f"{base}/{name}"):
            if path_exists(spark, candidate):
                out[name] = candidate
                break
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakelayer")
    ap.add_argument("layer", choices=["bronze", "silver", "gold", "all"])
    ap.add_argument("--landing", help="directory holding the source CSV files (bronze)")
    ap.add_argument("--lake", required=True, help="root of the bronze/silver/gold tables")
    ap.add_argument("--batch-id", default=None, help="bronze batch id (a rerun replaces it)")
    ap.add_argument("--as-of", default=None, help="validity date for SCD2 versions (gold)")
    ap.add_argument("--quality", choices=["warn", "fail"], default="warn")
    a = ap.parse_args(argv)

    from lakelayer.plans import olist

    spark = SparkSession.builder.appName(f"lakelayer-{a.layer}").getOrCreate()
    summary = {}
    if a.layer in ("bronze", "all"):
        if not a.landing or not a.batch_id:
            ap.error("bronze needs --landing and --batch-id")
        res = olist.run_bronze(spark, _sources(spark, a.landing), a.lake, a.batch_id)
        summary["bronze"] = {
            n: {"total": r.total_rows, "clean": r.clean_rows, "quarantine": r.quarantine_rows} for n, r in res.items()
        }
    if a.layer in ("silver", "all"):
        reports = olist.run_silver(spark, a.lake, quality_mode=a.quality)
        summary["silver"] = {n: [r["rule"] for r in rows if not r["passed"]] for n, rows in reports.items()}
    if a.layer in ("gold", "all"):
        if not a.as_of:
            ap.error("gold needs --as-of")
        tables = olist.run_gold(spark, a.lake, a.as_of)
        summary["gold"] = {n: t.current_path() for n, t in tables.items()}
    print(json.dumps(summary))
    return 0


if __name__ == "__main__":
    sys.exit(main())

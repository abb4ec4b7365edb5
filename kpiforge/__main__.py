"""Command line: ``python -m kpiforge run DATA_DIR`` (ingest + KPIs) or
``python -m kpiforge kpis`` (KPIs from the existing raw tables). Prints the
run report as one JSON object: rows per raw table, rows per KPI table,
failures, seconds per KPI and in total."""

from __future__ import annotations

import argparse
import json
import sys
import time

from kpiforge.operators import volume_monthly
from kpiforge.plans.layout import store_for_joins
from kpiforge.plans.registry import default_registry
from kpiforge.plans.runner import RunReport, run_all, run_kpis
from kpiforge.session import apply_scale_settings, build_session
from kpiforge.sources.catalog import recover_tables
from kpiforge.sources.csv_ingest import MODES


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="kpiforge")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="ingest every CSV of DATA_DIR, then compute all KPIs")
    run.add_argument("data_dir")
    run.add_argument("--rows", default="padded", choices=MODES,
                     help="rows that do not fit their table: fail, pad short ones (surplus fields fail), or set apart")
    kp = sub.add_parser("kpis", help="compute all KPIs from the existing raw tables")
    lay = sub.add_parser("layout", help="store the raw tables hashed by order and by month of purchase")
    lay.add_argument("--buckets", type=int, default=None, help="default: sized from the tables")
    lay.add_argument("--raw-db", default="raw")
    lay.add_argument("--master", default=None)
    for p in (run, kp):
        p.add_argument("--raw-db", default="raw")
        p.add_argument("--out-db", default="analytics")
        p.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
        p.add_argument("--shuffle-partitions", default="auto",
                       help="a number, or 'auto': sized from the input")
        p.add_argument("--parallelism", type=int, default=4, help="KPIs run at once")
        p.add_argument("--kpi-seconds", type=float, default=None, help="stop a KPI that takes longer, and report it")
        p.add_argument("--kpi-sql", default=None, help="folder of *.sql files, each one more KPI named after its file")
        p.add_argument("--volume-from", default=volume_monthly.DEFAULT_BOUNDS[0],
                       help="first purchase date of the monthly volume KPI (inclusive)")
        p.add_argument("--volume-to", default=volume_monthly.DEFAULT_BOUNDS[1],
                       help="end of the monthly volume window (exclusive)")
    args = ap.parse_args(argv)
    if args.cmd == "layout":
        spark = build_session(args.master)
        recover_tables(spark, args.raw_db)
        print(json.dumps({"buckets": store_for_joins(spark, args.raw_db, args.buckets)}))
        return 0
    registry = default_registry()
    if (args.volume_from, args.volume_to) != volume_monthly.DEFAULT_BOUNDS:
        lo, hi = args.volume_from, args.volume_to
        registry.register(volume_monthly.NAME, lambda t: volume_monthly.build(t, lo, hi))
    if args.kpi_sql:
        registry.register_sql_folder(args.kpi_sql)
    auto = args.shuffle_partitions == "auto"
    spark = build_session(args.master, None if auto else int(args.shuffle_partitions))
    if auto and args.cmd == "run":
        apply_scale_settings(spark, args.data_dir)
    t0 = time.perf_counter()
    if args.cmd == "run":
        rep = run_all(spark, args.data_dir, registry, raw_db=args.raw_db, out_db=args.out_db,
                      parallelism=args.parallelism, size_shuffles=auto, mode=args.rows, kpi_seconds=args.kpi_seconds)
    else:
        rep = run_kpis(spark, registry, raw_db=args.raw_db, out_db=args.out_db,
                       parallelism=args.parallelism, report=RunReport(), size_shuffles=auto,
                       kpi_seconds=args.kpi_seconds)
        rep.seconds = time.perf_counter() - t0
    departures = {k: v for k in ("padded", "rejected", "kept_as_text") if (v := getattr(rep, k))}
    print(json.dumps({"ingested": rep.ingested, **departures, "written": rep.written, "failed": rep.failed,
                      "kpi_seconds": rep.kpi_seconds, "seconds": round(rep.seconds, 1)},
                     ensure_ascii=False))
    return 0 if rep.ok else 1


if __name__ == "__main__":
    sys.exit(main())

"""Print the physical plan summary of every KPI on typed raw parquet tables.

    python tools/explain_plans.py [sf_dir] [--full] [--scale] [--layout]

Raw tables are materialised from the driver data into a scratch warehouse (the
same layout the ingestion writes), then each KPI's formatted plan is scanned
for the facts that matter at scale: pushed filters and read schemas of the
scans, number of exchanges, join strategies, Python evaluation nodes.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiforge.plans.layout import store_for_joins  # noqa: E402
from kpiforge.plans.registry import default_registry  # noqa: E402
from kpiforge.session import build_session  # noqa: E402
from kpiforge.sources.catalog import ensure_databases, raw_tables, replace_table  # noqa: E402
from kpiforge.sources.driver_tables import load_driver_tables  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    return {
        "exchanges": len(re.findall(r"^\(\d+\) Exchange", text, re.M)),
        "joins": re.findall(r"^\(\d+\) (\w*Join\w*)", text, re.M),
        "pushed": sorted(set(re.findall(r"PushedFilters: (\[.*?\])", text))),
        "read": sorted(set(re.findall(r"ReadSchema: (struct<.*?>)", text))),
        "python": bool(re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", text)),
        "cartesian": "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and not argv[1].startswith("--") else "/root/testdata/sf0.01"
    full = "--full" in argv
    wh = tempfile.mkdtemp(prefix="kpiforge-plans-")
    extra = {"spark.sql.warehouse.dir": wh}
    spark = build_session("local[8]", 16, extra=extra)
    if "--scale" in argv:
        # as when every table is large: no size-based broadcast, no AQE re-plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    ensure_databases(spark, "plan_raw")
    for name, df in load_driver_tables(spark, sf_dir).items():
        replace_table(df, "plan_raw", name)
    if "--layout" in argv:
        print(store_for_joins(spark, "plan_raw", buckets=8))
    tables = raw_tables(spark, "plan_raw")
    for job in default_registry().jobs():
        df = job.build(spark, tables)
        text = plan_text(df)
        s = summarize(text)
        print(f"== {job.name}: exchanges={s['exchanges']} joins={s['joins']} "
              f"python={s['python']} cartesian={s['cartesian']}")
        for p in s["pushed"]:
            print("   pushed", p)
        for r in s["read"]:
            print("   read  ", r)
        if full:
            print(text)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

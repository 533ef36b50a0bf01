"""Physical plan shape of every registered query -> PLANS.md.

For each query: shuffles (Exchange), broadcasts, Python stages, window
operators, Parquet scans and the columns each scan reads.  Plans are the
initial adaptive plans (AQE may still coalesce, split skew or turn a
shuffle join into a broadcast once stage sizes are measured).

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans import catalog  # noqa: E402
from tidewater.session import build_session, require_checkpoint_dir, ship_package  # noqa: E402

PY = ("MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas", "ArrowEvalPython", "TransformWithStateInPandas")
# queries whose returned frame reads data already written by the query (loads) are reported as such
WRITES = {"load_deduplicated", "load_plain", "file_ranges", "parquet_roundtrip", "stream_load_hourly", "filter_records"}


def shape(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {
        "shuffles": sum(1 for n in nodes if n == "Exchange"),
        "broadcasts": sum(1 for n in nodes if n == "BroadcastExchange"),
        "python": sum(1 for n in nodes if n in PY),
        "windows": sum(1 for n in nodes if n == "Window"),
        "scans": len(scans),
        "columns": sorted({len(s.split(",")) for s in scans}),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    ship_package(spark)
    require_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tidewater-plans-"))
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py` at `{sf}`. Counts are nodes of the initial adaptive plan; "
          "`cols/scan` is the number of columns each Parquet scan reads (after pruning).\n")
    print("| query | shuffles | broadcasts | python stages | windows | scans | cols/scan | note |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString() if False else df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = shape(plan)
        note = "reads back what the query wrote" if name in WRITES else ""
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['python']} | {s['windows']} | {s['scans']} | {','.join(map(str, s['columns']))} | {note} |")


if __name__ == "__main__":
    main()

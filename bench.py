"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed into Spark's no-op sink (no collect), timed
after one untimed warm-up run of every query at the smallest scale (the
warm-up cost does not depend on data size).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tidewater.plans import catalog  # noqa: E402
from tidewater.session import build_session, require_checkpoint_dir, ship_package  # noqa: E402

HEADLINE = [
    "hour_bucket_counts",
    "stream_watermark",
    "late_records",
    "offsets_for_times",
    "dedup_offset_range",
    "dedup_watermark_range",
    "dedup_recent_keys",
    "dedup_recent_keys_default",
    "dedup_root_scope",
    "decode_roundtrip",
    "filter_records",
    "roll_by_records",
    "roll_any_file",
    "load_deduplicated",
    "load_plain",
    "file_ranges",
    "records_batched_rate",
    "commit_duration_p999",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    ship_package(spark)
    require_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tidewater-bench-"))
    # untimed warm-up at the smallest scale: JIT, codegen and Python workers
    for name in names:
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    rates = {
        f"{q}_rows_per_sec": round(events / times[q]) for q in ("dedup_recent_keys", "dedup_offset_range", "stream_watermark", "decode_roundtrip", "load_deduplicated") if q in times
    }
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "events_rows": events,
        "rates": rates,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

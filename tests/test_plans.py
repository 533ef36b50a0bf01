"""Plan guards over every registered query: no cross joins, Python only where needed, pruned scans."""

import re

import pytest

from conftest import SF_SMALL
from tidewater.plans import catalog

PYTHON_NODES = ("MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas", "ArrowEvalPython", "BatchEvalPython")
# queries whose work needs a Python stage (protobuf, the exact cache, or per-row predicates)
PYTHON_OK = {"dedup_recent_keys", "dedup_recent_keys_default", "dedup_recent_keys_chunks", "dedup_root_scope", "decode_roundtrip", "drop_malformed", "malformed_report", "malformed_counts", "filter_records"}
# queries whose returned frame reads tables they wrote (lake, metrics, staged topic)
READS_BACK = {"load_deduplicated", "load_plain", "file_ranges", "parquet_roundtrip", "stream_load_hourly",
              "stream_dedup_offset_range", "roll_any_file", "load_deduplicated_small", "file_ranges_recent_keys", "load_increments",
              "load_dead_letters", "load_custom_partition", "load_any_file", "roll_any_file_root", "roll_any_limit", "load_formatter_1n", "stream_dedup_null_keys", "stream_dedup_watermark_range"}


def _plan(spark, df):
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("dedup", ["recent", "offsets", "time", None])
def test_building_a_load_plan_runs_nothing(spark, dedup):
    from tidewater.operators import codec
    from tidewater.plans.loads import LoadSpec, load_plan
    from tidewater.sources.logs import events_log

    log = codec.encode_events(events_log(spark, SF_SMALL, payload=True))
    sc = spark.sparkContext
    sc.setJobGroup("planning", "load plan")
    try:
        load_plan(log, LoadSpec(dedup=dedup, predicate=None))
        assert list(sc.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_guards(spark, name):
    plan = _plan(spark, catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    if name not in PYTHON_OK:
        assert not any(n in PYTHON_NODES for n in nodes), nodes
    widest = 4 if name not in PYTHON_OK and name not in READS_BACK else 8
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert len(schema.split(",")) <= widest, schema  # column pruning reaches the scan

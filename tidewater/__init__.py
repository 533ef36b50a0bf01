"""tidewater: keyed streams into a partitioned Parquet lake, on Spark.

Public entry points (DataFrame in, DataFrame out unless noted):

* sources: ``read_stream_log``, ``read_kafka``, ``kafka_options``,
  ``write_kafka``, ``generate_test_records``, ``generate_complex_records``
* watermark: ``with_stream_watermark``, ``hour_bucket``, ``late_records``,
  ``offsets_for_times``
* dedup: ``dedup_recent_keys`` (exact cache), ``dedup_offset_range``,
  ``dedup_watermark_range``, ``duplicate_counts``, ``with_rewind``
* codec: ``decode_proto``, ``drop_malformed``, ``malformed_report``,
  ``annotate_kafka``, ``filter_records``, ``encode_proto``
* partitioning: ``time_partition``, ``topic_partition_partitioner``,
  ``partition_group``, ``roll_by_records``, ``roll_any_file``,
  ``roll_fuzzy``, ``offset_range_paths``, ``file_ranges``
* positions: ``offset_ranges``, ``commit_positions``, ``last_committed``,
  ``partition_group_members``
* loading: ``LoadSpec``, ``load_plan``, ``load``, ``loader``, ``publish``,
  ``read_loaded``, ``load_stream``
* monitoring: ``metrics_from_log``, ``metrics_from_progress`` and the M1-M10
  queries in ``tidewater.operators.monitoring``
"""

from .operators.codec import annotate_kafka, decode_proto, drop_malformed, encode_proto, filter_records, malformed_report
from .operators.dedup import dedup_offset_range, dedup_watermark_range, duplicate_counts, with_rewind
from .operators.monitoring import metrics_from_log, metrics_from_progress
from .operators.partitioning import (
    file_ranges,
    offset_range_paths,
    partition_group,
    roll_any_file,
    roll_by_records,
    roll_fuzzy,
    time_partition,
    topic_partition_partitioner,
)
from .operators.positions import commit_positions, last_committed, offset_ranges, partition_group_members
from .operators.recent_keys import dedup_recent_keys
from .operators.watermark import hour_bucket, late_records, offsets_for_times, with_stream_watermark
from .plans.loads import LoadSpec, load, load_plan, loader
from .plans.sink import publish, read_loaded
from .sources.generators import generate_complex_records, generate_test_records
from .sources.kafka import kafka_options, read_kafka, write_kafka
from .sources.logs import read_stream_log
from .streaming.load import load_stream

__all__ = [name for name in dir() if not name.startswith("_")]

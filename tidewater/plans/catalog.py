"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the driver's tables (through the Kafka-shaped logs of
``sources.logs``) and runs over all of their rows.  ``QUERIES[name]`` takes
(spark, sf_dir) and returns a DataFrame; ``ORACLE_SQL[name]`` computes the
same rows in DuckDB over views ``events``, ``orders``, ...  Queries whose
rule has no practical SQL form have no oracle entry and are checked against
a direct simulation in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import codec, dedup, monitoring, partitioning, positions, rolling, watermark
from . import loads, sink
from ..operators.recent_keys import dedup_recent_keys
from ..schema import KAFKA_SCHEMA, ts_millis
from ..sources import generators
from ..sources.logs import CORRUPT_EVERY, EVENTS_LOG_SQL, ORDERS_LOG_SQL, events_log, read_stream_log, two_topic_log

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed parameters of the registered queries.
DEDUP_OFFSETS = 50  # X3 window in offsets
DEDUP_MS = 3_600_000  # X4 window: one hour
CACHE_SMALL = 20  # X1 capacity that evicts often
CACHE_DEFAULT = 2000  # X1 capacity of the loader's application settings
CACHE_ROOT = 30  # X1 capacity for the single-scope (root) query
ROLL_RECORDS = 100  # F1/F4 record limit of the loader's application settings
FILTER_PRICE = 50.0  # R5 predicate: price > 50
DAY_MS = 86_400_000


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


# ---------------------------------------------------------------- SQL pieces
LOG = f"log AS ({EVENTS_LOG_SQL})"
LOG2 = f"log AS ({EVENTS_LOG_SQL} UNION ALL {ORDERS_LOG_SQL})"
WM = (
    'wm AS (SELECT *, max(ts_ms) OVER (PARTITION BY topic, "partition" ORDER BY "offset" '
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS watermark FROM log)"
)
X3 = (
    'x3 AS (SELECT *, lag("offset") OVER (PARTITION BY topic, "partition", k ORDER BY "offset") AS prev_off FROM {src}), '
    f'kept AS (SELECT * FROM x3 WHERE prev_off IS NULL OR "offset" - prev_off > {DEDUP_OFFSETS})'
)


def recent_keys_cte(capacity: int, scope: str, order: str, src: str = "log") -> str:
    """X1 in SQL through its closed form: dup iff prev exists and d < min(D, cap - h).

    d = distinct other keys since the key's previous occurrence, D = distinct
    keys before the record, h = previous record was a hit with d < cap - 1.
    Ends in CTE ``x1`` = ``src`` columns + ``is_dup``.
    """
    part = f"PARTITION BY {scope}" if scope else ""
    same = " AND ".join(f"b.{c} = a.{c}" for c in scope.split(", ")) if scope else "TRUE"
    return f"""
p AS (SELECT *, row_number() OVER ({part} ORDER BY {order}) AS rn FROM {src}),
p2 AS (SELECT *, lag(rn) OVER (PARTITION BY {scope + ', ' if scope else ''}k ORDER BY rn) AS prev_rn FROM p),
p3 AS (SELECT *, coalesce(sum(CASE WHEN prev_rn IS NULL THEN 1 ELSE 0 END) OVER ({part} ORDER BY rn
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS dcount FROM p2),
d AS (SELECT a.*, CASE WHEN a.prev_rn IS NULL THEN NULL ELSE
        (SELECT count(DISTINCT b.k) FROM p3 b WHERE {same} AND b.rn > a.prev_rn AND b.rn < a.rn) END AS d FROM p3 a),
h AS (SELECT *, coalesce(lag(CASE WHEN prev_rn IS NOT NULL AND d < {capacity} - 1 THEN 1 ELSE 0 END)
        OVER ({part} ORDER BY rn), 0) AS hprev FROM d),
x1 AS (SELECT *, (prev_rn IS NOT NULL AND d < least(dcount, {capacity} - hprev)) AS is_dup FROM h)"""


def recent_keys_sql(capacity: int, log_cte: str, scope: str, order: str) -> str:
    return f'WITH {log_cte}, {recent_keys_cte(capacity, scope, order)} SELECT topic, "partition", "offset", is_dup FROM x1'


def _wm(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.with_stream_watermark(events_log(spark, sf))


def _tasks(spark: SparkSession) -> int:
    """Tasks that the events table's messages are encoded in (it is one row group)."""
    return spark.sparkContext.defaultParallelism


def _tp_cols():
    return ["topic", "partition", "offset"]


# ------------------------------------------------------------- W1-W4, W6, P2
@register(
    "hour_bucket_counts",
    f"""
WITH {LOG}, {WM}, {X3.format(src='wm')}
SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y%m%d') AS dt,
       strftime(date_trunc('hour', epoch_ms(watermark)), '%H') AS hr,
       topic, "partition", count(*) AS records, min("offset") AS min_offset, max("offset") AS max_offset
FROM kept GROUP BY ALL""",
)
def hour_bucket_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: log -> watermark -> offset-range dedup -> hour buckets -> counts."""
    # watermark and offset-range dedup share one exchange of the log
    x = dedup.drop_duplicates_marked(dedup.watermark_offset_dedup(events_log(spark, sf), DEDUP_OFFSETS))
    x = partitioning.time_partition(x, "hourly")
    return x.groupBy("dt", "hr", "topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset")
    )


@register(
    "stream_watermark",
    f'WITH {LOG}, {WM} SELECT topic, "partition", "offset", ts_ms AS timestamp_ms, watermark FROM wm',
)
def stream_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return _wm(spark, sf).select(*_tp_cols(), ts_millis("timestamp").alias("timestamp_ms"), "watermark")


@register(
    "late_records",
    f"""WITH {LOG}, {WM}
SELECT topic, "partition", "offset", ts_ms AS timestamp_ms, watermark, watermark - ts_ms AS lateness_ms
FROM wm WHERE ts_ms < watermark""",
)
def late_records(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.late_records(_wm(spark, sf)).select(
        *_tp_cols(), ts_millis("timestamp").alias("timestamp_ms"), "watermark", "lateness_ms"
    )


@register(
    "offsets_for_times",
    f"""WITH {LOG},
times AS (SELECT DISTINCT topic, "partition", CAST(floor(ts_ms / {DAY_MS}) * {DAY_MS} + {DAY_MS // 2} AS BIGINT) AS t_ms FROM log
          UNION SELECT topic, "partition", max(ts_ms) + 1 AS t_ms FROM log GROUP BY topic, "partition"),
hits AS (SELECT t.topic, t."partition", t.t_ms, min(l."offset") AS "offset" FROM times t JOIN log l
         ON l.topic = t.topic AND l."partition" = t."partition" AND l.ts_ms >= t.t_ms GROUP BY t.topic, t."partition", t.t_ms)
SELECT t.topic, t."partition", t.t_ms, h."offset", l.ts_ms AS timestamp_ms
FROM times t LEFT JOIN hits h ON h.topic = t.topic AND h."partition" = t."partition" AND h.t_ms = t.t_ms
LEFT JOIN log l ON l.topic = h.topic AND l."partition" = h."partition" AND l."offset" = h."offset"
""",
)
def offsets_for_times(spark: SparkSession, sf: str) -> DataFrame:
    """Noon of every day seen in each partition, and one time past its end."""
    log = events_log(spark, sf)
    t = ts_millis("timestamp")
    days = log.select("topic", "partition", (F.floor(t / F.lit(DAY_MS)) * DAY_MS + DAY_MS // 2).cast("long").alias("t_ms"))
    beyond = log.groupBy("topic", "partition").agg((F.max(t) + 1).alias("t_ms"))
    times = days.unionByName(beyond).distinct()
    return watermark.offsets_for_times(log, times)


# ---------------------------------------------------------------- X1-X4, X6
@register(
    "dedup_offset_range",
    f'WITH {LOG}, {X3.format(src="log")} SELECT topic, "partition", "offset", '
    f'(prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS}) AS is_dup FROM x3',
)
def dedup_offset_range(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_offset_range(events_log(spark, sf), DEDUP_OFFSETS).select(*_tp_cols(), "is_dup")


@register(
    "dedup_watermark_range",
    f"""WITH {LOG}, l AS (SELECT *, lag(ts_ms) OVER (PARTITION BY topic, "partition", k ORDER BY "offset") AS prev_ts FROM log)
SELECT topic, "partition", "offset", (prev_ts IS NOT NULL AND ts_ms - prev_ts <= {DEDUP_MS}) AS is_dup FROM l""",
)
def dedup_watermark_range(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_watermark_range(events_log(spark, sf), DEDUP_MS).select(*_tp_cols(), "is_dup")


@register("dedup_recent_keys", recent_keys_sql(CACHE_SMALL, LOG, 'topic, "partition"', '"offset"'))
def dedup_recent_keys_small(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_recent_keys(events_log(spark, sf), CACHE_SMALL).select(*_tp_cols(), "is_dup")


@register("dedup_recent_keys_default", recent_keys_sql(CACHE_DEFAULT, LOG, 'topic, "partition"', '"offset"'))
def dedup_recent_keys_default(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_recent_keys(events_log(spark, sf), CACHE_DEFAULT).select(*_tp_cols(), "is_dup")


@register("dedup_root_scope", recent_keys_sql(CACHE_ROOT, LOG2, "", 'ts_ms, topic, "partition", "offset"'))
def dedup_root_scope(spark: SparkSession, sf: str) -> DataFrame:
    """One cache for two topics; keys collide across them."""
    return dedup_recent_keys(two_topic_log(spark, sf), CACHE_ROOT, scope="root").select(*_tp_cols(), "is_dup")


@register(
    "duplicate_counts",
    f'WITH {LOG}, {X3.format(src="log")} SELECT topic, "partition", count(*) AS records, '
    f'CAST(sum(CASE WHEN prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS} THEN 1 ELSE 0 END) AS BIGINT) AS duplicates '
    "FROM x3 GROUP BY ALL",
)
def duplicate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_counts(dedup.dedup_offset_range(events_log(spark, sf), DEDUP_OFFSETS))


# ------------------------------------------------------------------- R1-R5
DECODED_SQL = """SELECT event_id AS "offset", event_id AS id, event_type AS name, value AS price,
  (event_id % 5 <> 0) AS isOn, CAST(event_id AS VARCHAR) AS uuid, epoch_us(ts) // 1000 AS creation_time,
  CAST(user_id AS INTEGER) AS s0, CAST(json_extract_string(props, '$.k') AS INTEGER) AS s1 FROM events"""


def _decoded_cols():
    return [
        "offset", "id", "name", "price", "isOn",
        F.col("header.uuid").alias("uuid"), F.col("header.creation_time").alias("creation_time"),
        F.col("somethings")[0].alias("s0"), F.col("somethings")[1].alias("s1"),
    ]


@register("decode_roundtrip", DECODED_SQL)
def decode_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Events -> ComplexType bytes -> decoded columns."""
    log = codec.encode_events(events_log(spark, sf, payload=True), partitions=_tasks(spark))
    return codec.drop_malformed(codec.decode_proto(log)).select(*_decoded_cols())


@register(
    "drop_malformed",
    f"""SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset", event_id AS id
FROM events WHERE event_id % {CORRUPT_EVERY} <> 0""",
)
def drop_malformed(spark: SparkSession, sf: str) -> DataFrame:
    log = codec.encode_events(events_log(spark, sf, payload=True), corrupt_every=CORRUPT_EVERY, partitions=_tasks(spark))
    return codec.drop_malformed(codec.decode_proto(log)).select(*_tp_cols(), "id")


@register(
    "malformed_report",
    f"""SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset"
FROM events WHERE event_id % {CORRUPT_EVERY} = 0""",
)
def malformed_report(spark: SparkSession, sf: str) -> DataFrame:
    log = codec.encode_events(events_log(spark, sf, payload=True), corrupt_every=CORRUPT_EVERY, partitions=_tasks(spark))
    return codec.malformed_report(codec.decode_proto(log))


@register(
    "malformed_counts",
    f"""SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", count(*) AS malformed,
  min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events WHERE event_id % {CORRUPT_EVERY} = 0 GROUP BY ALL""",
)
def malformed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Skipped records per topic-partition with their offset span."""
    log = codec.encode_events(events_log(spark, sf, payload=True), corrupt_every=CORRUPT_EVERY, partitions=_tasks(spark))
    return codec.malformed_counts(codec.decode_proto(log))


@register(
    "filter_records",
    f"""WITH {LOG}, {X3.format(src='log')}
SELECT kept.topic, kept."partition", kept."offset", e.event_id AS id, e.value AS price
FROM kept JOIN events e ON e.event_id = kept."offset" WHERE e.value > {FILTER_PRICE}""",
)
def filter_records(spark: SparkSession, sf: str) -> DataFrame:
    """Dedup on keys first, then decode, then the predicate on decoded fields."""
    marked = dedup.dedup_offset_range(_encoded(spark, sf), DEDUP_OFFSETS)
    decoded = codec.drop_malformed(codec.decode_proto(dedup.drop_duplicates_marked(marked)))
    return codec.filter_records(decoded, F.col("price") > F.lit(FILTER_PRICE)).select(*_tp_cols(), "id", "price")


# ------------------------------------------------------------ P1-P5, F1, A
@register(
    "time_partition_daily",
    f"WITH {LOG}, {WM} SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y_%m_%d') AS dt, count(*) AS records "
    "FROM wm GROUP BY ALL",
)
def time_partition_daily(spark: SparkSession, sf: str) -> DataFrame:
    return partitioning.time_partition(_wm(spark, sf), "daily").groupBy("dt").agg(F.count(F.lit(1)).alias("records"))


@register(
    "time_partition_hourly",
    f"WITH {LOG}, {WM} SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y%m%d') AS dt, "
    "strftime(date_trunc('hour', epoch_ms(watermark)), '%H') AS hr, count(*) AS records FROM wm GROUP BY ALL",
)
def time_partition_hourly(spark: SparkSession, sf: str) -> DataFrame:
    x = partitioning.time_partition(_wm(spark, sf), "hourly")
    return x.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("records"))


ROLL_SQL = (
    f'r AS (SELECT *, (row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) // {ROLL_RECORDS} '
    "AS file_seq FROM log)"
)


@register("roll_by_records", f'WITH {LOG}, {ROLL_SQL} SELECT topic, "partition", "offset", file_seq FROM r')
def roll_by_records(spark: SparkSession, sf: str) -> DataFrame:
    return partitioning.roll_by_records(events_log(spark, sf), ROLL_RECORDS).select(*_tp_cols(), "file_seq")


@register(
    "offset_range_path",
    f"""WITH {LOG}, {ROLL_SQL}
SELECT topic, "partition", file_seq, min("offset") AS min_offset, max("offset") AS max_offset, count(*) AS records,
  topic || '_' || CAST("partition" AS VARCHAR) || '_' || CAST(min("offset") AS VARCHAR) || '_' || CAST(max("offset") AS VARCHAR) || '.parquet' AS path
FROM r GROUP BY topic, "partition", file_seq""",
)
def offset_range_path(spark: SparkSession, sf: str) -> DataFrame:
    rolled = partitioning.roll_by_records(events_log(spark, sf), ROLL_RECORDS)
    return partitioning.offset_range_paths(rolled, batch="file_seq")


@register(
    "partition_group_members",
    f"""WITH {LOG2}, t AS (SELECT DISTINCT 'g' || CAST("partition" % 2 AS VARCHAR) AS "group",
  topic || '-' || CAST("partition" AS VARCHAR) AS tp FROM log)
SELECT "group", string_agg(tp, ',' ORDER BY tp) AS members, count(*) AS partitions FROM t GROUP BY "group\"""",
)
def partition_group_members(spark: SparkSession, sf: str) -> DataFrame:
    x = partitioning.partition_group(two_topic_log(spark, sf), F.concat(F.lit("g"), (F.col("partition") % 2).cast("string")))
    return positions.partition_group_members(x)


@register(
    "commit_positions",
    f'WITH {LOG2} SELECT topic, "partition", max("offset") + 1 AS next_offset, max(ts_ms) AS watermark FROM log GROUP BY ALL',
)
def commit_positions(spark: SparkSession, sf: str) -> DataFrame:
    return positions.commit_positions(two_topic_log(spark, sf))


@register(
    "last_committed",
    f"""WITH {LOG2}, {ROLL_SQL},
commits AS (SELECT topic, "partition", file_seq AS commit_seq, max("offset") + 1 AS next_offset, max(ts_ms) AS watermark
            FROM r GROUP BY topic, "partition", file_seq HAVING count(*) = {ROLL_RECORDS}),
latest AS (SELECT topic, "partition", arg_max(next_offset, commit_seq) AS next_offset, arg_max(watermark, commit_seq) AS watermark,
           max(commit_seq) AS commit_seq FROM commits GROUP BY ALL),
req AS (SELECT DISTINCT topic, "partition" FROM log UNION SELECT topic, max("partition") + 1 FROM log GROUP BY topic)
SELECT req.topic, req."partition", latest.next_offset, latest.watermark, latest.commit_seq
FROM req LEFT JOIN latest ON latest.topic = req.topic AND latest."partition" = req."partition"
""",
)
def last_committed(spark: SparkSession, sf: str) -> DataFrame:
    """A3: commits = closed files (100 records) in order; one requested partition never committed."""
    log = two_topic_log(spark, sf)
    rolled = partitioning.roll_by_records(log, ROLL_RECORDS)
    commits = (
        rolled.groupBy("topic", "partition", F.col("file_seq").alias("commit_seq"))
        .agg((F.max("offset") + 1).alias("next_offset"), F.max(ts_millis("timestamp")).alias("watermark"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == ROLL_RECORDS)
        .drop("_n")
    )
    requested = log.select("topic", "partition").distinct().unionByName(
        log.groupBy("topic").agg((F.max("partition") + 1).alias("partition"))
    )
    return positions.last_committed(commits, requested).select("topic", "partition", "next_offset", "watermark", "commit_seq")


@register(
    "roll_any_file",
    f"""WITH {LOG}, {WM},
h AS (SELECT topic, "partition", "offset", strftime(date_trunc('hour', epoch_ms(watermark)), '%Y%m%d') AS dt,
      strftime(date_trunc('hour', epoch_ms(watermark)), '%H') AS hr FROM wm),
p AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition", dt, hr ORDER BY "offset") - 1 AS pos FROM h),
f AS (SELECT topic, "partition", dt, hr, min("offset") AS first_off, count(*) // {ROLL_RECORDS} AS closed_n FROM h GROUP BY ALL),
f2 AS (SELECT *, coalesce(sum(closed_n) OVER (PARTITION BY topic, "partition" ORDER BY first_off
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev,
       sum(closed_n) OVER (PARTITION BY topic, "partition") AS total FROM f)
SELECT p.topic, p."partition", p."offset", CAST(prev + pos // {ROLL_RECORDS} AS BIGINT) AS batch_id,
  (prev + pos // {ROLL_RECORDS} < total) AS closed
FROM p JOIN f2 ON f2.topic = p.topic AND f2."partition" = p."partition" AND f2.dt = p.dt AND f2.hr = p.hr""",
)
def roll_any_file(spark: SparkSession, sf: str) -> DataFrame:
    """F4 per topic-partition over hour files: a batch closes when any of its files reaches the limit.

    The oracle states the rule's closed form for contiguous files; tests check
    it against the record-by-record rule.
    """
    hourly = partitioning.time_partition(_wm(spark, sf), "hourly").select("topic", "partition", "offset", "dt", "hr")
    # the rolling rule reads its input several times: keep the watermark scan from running again each time
    return partitioning.roll_any_file(sink.materialize(hourly, "hourly-log"), ROLL_RECORDS)


# Starts of batches from the next start after every place (CTE nxt: grp, pos, nxt), and each place's batch.
STARTS_SQL = """s AS (SELECT DISTINCT grp, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS batch_id FROM nxt
  UNION ALL SELECT s.grp, nxt.nxt, s.batch_id + 1 FROM s JOIN nxt ON nxt.grp = s.grp AND nxt.pos = s.start WHERE nxt.nxt IS NOT NULL),
t AS (SELECT grp, max(batch_id) AS total FROM s GROUP BY grp)"""


@register(
    "roll_any_file_root",
    f"""WITH RECURSIVE {LOG2},
o AS (SELECT *, 'root' AS grp, row_number() OVER (ORDER BY ts_ms, topic, "partition", "offset") - 1 AS pos FROM log),
e AS (SELECT grp, pos, lead(pos, {ROLL_RECORDS - 1}) OVER (PARTITION BY topic, "partition" ORDER BY pos) AS e FROM o),
nxt AS (SELECT grp, pos, min(e) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) + 1 AS nxt FROM e),
{STARTS_SQL}
SELECT topic, "partition", "offset", s.batch_id, s.batch_id < t.total AS closed
FROM o ASOF JOIN s ON s.grp = o.grp AND o.pos >= s.start JOIN t ON t.grp = o.grp""",
)
def roll_any_file_root(spark: SparkSession, sf: str) -> DataFrame:
    """F4 with one root group: a file per topic-partition, interleaved in the order of time; any full one commits all."""
    log = two_topic_log(spark, sf).withColumn("_tw_root", F.lit("root"))
    rolled = partitioning.roll_any_file(log, ROLL_RECORDS, ["_tw_root"], ["topic", "partition"], ["timestamp", "topic", "partition", "offset"], chunk_size=CHUNK_SMALL)
    return rolled.select(*_tp_cols(), "batch_id", "closed")


ROLL_SIZE = 150  # bytes of a file in the any-of limits
ROLL_OPEN_MS = 12 * 3_600_000


@register(
    "roll_any_limit",
    f"""WITH RECURSIVE {LOG}, {WM},
o AS (SELECT *, topic || '/' || CAST("partition" AS VARCHAR) AS grp, date_trunc('hour', epoch_ms(watermark)) AS f,
  strlen(k) + "offset" % 50 AS bytes, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS pos FROM wm),
c AS (SELECT *, sum(bytes) OVER (PARTITION BY grp, f ORDER BY pos) AS cum FROM o),
at_clock AS (SELECT grp, watermark AS clock, min(pos) AS pos FROM o GROUP BY ALL),
by_records AS (SELECT grp, pos, lead(pos, {ROLL_RECORDS - 1}) OVER (PARTITION BY grp, f ORDER BY pos) AS e FROM o),
by_size AS (SELECT a.grp, a.pos, b.pos AS e FROM c a ASOF LEFT JOIN c b ON b.grp = a.grp AND b.f = a.f AND a.cum - a.bytes + {ROLL_SIZE} <= b.cum),
by_clock AS (SELECT a.grp, a.pos, b.pos AS e FROM o a ASOF LEFT JOIN at_clock b ON b.grp = a.grp AND a.watermark + {ROLL_OPEN_MS} <= b.clock),
e AS (SELECT grp, pos, min(e) AS e FROM (SELECT * FROM by_records UNION ALL SELECT * FROM by_size UNION ALL SELECT * FROM by_clock) GROUP BY ALL),
nxt AS (SELECT grp, pos, min(e) OVER (PARTITION BY grp ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) + 1 AS nxt FROM e),
{STARTS_SQL}
SELECT topic, "partition", "offset", s.batch_id, s.batch_id < t.total AS closed
FROM o ASOF JOIN s ON s.grp = o.grp AND o.pos >= s.start JOIN t ON t.grp = o.grp""",
)
def roll_any_limit(spark: SparkSession, sf: str) -> DataFrame:
    """F2 + F3 + F4: hour files that commit by records, exact bytes or open time, whichever any of them reaches first."""
    hourly = partitioning.time_partition(_wm(spark, sf), "hourly")
    size = F.octet_length("key") + F.col("offset") % 50
    limits = rolling.Limits(ROLL_RECORDS, ROLL_SIZE, ROLL_OPEN_MS)
    return rolling.roll_limits(hourly, limits, file_cols=["dt", "hr"], size=size, clock=F.col("watermark"), chunk_size=CHUNK_SMALL).select(*_tp_cols(), "batch_id", "closed")


ANY_FILE_RECORDS = 50


@register(
    "load_any_file",
    f"""WITH RECURSIVE {LOG}, {WM},
o AS (SELECT *, topic || '/' || CAST("partition" AS VARCHAR) AS grp, date_trunc('day', epoch_ms(watermark)) AS f,
  row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS pos FROM wm),
e AS (SELECT grp, pos, lead(pos, {ANY_FILE_RECORDS - 1}) OVER (PARTITION BY grp, f ORDER BY pos) AS e FROM o),
nxt AS (SELECT grp, pos, min(e) OVER (PARTITION BY grp ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) + 1 AS nxt FROM e),
{STARTS_SQL},
b AS (SELECT o.*, s.batch_id, t.total FROM o ASOF JOIN s ON s.grp = o.grp AND o.pos >= s.start JOIN t ON t.grp = o.grp),
p AS (SELECT topic, "partition", min("offset") AS next_offset FROM b WHERE batch_id >= total GROUP BY ALL),
m AS (SELECT topic, "partition", max("offset") + 1 AS after_last FROM log GROUP BY ALL)
SELECT b.topic, b."partition", strftime(f, '%Y_%m_%d') AS dt, count(*) AS records,
  min("offset") AS min_offset, max("offset") AS max_offset, any_value(coalesce(p.next_offset, m.after_last)) AS next_offset
FROM b JOIN m USING (topic, "partition") LEFT JOIN p USING (topic, "partition") WHERE batch_id < total GROUP BY ALL""",
)
def load_any_file(spark: SparkSession, sf: str) -> DataFrame:
    """F4 in a load: rows of committed batches only, and the positions that the next load goes on from."""
    base = sink.scratch_path(spark, "load-any-file")
    spec = loads.LoadSpec(dedup=None, any_file=True, layout="daily", roll_records=ANY_FILE_RECORDS)
    loads.load(_encoded(spark, sf), base, 0, spec)
    lake = sink.read_loaded(spark, base, "daily", committed_only=True)
    rows = lake.select(F.col("_kafka.topic").alias("topic"), F.col("_kafka.partition").alias("partition"), F.col("_kafka.offset").alias("offset"), "dt")
    counts = rows.groupBy("topic", "partition", "dt").agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"))
    return counts.join(sink.committed_positions(spark, base).select("topic", "partition", "next_offset"), ["topic", "partition"])


# ------------------------------------------------------------------ S9, S10
@register(
    "generate_test_records",
    """SELECT 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
  'key' || CAST(user_id % 3 AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS key,
  'some_name' || CAST(event_id AS VARCHAR) AS name, event_id AS id, CAST(0.4 AS DOUBLE) * event_id AS price,
  (event_id % 5 <> 0) AS isOn,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) || ',' || CAST(2 * event_id AS VARCHAR) || ',' || CAST(3 * event_id AS VARCHAR)
       WHEN event_id % 7 = 0 THEN ''
       ELSE CAST(event_id AS VARCHAR) || ',' || CAST(5 * event_id AS VARCHAR) END AS somethings
FROM events""",
)
def generate_test_records(spark: SparkSession, sf: str) -> DataFrame:
    """S10 rule over every event (message number = event id, partition = user % 3)."""
    idx = spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit("events").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("n")
    )
    recs = generators.test_records_from_index(idx)
    return recs.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"), "name", "id", "price", "isOn",
        F.array_join("somethings", ",").alias("somethings"),
    )


@register(
    "generate_complex_records",
    """SELECT CAST(event_id AS VARCHAR) AS key, 0 AS copy FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR) AS key, 1 AS copy FROM events WHERE event_id % 10 = 0""",
)
def generate_complex_records(spark: SparkSession, sf: str) -> DataFrame:
    """S9 rule over every event id: key = id, every tenth sent twice (random fields left out)."""
    ids = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("i"))
    recs = generators.complex_records_from_ids(ids, seed=42)
    return recs.select(F.col("key").cast("string").alias("key"), "copy")


# ------------------------------------------------------- K1-K7, F6, S11
def _encoded(spark: SparkSession, sf: str, corrupt: bool = False) -> DataFrame:
    """The events topic at rest: encoded once, written as a Kafka-schema table, read back."""
    path = sink.scratch_path(spark, "topic")
    log = codec.encode_events(events_log(spark, sf, payload=True), corrupt_every=CORRUPT_EVERY if corrupt else None, partitions=_tasks(spark))
    log.select(*KAFKA_SCHEMA.fieldNames()).write.mode("overwrite").parquet(path)
    return read_stream_log(spark, path)


LOADED_X1 = f"""WITH {LOG}, {WM}, {recent_keys_cte(CACHE_DEFAULT, 'topic, "partition"', '"offset"', src='wm')},
kept AS (SELECT * FROM x1 WHERE NOT is_dup AND "offset" % {CORRUPT_EVERY} <> 0)"""


@register(
    "load_deduplicated",
    LOADED_X1
    + """
SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y%m%d') AS dt, strftime(date_trunc('hour', epoch_ms(watermark)), '%H') AS hr,
  count(*) AS records, min("offset") AS min_offset, max("offset") AS max_offset FROM kept GROUP BY ALL""",
)
def load_deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """K6 end to end: dedup (cache 2000) -> decode (bad rows out) -> hourly lake -> read back."""
    base = sink.scratch_path(spark, "load-hourly")
    loads.load(_encoded(spark, sf, corrupt=True), base, 0, loads.LoadSpec(dedup="recent", key_cache=CACHE_DEFAULT, roll_records=None))
    lake = sink.read_loaded(spark, base, "hourly", committed_only=True)
    return lake.groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("records"), F.min("_kafka.offset").alias("min_offset"), F.max("_kafka.offset").alias("max_offset")
    )


@register(
    "load_plain",
    f"""WITH {LOG}, {WM}
SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y_%m_%d') AS dt, count(*) AS records,
  CAST(sum("offset") AS BIGINT) AS offset_sum, max(watermark) AS max_watermark FROM wm GROUP BY ALL""",
)
def load_plain(spark: SparkSession, sf: str) -> DataFrame:
    """K5: every record (no dedup), daily directories, GZIP, 10k-record files; read back."""
    base = sink.scratch_path(spark, "load-daily")
    spec = loads.LoadSpec(dedup=None, layout="daily", roll_records=10_000, parquet=sink.ParquetOptions(compression="GZIP"))
    loads.load(_encoded(spark, sf), base, 0, spec)
    lake = sink.read_loaded(spark, base, "daily")
    return lake.groupBy("dt").agg(
        F.count(F.lit(1)).alias("records"), F.sum("_kafka.offset").alias("offset_sum"), F.max("_kafka.watermark").alias("max_watermark")
    )


FILE_ROLL = 1000


@register(
    "file_ranges",
    f"""WITH {LOG}, {X3.format(src='log')},
r AS (SELECT *, (row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) // {FILE_ROLL} AS file_seq FROM kept)
SELECT topic || '_' || CAST("partition" AS VARCHAR) || '_' || CAST(min("offset") AS VARCHAR) || '_' || CAST(max("offset") AS VARCHAR) || '.parquet' AS file,
  topic, "partition", min("offset") AS min_offset, max("offset") AS max_offset, count(*) AS records
FROM r GROUP BY topic, "partition", file_seq""",
)
def file_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """K7 + F6: by-topic-partition load (files named by offset range), then each file's range."""
    base = sink.scratch_path(spark, "load-tp")
    spec = loads.LoadSpec(dedup="offsets", dedup_offsets=DEDUP_OFFSETS, layout="topic_partition", roll_records=FILE_ROLL)
    loads.load(_encoded(spark, sf), base, 0, spec)
    lake = sink.read_loaded(spark, base, "topic_partition")
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return partitioning.file_ranges(lake, name)


@register(
    "parquet_roundtrip",
    DECODED_SQL,
)
def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K1-K3: decoded rows written with ZSTD, 1 MiB row groups, 64 KiB pages; read back."""
    path = sink.scratch_path(spark, "roundtrip")
    decoded = codec.drop_malformed(codec.decode_proto(_encoded(spark, sf)))
    sink.write_parquet(decoded, path, sink.ParquetOptions(compression="ZSTD", block_size=1 << 20, page_size=1 << 16), mode="overwrite")
    return spark.read.parquet(path).select(*_decoded_cols())


# ------------------------------------------------------------------ M1-M10
def _metrics(spark: SparkSession, sf: str, *metrics: str) -> DataFrame:
    """The named load metrics, derived from the marked log."""
    marked = dedup.watermark_offset_dedup(events_log(spark, sf), DEDUP_OFFSETS).select(
        "topic", "partition", "offset", "key", "watermark", "is_dup"
    )
    if metrics == (monitoring.COMMIT_BUCKET,):  # positions in files take two passes over the kept records: computed once
        kept = sink.materialize(marked.where(~F.col("is_dup")).select("topic", "partition", "offset", "watermark"), "kept-log")
        marked = kept.withColumns({"key": F.lit(None).cast("binary"), "is_dup": F.lit(False)})
    return monitoring.metrics_from_log(marked, metrics=list(metrics))


_BUCKETS = ", ".join(f"('{b}')" for b in monitoring.DURATION_BUCKETS)
METRICS_SQL = f"""WITH {LOG}, {WM},
x3 AS (SELECT *, lag("offset") OVER (PARTITION BY topic, "partition", k ORDER BY "offset") AS prev_off FROM wm),
marked AS (SELECT *, (prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS}) AS is_dup FROM x3),
x AS (SELECT topic, "partition", "offset", watermark, CAST(is_dup AS INTEGER) AS dup, strlen(k) AS nbytes,
      CAST((floor(watermark / {monitoring.SCRAPE_MS}) + 1) * {monitoring.SCRAPE_MS} AS BIGINT) AS scrape FROM marked),
agg AS (SELECT topic, "partition", scrape, sum(1 - dup) AS n_kept, sum(dup) AS n_dup, max(watermark) AS wm_max,
        max("offset") AS off_max FROM x GROUP BY topic, "partition", scrape),
cum AS (SELECT *, CAST(sum(n_kept) OVER w AS DOUBLE) AS kept_cum, CAST(sum(n_dup) OVER w AS DOUBLE) AS dup_cum,
        max(off_max) OVER (PARTITION BY topic, "partition") AS end_off FROM agg
        WINDOW w AS (PARTITION BY topic, "partition" ORDER BY scrape ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _rate_sql(value: str, by: str, window: int, extra: str = "") -> str:
    """Per-sample increase of a per-(topic, partition) counter, summed per window."""
    return f"""s AS (SELECT topic, "partition", scrape, {value} AS v FROM cum),
i AS (SELECT *, CASE WHEN lag(v) OVER (PARTITION BY topic, "partition" ORDER BY scrape) IS NULL THEN v
                     WHEN v >= lag(v) OVER (PARTITION BY topic, "partition" ORDER BY scrape) THEN v - lag(v) OVER (PARTITION BY topic, "partition" ORDER BY scrape)
                     ELSE v END AS inc FROM s)
SELECT {by}, CAST(floor(scrape / {window}) * {window} AS BIGINT) AS window_ms, {extra or f'sum(inc) / {window / 1000.0} AS rate'}
FROM i GROUP BY ALL"""


_TP = 'topic, CAST("partition" AS VARCHAR) AS "partition"'


@register(
    "watermark_delay",
    METRICS_SQL
    + f"""
SELECT {_TP}, CAST(floor(scrape / 60000) * 60000 AS BIGINT) AS window_ms, min(CAST(scrape - wm_max AS DOUBLE)) AS delay_ms
FROM cum WHERE scrape - wm_max < {monitoring.MAX_DELAY_MS} GROUP BY ALL""",
)
def watermark_delay(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.watermark_delay(_metrics(spark, sf, monitoring.WATERMARK_DELAY))


@register(
    "offset_lag",
    METRICS_SQL
    + f"""
SELECT {_TP}, CAST(floor(scrape / 60000) * 60000 AS BIGINT) AS window_ms, CAST(arg_max(end_off - off_max, scrape) AS DOUBLE) AS lag
FROM cum GROUP BY ALL""",
)
def offset_lag(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.offset_lag(_metrics(spark, sf, monitoring.RECORDS_LAG))


@register("records_batched_rate", METRICS_SQL + ",\n" + _rate_sql("kept_cum", _TP, 60000))
def records_batched_rate(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.records_batched_rate(_metrics(spark, sf, monitoring.RECORDS_BATCHED), topic_regex="ev.*")


@register("records_written_rate", METRICS_SQL + ",\n" + _rate_sql(f"floor(kept_cum / {monitoring.FILE_RECORDS}) * {monitoring.FILE_RECORDS}", _TP, 60000))
def records_written_rate(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.records_written_rate(_metrics(spark, sf, monitoring.RECORDS_WRITTEN))


@register(
    "in_flight_rate",
    METRICS_SQL
    + f""",
s AS (SELECT topic, "partition", scrape, kept_cum AS b, floor(kept_cum / {monitoring.FILE_RECORDS}) * {monitoring.FILE_RECORDS} AS w FROM cum),
i AS (SELECT *, CASE WHEN lag(b) OVER o IS NULL THEN b WHEN b >= lag(b) OVER o THEN b - lag(b) OVER o ELSE b END AS ib,
                CASE WHEN lag(w) OVER o IS NULL THEN w WHEN w >= lag(w) OVER o THEN w - lag(w) OVER o ELSE w END AS iw
      FROM s WINDOW o AS (PARTITION BY topic, "partition" ORDER BY scrape))
SELECT {_TP}, CAST(floor(scrape / 60000) * 60000 AS BIGINT) AS window_ms, sum(ib) / 60.0 - sum(iw) / 60.0 AS rate
FROM i GROUP BY ALL""",
)
def in_flight_rate(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.in_flight_rate(_metrics(spark, sf, monitoring.RECORDS_BATCHED, monitoring.RECORDS_WRITTEN))


@register("duplicate_rate", METRICS_SQL + ",\n" + _rate_sql("dup_cum", 'CAST("partition" AS VARCHAR) AS "partition"', 60000))
def duplicate_rate(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.duplicate_rate(_metrics(spark, sf, monitoring.DUPLICATES))


@register(
    "files_per_hour",
    METRICS_SQL
    + ",\n"
    + _rate_sql(
        f"floor(kept_cum / {monitoring.FILE_RECORDS})", f"'{monitoring.JOB}' AS job", 1_800_000,
        extra="sum(inc) / 1800.0 * 3600.0 AS files_per_hour",
    ),
)
def files_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.files_per_hour(_metrics(spark, sf, monitoring.COMMIT_COUNT))


@register(
    "commit_duration_p999",
    METRICS_SQL
    + f""",
kept AS (SELECT * FROM marked WHERE NOT is_dup),
pos AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS pos FROM kept),
files AS (SELECT topic, "partition", pos // {monitoring.FILE_RECORDS} AS file, min(watermark) AS lo, max(watermark) AS hi
          FROM pos GROUP BY ALL HAVING count(*) = {monitoring.FILE_RECORDS}),
f2 AS (SELECT topic, "partition", CAST((floor(hi / {monitoring.SCRAPE_MS}) + 1) * {monitoring.SCRAPE_MS} AS BIGINT) AS scrape,
       (hi - lo) / 1000.0 AS dur FROM files),
les AS (SELECT * FROM (VALUES {_BUCKETS}) t(le)),
per AS (SELECT topic, "partition", scrape, le,
        sum(CASE WHEN le = '+Inf' THEN 1 WHEN dur <= TRY_CAST(le AS DOUBLE) THEN 1 ELSE 0 END) AS hits
        FROM f2 CROSS JOIN les GROUP BY ALL),
c AS (SELECT *, CAST(sum(hits) OVER (PARTITION BY topic, "partition", le ORDER BY scrape
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS v FROM per),
i AS (SELECT *, CASE WHEN lag(v) OVER o IS NULL THEN v WHEN v >= lag(v) OVER o THEN v - lag(v) OVER o ELSE v END AS inc
      FROM c WINDOW o AS (PARTITION BY topic, "partition", le ORDER BY scrape)),
cnts AS (SELECT '{monitoring.LOADER_THREAD}' AS loader_thread, topic || '-' || CAST("partition" AS VARCHAR) AS partition_group, le,
         CAST(floor(scrape / 20000) * 20000 AS BIGINT) AS window_ms, sum(inc) AS cnt FROM i GROUP BY ALL),
b AS (SELECT *, CASE WHEN le = '+Inf' THEN CAST('inf' AS DOUBLE) ELSE CAST(le AS DOUBLE) END AS bound FROM cnts),
b2 AS (SELECT *, max(CASE WHEN le = '+Inf' THEN cnt END) OVER g AS total,
       coalesce(lag(cnt) OVER gb, 0) AS prev_cnt, coalesce(lag(bound) OVER gb, 0) AS prev_bound FROM b
       WINDOW g AS (PARTITION BY loader_thread, partition_group, window_ms),
              gb AS (PARTITION BY loader_thread, partition_group, window_ms ORDER BY bound)),
b3 AS (SELECT *, total * 0.999 AS rnk FROM b2 WHERE total > 0 AND cnt >= total * 0.999),
b4 AS (SELECT *, row_number() OVER (PARTITION BY loader_thread, partition_group, window_ms ORDER BY bound) AS rn FROM b3)
SELECT loader_thread, partition_group, window_ms,
  CASE WHEN bound = CAST('inf' AS DOUBLE) THEN prev_bound
       ELSE prev_bound + (bound - prev_bound) * (rnk - prev_cnt) / (cnt - prev_cnt) END AS duration_s
FROM b4 WHERE rn = 1""",
)
def commit_duration_p999(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.commit_duration_quantile(_metrics(spark, sf, monitoring.COMMIT_BUCKET), 0.999)


@register(
    "commit_queue_depth",
    METRICS_SQL
    + f""",
q AS (SELECT topic, "partition", scrape,
      floor(kept_cum / {monitoring.FILE_RECORDS}) - floor((kept_cum - n_kept) / {monitoring.FILE_RECORDS}) AS v FROM cum),
l AS (SELECT topic, "partition", CAST(floor(scrape / 60000) * 60000 AS BIGINT) AS window_ms, arg_max(v, scrape) AS v FROM q GROUP BY ALL)
SELECT '{monitoring.JOB}' AS job, window_ms, CAST(sum(v) AS DOUBLE) AS depth FROM l GROUP BY ALL""",
)
def commit_queue_depth(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.commit_queue_depth(_metrics(spark, sf, monitoring.COMMIT_QUEUE))


@register("topic_values", f"WITH {LOG} SELECT DISTINCT topic FROM log")
def topic_values(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.topic_values(_metrics(spark, sf, monitoring.BYTES_CONSUMED))


STREAM_SLICES = 4
STREAM_FILES = 8  # of a micro-batch
STREAM_FILE_RECORDS = 200_000  # of a topic file: micro-batches are so many files, whatever the size of the topic


def _topic_files(spark: SparkSession, log: DataFrame) -> str:
    """The topic as files arriving in offset order, each a range of offsets of bounded size.

    A file stream takes files by modification time, so each file is stamped one
    second after the one before it; as many as a micro-batch takes make a slice.
    """
    topic = sink.scratch_path(spark, "stream-topic")
    ranges = log.repartitionByRange(STREAM_SLICES * STREAM_FILES, "offset").sortWithinPartitions("offset")
    ranges.write.mode("overwrite").option("maxRecordsPerFile", STREAM_FILE_RECORDS).parquet(topic)
    fs = sink._FS(spark, topic)
    for i, f in enumerate(fs.data_files(topic)):  # names are in the order of ranges
        fs.set_mtime(f, 1_000_000_000_000 + i * 1000)
    return topic


@register(
    "stream_load_hourly",
    LOADED_X1.replace(f' AND "offset" % {CORRUPT_EVERY} <> 0', "")
    + """
SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y%m%d') AS dt, strftime(date_trunc('hour', epoch_ms(watermark)), '%H') AS hr,
  count(*) AS records, min("offset") AS min_offset, max("offset") AS max_offset FROM kept GROUP BY ALL""",
)
def stream_load_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming K6: the topic arrives as ordered files; watermark + cache live in stream state;
    every micro-batch is published under its batch id; the lake is read back through manifests."""
    from ..streaming.load import load_stream

    topic = _topic_files(spark, _encoded(spark, sf))
    base = sink.scratch_path(spark, "stream-lake")
    stream = read_stream_log(spark, topic, streaming=True, max_files_per_trigger=STREAM_FILES)
    spec = loads.LoadSpec(dedup="recent", key_cache=CACHE_DEFAULT, roll_records=None)
    q = load_stream(stream, base, spec, checkpoint=sink.scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    lake = sink.read_loaded(spark, base, "hourly", committed_only=True)
    return lake.groupBy("dt", "hr").agg(
        F.count(F.lit(1)).alias("records"), F.min("_kafka.offset").alias("min_offset"), F.max("_kafka.offset").alias("max_offset")
    )


@register(
    "stream_dedup_offset_range",
    f'WITH {LOG}, {X3.format(src="log")} SELECT topic, "partition", "offset", '
    f'(prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS}) AS is_dup FROM x3',
)
def stream_dedup_offset_range(spark: SparkSession, sf: str) -> DataFrame:
    """X3 as a stream: watermark state per topic-partition, last-offset state per key;
    every micro-batch written under its id (a re-run replaces itself), then read back."""
    from ..streaming.load import dedup_stream

    log = events_log(spark, sf).withColumn("value", F.lit(None).cast("binary")).select(*KAFKA_SCHEMA.fieldNames())
    topic = _topic_files(spark, log)
    out = sink.scratch_path(spark, "stream-x3")
    stream = read_stream_log(spark, topic, streaming=True, max_files_per_trigger=STREAM_FILES)
    marked = dedup_stream(stream, loads.LoadSpec(dedup="offsets", dedup_offsets=DEDUP_OFFSETS))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.select("topic", "partition", "offset", "is_dup").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (marked.writeStream.foreachBatch(each).option("checkpointLocation", sink.scratch_path(spark, "stream-x3-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).select("topic", "partition", "offset", "is_dup")


FUZZY_MEAN, FUZZY_SD, FUZZY_SEED, FUZZY_FILES = 100.0, 20.0, 7, 4000


@register(
    "roll_fuzzy",
    f"""WITH {LOG},
p AS (SELECT topic, "partition", "offset", row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS pos FROM log),
u AS (SELECT k,
        (CAST('0x' || substr(md5('{FUZZY_SEED}/' || CAST(k AS VARCHAR) || '/a'), 1, 13) AS BIGINT) + 1) / {float(16**13 + 1)} AS ua,
        (CAST('0x' || substr(md5('{FUZZY_SEED}/' || CAST(k AS VARCHAR) || '/b'), 1, 13) AS BIGINT) + 1) / {float(16**13 + 1)} AS ub
      FROM range(0, {FUZZY_FILES}) t(k)),
s AS (SELECT k, greatest(1, CAST(round({FUZZY_MEAN} + {FUZZY_SD} * (sqrt(-2.0 * ln(ua)) * cos(2.0 * 3.141592653589793 * ub))) AS BIGINT)) AS size FROM u),
f AS (SELECT k, sum(size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fend, size FROM s)
SELECT p.topic, p."partition", p."offset", f.k AS file_seq FROM p JOIN f ON p.pos >= f.fend - f.size AND p.pos < f.fend""",
)
def roll_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    """per topic-partition files at Gaussian-jittered record limits (mean 100, sd 20, seed 7)."""
    return partitioning.roll_fuzzy(events_log(spark, sf), FUZZY_MEAN, FUZZY_SD, FUZZY_SEED).select(
        "topic", "partition", "offset", "file_seq"
    )


# ------------------------------------- several chunks, increments, reports
CHUNK_SMALL = 500  # offsets per chunk: many chunks at every scale


@register("stream_watermark_chunks", ORACLE_SQL["stream_watermark"])
def stream_watermark_chunks(spark: SparkSession, sf: str) -> DataFrame:
    x = watermark.with_stream_watermark(events_log(spark, sf), chunk_size=CHUNK_SMALL)
    return x.select(*_tp_cols(), ts_millis("timestamp").alias("timestamp_ms"), "watermark")


@register("roll_by_records_chunks", ORACLE_SQL["roll_by_records"])
def roll_by_records_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return partitioning.roll_by_records(events_log(spark, sf), ROLL_RECORDS, chunk_size=CHUNK_SMALL).select(*_tp_cols(), "file_seq")


@register("dedup_watermark_range_chunks", ORACLE_SQL["dedup_watermark_range"])
def dedup_watermark_range_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_watermark_range(events_log(spark, sf), DEDUP_MS, chunk_size=CHUNK_SMALL).select(*_tp_cols(), "is_dup")


@register("dedup_recent_keys_chunks", ORACLE_SQL["dedup_recent_keys"])
def dedup_recent_keys_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_recent_keys(events_log(spark, sf), CACHE_SMALL, chunk_size=CHUNK_SMALL).select(*_tp_cols(), "is_dup")


@register("hour_bucket_counts_chunks", ORACLE_SQL["hour_bucket_counts"])
def hour_bucket_counts_chunks(spark: SparkSession, sf: str) -> DataFrame:
    x = dedup.watermark_offset_dedup(events_log(spark, sf), DEDUP_OFFSETS, chunk_size=CHUNK_SMALL)
    x = partitioning.time_partition(dedup.drop_duplicates_marked(x), "hourly")
    return x.groupBy("dt", "hr", "topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset")
    )


_LAKE_DAYS = """
SELECT strftime(date_trunc('hour', epoch_ms(watermark)), '%Y_%m_%d') AS dt, count(*) AS records, min("offset") AS min_offset, max("offset") AS max_offset FROM kept GROUP BY ALL"""


def _lake_days(lake: DataFrame) -> DataFrame:
    return lake.groupBy("dt").agg(
        F.count(F.lit(1)).alias("records"), F.min("_kafka.offset").alias("min_offset"), F.max("_kafka.offset").alias("max_offset")
    )


@register(
    "load_deduplicated_small",
    f"""WITH {LOG}, {WM}, {recent_keys_cte(CACHE_SMALL, 'topic, "partition"', '"offset"', src='wm')},
kept AS (SELECT * FROM x1 WHERE NOT is_dup AND "offset" % {CORRUPT_EVERY} <> 0)"""
    + _LAKE_DAYS,
)
def load_deduplicated_small(spark: SparkSession, sf: str) -> DataFrame:
    """K6 with a cache that evicts and several chunks."""
    base = sink.scratch_path(spark, "load-small")
    loads.load(_encoded(spark, sf, corrupt=True), base, 0, loads.LoadSpec(dedup="recent", key_cache=CACHE_SMALL, layout="daily", chunk_size=CHUNK_SMALL))
    return _lake_days(sink.read_loaded(spark, base, "daily", committed_only=True))


@register(
    "file_ranges_recent_keys",
    f"""WITH {LOG}, {recent_keys_cte(CACHE_SMALL, 'topic, "partition"', '"offset"')},
kept AS (SELECT * FROM x1 WHERE NOT is_dup),
r AS (SELECT *, (row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) // {FILE_ROLL} AS file_seq FROM kept)
SELECT topic || '_' || CAST("partition" AS VARCHAR) || '_' || CAST(min("offset") AS VARCHAR) || '_' || CAST(max("offset") AS VARCHAR) || '.parquet' AS file,
  topic, "partition", min("offset") AS min_offset, max("offset") AS max_offset, count(*) AS records
FROM r GROUP BY topic, "partition", file_seq""",
)
def file_ranges_recent_keys(spark: SparkSession, sf: str) -> DataFrame:
    """K7 with the recent-key cache."""
    base = sink.scratch_path(spark, "load-tp-x1")
    loads.load_by_topic_partition(_encoded(spark, sf), base, 0, key_cache=CACHE_SMALL, roll_records=FILE_ROLL)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return partitioning.file_ranges(sink.read_loaded(spark, base, "topic_partition"), name)


def _thirds(log: DataFrame) -> tuple[int, int]:
    b = log.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    return b.lo + (b.hi - b.lo) // 3, b.lo + 2 * (b.hi - b.lo) // 3


@register(
    "load_increments",
    f"""WITH {LOG}, {WM}, {X3.format(src='wm')}
SELECT topic, "partition", "offset", watermark, strftime(date_trunc('hour', epoch_ms(watermark)), '%Y_%m_%d') AS dt FROM kept""",
)
def load_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, each reading the topic from its start, equal one batch:
    committed offsets are skipped, the watermark and the dedup rule go on."""
    base = sink.scratch_path(spark, "load-increments")
    topic = _encoded(spark, sf)
    first, second = _thirds(topic)
    spec = loads.LoadSpec(dedup="offsets", dedup_offsets=DEDUP_OFFSETS, rewind=DEDUP_OFFSETS, resume=True, layout="daily", chunk_size=CHUNK_SMALL)
    loads.load(topic.where(F.col("offset") < first), base, 0, spec)
    loads.load(topic.where(F.col("offset") < second), base, 1, spec)
    loads.load(topic, base, 2, spec)
    lake = sink.read_loaded(spark, base, "daily", committed_only=True)
    return lake.select("_kafka.topic", "_kafka.partition", "_kafka.offset", "_kafka.watermark", "dt")


@register(
    "dedup_with_rewind",
    f"""WITH {LOG}, b AS (SELECT min("offset") + (max("offset") - min("offset")) // 3 AS at FROM log), {X3.format(src="log")}
SELECT topic, "partition", "offset", (prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS}) AS is_dup FROM x3, b WHERE "offset" >= b.at""",
)
def dedup_with_rewind(spark: SparkSession, sf: str) -> DataFrame:
    """A later slice of the log, warmed with the offsets before it."""
    log = events_log(spark, sf)
    at, _ = _thirds(log)
    warmed = dedup.with_rewind(log.where(F.col("offset") >= at), log, DEDUP_OFFSETS)
    return dedup.drop_rewound(dedup.dedup_offset_range(warmed, DEDUP_OFFSETS)).select(*_tp_cols(), "is_dup")


def _reported(spark: SparkSession, sf: str) -> str:
    base = sink.scratch_path(spark, "load-report")
    spec = loads.LoadSpec(dedup="offsets", dedup_offsets=DEDUP_OFFSETS, predicate=F.col("price") > F.lit(FILTER_PRICE), layout="daily", report=True)
    loads.load(_encoded(spark, sf, corrupt=True), base, 0, spec)
    return base


@register(
    "load_dead_letters",
    f"""WITH {LOG}, {WM}, {X3.format(src='wm')}
SELECT topic, "partition", "offset", watermark, CAST(0 AS BIGINT) AS batch FROM kept WHERE "offset" % {CORRUPT_EVERY} = 0""",
)
def load_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """The malformed records that a load set aside (duplicates are dropped before decoding)."""
    return loads.read_dead_letters(spark, _reported(spark, sf))


@register(
    "load_drop_counts",
    f"""WITH {LOG}, {X3.format(src='log')},
m AS (SELECT x3.*, e.value, (prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS}) AS dup, ("offset" % {CORRUPT_EVERY} = 0) AS bad
      FROM x3 JOIN events e ON e.event_id = x3."offset")
SELECT topic, "partition", count(*) AS records, count(*) FILTER (dup) AS duplicates, count(*) FILTER (NOT dup AND bad) AS malformed,
  count(*) FILTER (NOT dup AND NOT bad AND NOT coalesce(value > {FILTER_PRICE}, FALSE)) AS filtered FROM m GROUP BY ALL""",
)
def load_drop_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a load dropped per topic-partition, from its manifest (one row each)."""
    import json

    base = _reported(spark, sf)
    m = json.loads(sink._FS(spark, base).read_text(sink.manifest_path(base, 0)))
    read = {(p["topic"], p["partition"]): p["records"] for p in m["positions"]}
    rows = [(d["topic"], d["partition"], read[(d["topic"], d["partition"])], d["duplicate"], d["malformed"], d["filtered"]) for d in m["dropped"]]
    return spark.createDataFrame(rows, "topic string, partition int, records long, duplicates long, malformed long, filtered long")


@register(
    "load_custom_partition",
    f"""WITH {LOG} SELECT e.event_type AS kind, CAST(log."partition" AS VARCHAR) AS part, count(*) AS records
FROM log JOIN events e ON e.event_id = log."offset" GROUP BY ALL""",
)
def load_custom_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Directories by columns of the caller's own."""
    base = sink.scratch_path(spark, "load-custom")
    spec = loads.LoadSpec(dedup=None, layout="custom", partition_columns={"kind": F.col("name"), "part": F.col("partition").cast("string")})
    loads.load(_encoded(spark, sf), base, 0, spec)
    lake = sink.read_loaded(spark, base, "custom", committed_only=True)
    return lake.groupBy("kind", "part").agg(F.count(F.lit(1)).alias("records"))


@register(
    "load_formatter_1n",
    """SELECT event_id AS "offset", CAST(user_id AS INTEGER) AS something, 0 AS nth FROM events
UNION ALL SELECT event_id AS "offset", CAST(json_extract_string(props, '$.k') AS INTEGER) AS something, 1 AS nth FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL""",
)
def load_formatter_1n(spark: SparkSession, sf: str) -> DataFrame:
    """One row per element of a repeated field, written by the load."""
    base = sink.scratch_path(spark, "load-format")
    spec = loads.LoadSpec(dedup=None, layout="daily", formatter=lambda x: x.select("*", F.posexplode("somethings").alias("nth", "something")).drop("somethings"))
    loads.load(_encoded(spark, sf), base, 0, spec)
    return sink.read_loaded(spark, base, "daily", committed_only=True).select("_kafka.offset", "something", "nth")


@register(
    "hour_windows",
    f"""WITH {LOG}, {WM}
SELECT CAST(epoch_ms(date_trunc('hour', epoch_ms(watermark))) AS BIGINT) AS bucket_ms,
  CAST(epoch_ms(date_trunc('hour', epoch_ms(watermark))) + 3600000 AS BIGINT) AS end_ms, count(*) AS records FROM wm GROUP BY ALL""",
)
def hour_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling hour windows of the watermark, as millis."""
    w = _wm(spark, sf).groupBy(watermark.hour_window().alias("w")).agg(F.count(F.lit(1)).alias("records"))
    return w.select(watermark.bucket_millis("w.start").alias("bucket_ms"), watermark.bucket_millis("w.end").alias("end_ms"), "records")


@register(
    "topic_partition_values",
    f"""WITH {LOG2} SELECT topic AS part_topic, "partition" AS part_partition, count(*) AS records, min("offset") AS min_offset, max("offset") AS max_offset
FROM log GROUP BY ALL""",
)
def topic_partition_values(spark: SparkSession, sf: str) -> DataFrame:
    """Records and offset span per topic-partition value."""
    x = partitioning.topic_partition_partitioner(two_topic_log(spark, sf))
    r = positions.offset_ranges(x, extra=["_tw_part_topic", "_tw_part_partition"])
    return r.select(F.col("_tw_part_topic").alias("part_topic"), F.col("_tw_part_partition").alias("part_partition"), "records", "min_offset", "max_offset")


ROLL_BYTES = 500


@register(
    "roll_by_bytes",
    f"""WITH {LOG}, n AS (SELECT greatest(1, CAST(floor({ROLL_BYTES} / greatest(avg(strlen(k)), 1.0)) AS BIGINT)) AS n FROM log)
SELECT topic, "partition", "offset", (row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) // n.n AS file_seq FROM log, n""",
)
def roll_by_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """a byte limit as a record limit, from the mean record size (here: of the keys)."""
    log = events_log(spark, sf)
    mean = log.agg(F.avg(F.octet_length("key"))).first()[0]
    n = partitioning.target_records_per_file(mean, ROLL_BYTES)
    return partitioning.roll_by_records(log, n, chunk_size=CHUNK_SMALL).select(*_tp_cols(), "file_seq")


def _keyless(log: DataFrame) -> DataFrame:
    """The log with no key on every fifth offset."""
    return log.withColumn("key", F.when(F.col("offset") % 5 != 0, F.col("key")))


def _marked_stream(spark: SparkSession, log: DataFrame, spec: loads.LoadSpec, name: str) -> DataFrame:
    from ..streaming.load import dedup_stream

    topic = _topic_files(spark, log.withColumn("value", F.lit(None).cast("binary")).select(*KAFKA_SCHEMA.fieldNames()))
    out = sink.scratch_path(spark, name)
    marked = dedup_stream(read_stream_log(spark, topic, streaming=True, max_files_per_trigger=STREAM_FILES), spec)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.select("topic", "partition", "offset", "is_dup").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = marked.writeStream.foreachBatch(each).option("checkpointLocation", sink.scratch_path(spark, f"{name}-ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).select("topic", "partition", "offset", "is_dup")


@register(
    "stream_dedup_null_keys",
    f"""WITH log AS (SELECT CASE WHEN "offset" % 5 <> 0 THEN k END AS k, topic, "partition", "offset", ts_ms FROM ({EVENTS_LOG_SQL})),
{X3.format(src="log")} SELECT topic, "partition", "offset", (k IS NOT NULL AND prev_off IS NOT NULL AND "offset" - prev_off <= {DEDUP_OFFSETS}) AS is_dup FROM x3""",
)
def stream_dedup_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """X3 as a stream over a log with records that have no key: none of them is a duplicate."""
    return _marked_stream(spark, _keyless(events_log(spark, sf)), loads.LoadSpec(dedup="offsets", dedup_offsets=DEDUP_OFFSETS), "stream-null")


@register(
    "stream_dedup_watermark_range",
    f"""WITH log AS (SELECT CASE WHEN "offset" % 5 <> 0 THEN k END AS k, topic, "partition", "offset", ts_ms FROM ({EVENTS_LOG_SQL})),
l AS (SELECT *, lag(ts_ms) OVER (PARTITION BY topic, "partition", k ORDER BY "offset") AS prev_ts FROM log)
SELECT topic, "partition", "offset", (k IS NOT NULL AND prev_ts IS NOT NULL AND ts_ms - prev_ts <= {DEDUP_MS}) AS is_dup FROM l""",
)
def stream_dedup_watermark_range(spark: SparkSession, sf: str) -> DataFrame:
    """X4 as a stream, keyless records included."""
    return _marked_stream(spark, _keyless(events_log(spark, sf)), loads.LoadSpec(dedup="time", dedup_ms=DEDUP_MS), "stream-x4")

"""Stateful processors for streams (W1 + X1, X3) on ``transformWithStateInPandas``.

State lives in the RocksDB state store and the query checkpoint, so a
restarted query continues with the cache and watermark it had — the
re-read warm-up of the loader is not needed.  Rows of one key that arrive
in one micro-batch may come in several pandas chunks; they are gathered and
sorted by offset before the rule runs, so results do not depend on chunking.
A micro-batch is bounded by the source's ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schema import key_string
from ..session import ship_package

KEY_GROUPS = 256  # groups that the keys of a topic-partition are dealt to; its keyless records go by offset
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class WatermarkRecentKeys(StatefulProcessor):
    """Per topic-partition (or group): running watermark and the exact recent-key cache.

    ``capacity=None`` keeps the watermark only; ``watermark=False`` keeps the
    cache only (the watermark column then passes through), for scopes wider
    than a topic-partition, whose records are ordered by (timestamp, topic,
    partition, offset).
    """

    def __init__(self, capacity: int | None, watermark: bool = True):
        self.capacity = capacity
        self.with_watermark = watermark

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.wm = handle.getValueState("watermark", "wm long")
        self.cache = handle.getValueState("cache", "keys array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        if self.with_watermark:
            pdf = pdf.sort_values("offset", kind="mergesort")
            times = pdf["tw_ts_ms"].astype("Int64").cummax().ffill()  # a record without a time keeps the watermark
            if self.wm.exists():
                wm = self.wm.get()[0]
                times = times.fillna(wm).clip(lower=wm)
            wms = times
            if not pd.isna(times.iloc[-1]):
                self.wm.update((int(times.iloc[-1]),))
        else:
            pdf = pdf.sort_values(["tw_ts_ms", "topic", "partition", "offset"], kind="mergesort")
        dups = [False] * len(pdf)
        if self.capacity is not None:
            cache = OrderedDict.fromkeys(self.cache.get()[0] if self.cache.exists() else [])  # oldest first
            cap = self.capacity
            for i, k in enumerate(pdf["tw_dedup_key"].tolist()):
                if k is None:
                    continue
                dups[i] = k in cache
                if len(cache) >= cap:
                    cache.popitem(last=False)
                cache[k] = None
                cache.move_to_end(k)
            self.cache.update((list(cache),))
        out = pdf.drop(columns=[c for c in ("tw_ts_ms", "tw_dedup_key", "tw_partition") if c in pdf.columns])
        if self.with_watermark:
            out["watermark"] = wms
        out["is_dup"] = dups
        yield out

    def close(self) -> None:
        pass


class LastOffsetDedup(StatefulProcessor):
    """X3/X4 for groups of keys of a scope: duplicate iff the key's previous record is recent.

    ``by="offset"``: within ``n`` offsets (X3); ``by="time"``: at most ``n`` ms
    older (X4).  Every record refreshes the key's state, kept or not.  Records
    without a key are no duplicates of one another and keep no state.  A group's
    records of a micro-batch are compared as arrays; the state is asked for a key's
    first record there and set by its last one.
    """

    def __init__(self, n: int, ttl_ms: int | None = None, by: str = "offset"):
        self.n = n
        self.ttl_ms = ttl_ms
        self.by = by

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "k string", "off long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values("offset", kind="mergesort")
        values = pdf["offset" if self.by == "offset" else "tw_ts_ms"].to_numpy()
        codes, keys = pd.factorize(pdf["tw_dedup_key"])  # -1: no key
        order = np.argsort(codes, kind="stable")
        codes, values = codes[order], values[order]
        again = np.concatenate([[False], codes[1:] == codes[:-1]])
        dups = again & (np.concatenate([[0], values[1:] - values[:-1]]) <= self.n) & (codes >= 0)
        for i in np.flatnonzero(~again & (codes >= 0)).tolist():
            last = self.last.getValue((keys[codes[i]],))
            dups[i] = last is not None and values[i] - last[0] <= self.n
        for i in np.flatnonzero(np.concatenate([codes[1:] != codes[:-1], [True]]) & (codes >= 0)).tolist():
            if not pd.isna(values[i]):
                self.last.updateValue((keys[codes[i]],), (int(values[i]),))
            elif self.last.containsKey((keys[codes[i]],)):  # nothing compares with a record without a time
                self.last.removeKey((keys[codes[i]],))
        is_dup = np.empty(len(dups), dtype=bool)
        is_dup[order] = dups
        out = pdf.drop(columns=[c for c in ("tw_dedup_key", "tw_ts_ms", "tw_spread", "tw_partition") if c in pdf.columns])
        out["is_dup"] = is_dup
        yield out

    def close(self) -> None:
        pass


def _by_partition(df: DataFrame) -> DataFrame:
    """With ``tw_partition`` to group by: pandas reads a null number as NaN, which equals no other, so each
    record of a null partition would be a group, in no order."""
    return df.withColumn("tw_partition", F.coalesce("partition", F.lit(-1).cast("int")))


def _prep(df: DataFrame) -> None:
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def watermark_and_dedup(stream: DataFrame, capacity: int | None, scope: list[str] | None = None) -> DataFrame:
    """W1 + X1 on a stream.

    Per topic-partition scope (default): one stateful operator does both.
    A wider scope (e.g. one ``root`` group): the watermark stays per
    topic-partition in a first operator, the cache is kept per scope in a
    second one.
    """
    _prep(stream)
    scope = scope or ["topic", "partition"]
    tp = sorted(scope) == ["partition", "topic"]
    x = stream.withColumn("tw_ts_ms", F.unix_millis(F.col("timestamp"))).withColumn("tw_dedup_key", key_string("key"))
    fields = [f for f in x.schema.fields if f.name not in ("tw_ts_ms", "tw_dedup_key")]
    out = T.StructType(fields + [T.StructField("watermark", T.LongType()), T.StructField("is_dup", T.BooleanType())])
    if tp or capacity is None:
        return _by_partition(x).groupBy("topic", "tw_partition").transformWithStateInPandas(
            WatermarkRecentKeys(capacity), out, "Append", "None"
        )
    wm = _by_partition(x).groupBy("topic", "tw_partition").transformWithStateInPandas(WatermarkRecentKeys(None), out, "Append", "None")
    y = wm.drop("is_dup").withColumn("tw_ts_ms", F.unix_millis(F.col("timestamp"))).withColumn("tw_dedup_key", key_string("key"))
    return y.groupBy(*scope).transformWithStateInPandas(WatermarkRecentKeys(capacity, watermark=False), out, "Append", "None")


def offset_range_dedup(stream: DataFrame, n: int, ttl_ms: int | None = None, by: str = "offset") -> DataFrame:
    """X3 (``by="offset"``) or X4 (``by="time"``, ``n`` in ms) on a stream, keyed by (topic, partition, key).

    ``ttl_ms`` bounds the per-key state (keys idle longer are forgotten); TTL
    runs on processing time.  A run-to-completion trigger (``availableNow``)
    with TTL also needs ``spark.sql.streaming.noDataMicroBatches.enabled=false``,
    or the query keeps scheduling clean-up batches.
    """
    _prep(stream)
    x = stream.withColumn("tw_dedup_key", key_string("key"))
    # one group per key would call Python and the state for every key of a micro-batch by itself
    dealt_by = F.when(F.col("tw_dedup_key").isNull(), F.col("offset")).otherwise(F.xxhash64("tw_dedup_key"))
    x = x.withColumn("tw_spread", F.pmod(dealt_by, F.lit(KEY_GROUPS)).cast("int"))
    if by == "time":
        x = x.withColumn("tw_ts_ms", F.unix_millis(F.col("timestamp")))
    fields = [f for f in x.schema.fields if f.name not in ("tw_dedup_key", "tw_ts_ms", "tw_spread")]
    out = T.StructType(fields + [T.StructField("is_dup", T.BooleanType())])
    # state TTL (bounding the per-key state) runs on processing time
    time_mode = "ProcessingTime" if ttl_ms else "None"
    return _by_partition(x).groupBy("topic", "tw_partition", "tw_spread").transformWithStateInPandas(
        LastOffsetDedup(n, ttl_ms, by), out, "Append", time_mode
    )

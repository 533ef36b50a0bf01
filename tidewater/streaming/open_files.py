"""Files that stay open over micro-batches, with limits and a heartbeat (F2-F4, W5 on streams).

Records of a topic-partition are held in state until one of its open files
reaches a limit; then all of them are handed on, marked with their commit.  Open
time runs on the clock of processing: a timer is set when a batch's first record
comes, and closes the batch even if nothing more comes.  Held records lie in the
state store (and the query checkpoint) as one Arrow block for each micro-batch,
written once; a micro-batch that closes nothing reads none of them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.rolling import Limits
from .processors import _prep

COMMIT = "tw_commit"


def _packed(pdf: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(block: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(pa.py_buffer(block)) as reader:
        return reader.read_all().to_pandas()


class OpenFiles(StatefulProcessor):
    """Holds a topic-partition's records until a limit of any file, or the time of the first record, closes the batch."""

    def __init__(self, limits: Limits):
        self.limits = limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "block binary")
        self.open = handle.getValueState("open", "batch long, files string, timer long")

    def _state(self) -> tuple[int, dict, int]:
        if not self.open.exists():
            return 0, {}, 0
        batch, files, timer = self.open.get()
        return batch, json.loads(files), timer

    def _close(self, key, batch: int, last: list[pd.DataFrame]) -> pd.DataFrame:
        blocks = [_unpacked(b[0]) for b in self.held.get()] if self.held.exists() else []
        self.held.clear()
        out = pd.concat([*blocks, *last], ignore_index=True)
        out[COMMIT] = "-".join(str(k) for k in [*key, batch])
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values("offset", kind="mergesort")
        again = pdf["is_dup"].astype(bool)
        if again.any():  # nothing of a duplicate is written, so it waits for nothing
            out = pdf[again].drop(columns=["tw_file", "tw_bytes"])
            out[COMMIT] = None
            yield out
            pdf = pdf[~again]
        batch, files, timer = self._state()
        start, now = 0, timerValues.getCurrentProcessingTimeInMs()
        kept = pdf.drop(columns=["tw_file", "tw_bytes"])
        for i, (f, size) in enumerate(zip(pdf["tw_file"].tolist(), pdf["tw_bytes"].tolist(), strict=True)):
            state = files.setdefault(f, [0, 0])
            state[0] += 1
            state[1] += int(size)
            if self.limits.records and state[0] >= self.limits.records or self.limits.size and state[1] >= self.limits.size:
                yield self._close(key, batch, [kept.iloc[start : i + 1]])
                batch, files, start = batch + 1, {}, i + 1
                if timer:
                    self.handle.deleteTimer(timer)
                    timer = 0
        if start < len(kept):
            self.held.appendValue((_packed(kept.iloc[start:]),))
            if self.limits.open_ms and not timer:
                timer = int(now) + self.limits.open_ms
                self.handle.registerTimer(timer)
        self.open.update((batch, json.dumps(files), timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        batch, _, _ = self._state()
        if self.held.exists():
            yield self._close(key, batch, [])
            self.open.update((batch + 1, "{}", 0))

    def close(self) -> None:
        pass


def hold_open_files(marked: DataFrame, limits: Limits, file: Column, size: Column) -> DataFrame:
    """The records of a marked stream once their batch closes, with ``tw_commit``; duplicates at once, without one.

    ``file``: a text that names a record's file; ``size``: its bytes."""
    _prep(marked)
    fields = marked.schema.fields
    x = marked.withColumns({"tw_file": F.coalesce(file, F.lit("")), "tw_bytes": F.coalesce(size.cast("long"), F.lit(0).cast("long"))})
    out = T.StructType([*fields, T.StructField(COMMIT, T.StringType())])
    return x.groupBy("topic", "partition").transformWithStateInPandas(OpenFiles(limits), out, "Append", "ProcessingTime")

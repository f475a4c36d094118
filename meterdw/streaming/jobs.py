"""Streaming jobs of the layers.

There is one stateful operator: the partial aggregate per (device, window). In append mode
all devices of a window leave the state in the same micro-batch, once the watermark has
passed the window end, so the batch code turns them into device, substation and customer
summaries, distinct counts included. Dimensions are read anew for every micro-batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from meterdw.functions import grading
from meterdw.operators import changelog, detail, rollup, serving
from meterdw.schemas import MEASURE_TYPES
from meterdw.sinks.files import read_latest, upsert_batch
from meterdw.sinks.state import KeyedState
from meterdw.sinks.versions import ddl
from meterdw.streaming.source import WATERMARK, with_event_time, zoneless

Handler = Callable[[DataFrame, int], None]
Summary = Callable[[DataFrame], DataFrame]


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def start(stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """foreachBatch query with a checkpoint; without an interval it drains the source and ends."""
    watch(stream.sparkSession)
    return (stream.writeStream.foreachBatch(handler).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start())


class Flow(StreamingQueryListener):
    """Adds up what every query of a session reports; a query itself only keeps its last reports."""

    def __init__(self):
        self.runs: dict[str, dict] = {}

    @staticmethod
    def nothing() -> dict:
        return {"batches": 0, "rows": 0, "busy_ms": 0, "late_rows": 0, "upto": ""}

    @staticmethod
    def add(sums: dict, progress) -> None:
        sums["batches"] += progress["numInputRows"] > 0
        sums["rows"] += progress["numInputRows"]
        sums["busy_ms"] += progress["durationMs"].get("triggerExecution", 0)
        sums["late_rows"] += sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
        sums["upto"] = progress["timestamp"]

    def onQueryStarted(self, event):
        self.runs[str(event.runId)] = self.nothing()

    def onQueryProgress(self, event):
        self.add(self.runs.setdefault(str(event.progress.runId), self.nothing()), json.loads(event.progress.json))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


_flows: dict[str, Flow] = {}


def watch(spark: SparkSession) -> Flow:
    """The counters of a session, from its first job on."""
    name = spark._jsparkSession.sessionUUID()
    if name not in _flows:
        _flows[name] = Flow()
        spark.streams.addListener(_flows[name])
    return _flows[name]


def flow(query: StreamingQuery) -> dict:
    """What a query has processed since it started: batches, rows, rows per second, rows dropped as late.

    Reports reach the counters a little late; those still under way are read from the query itself.
    """
    found = next((f.runs[str(query.runId)] for f in _flows.values() if str(query.runId) in f.runs), Flow.nothing())
    sums = dict(found)
    for progress in query.recentProgress:
        if progress["timestamp"] > sums["upto"]:
            Flow.add(sums, progress)
    busy = sums["busy_ms"] / 1000
    last = query.lastProgress
    return {"batches": sums["batches"], "rows": sums["rows"], "rows_per_second": sums["rows"] / busy if busy else 0.0,
            "late_rows": sums["late_rows"],
            "watermark": last["eventTime"].get("watermark") if last and sums["batches"] else None}


def fan_out(outputs: dict[str, Summary]) -> Handler:
    """Writes several outputs of one micro-batch as idempotent batches; the batch is computed once."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = zoneless(batch)
        if len(outputs) > 1:
            rows = rows.persist()
        try:
            for path, summary in outputs.items():
                upsert_batch(summary(rows), batch_id, path)
        finally:
            if len(outputs) > 1:
                rows.unpersist()
    return handle


def copy_job(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append-only copy to Parquet, exactly once per row."""
    watch(stream.sparkSession)
    return (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**_trigger(every)).start())


def limit_job(stream: DataFrame, n: int, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The first n rows that arrive, over all micro-batches and restarts; later ones are read and left out.

    The checkpoint counts the rows that were let through. Every task sends at most n rows on.
    """
    return copy_job(stream.limit(n), path, checkpoint, every)


def console_job(stream: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
    watch(stream.sparkSession)
    return (stream.writeStream.format("console").option("truncate", "false")
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(**_trigger(every)).start())


CHANGE_STATE_DAYS = 30


def cdc_state(spark: SparkSession, path: str, schema, keys: list[str], seq: str = "seq", op: str = "op") -> DataFrame:
    """Current rows of a change-log state, without the keys whose last change is a delete."""
    return _change_state(spark, path, schema, keys, seq).current().where(F.col(op) != changelog.DELETE)


def _change_state(spark: SparkSession, path: str, schema, keys: list[str], seq: str) -> KeyedState:
    columns = ddl(spark.createDataFrame([], schema))
    return KeyedState(spark, path, columns, keys, [F.desc_nulls_last(seq)])


def cdc_job(changes: DataFrame, path: str, keys: list[str], changed_at: str, checkpoint: str, seq: str = "seq",
            op: str = "op", keep_days: int = CHANGE_STATE_DAYS, every: str | None = None) -> StreamingQuery:
    """Applies a stream of change rows to a keyed state, whatever the order they arrive in.

    The state keeps the last change of every key, deletes too: an image that arrives after a later change, or after the
    delete, is refused. A delete is forgotten `keep_days` after it happened, counted by the newest change of a batch,
    when a batch next rewrites its bucket; an older image that arrives later still would come back.
    """
    schema = changes.schema

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = zoneless(batch)
        newest = rows.agg(F.max(changed_at)).first()[0]
        if newest is None:
            return
        horizon = F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {keep_days} DAYS")
        keep = (F.col(op) != changelog.DELETE) | (F.col(changed_at) >= horizon)
        state = _change_state(batch.sparkSession, path, schema, keys, seq)
        state.merge(rows, "changes", batch_id, keep=keep)

    return start(changes, handle, checkpoint, every=every)


def dedup(readings: DataFrame, keys=("id",)) -> DataFrame:
    """Drops re-sent rows; state is kept only as long as the watermark allows a repeat to arrive."""
    return zoneless(with_event_time(readings).dropDuplicatesWithinWatermark(list(keys)))


def detail_job(readings: DataFrame, dim: Callable[[], DataFrame], path: str, checkpoint: str,
               profile=grading.MAIN, every: str | None = None) -> StreamingQuery:
    """Enriched detail rows; `dim` reads the device dimension for each micro-batch."""
    return start(readings, fan_out({path: lambda rows: detail.detail(rows, dim(), profile)}), checkpoint, every=every)


def window_partials(readings: DataFrame, width: str, profile=grading.MAIN, delay: str = WATERMARK,
                    measures=tuple(MEASURE_TYPES)) -> DataFrame:
    return rollup.partials(grading.grade(with_event_time(readings, delay), profile), width, measures=measures)


def window_job(readings: DataFrame, width: str, outputs: dict[str, Summary], checkpoint: str,
               profile=grading.MAIN, measures=tuple(MEASURE_TYPES), every: str | None = None) -> StreamingQuery:
    """Closed windows only, each written once.

    `outputs` maps a table path to a summary of partial rows, `measures` names those the
    summaries use: only these are kept as state.
    """
    return start(window_partials(readings, width, profile, WATERMARK, measures), fan_out(outputs), checkpoint,
                 "append", every)


def running_job(readings: DataFrame, width: str, path: str, checkpoint: str, profile=grading.MAIN,
                measures=tuple(MEASURE_TYPES), delay: str = "1 hour", every: str | None = None) -> StreamingQuery:
    """Continuously revised windows: the partial rows of devices that changed are written again.

    A micro-batch holds changed devices only, so nothing coarser may be made from it: summaries of devices,
    substations and customers are made from `running_partials`, the newest partial row of every device and window.
    `delay` plays the role of a state lifetime: a window leaves the state that long after its end.
    """
    return start(window_partials(readings, width, profile, delay, measures), fan_out({path: lambda rows: rows}),
                 checkpoint, "update", every)


def running_partials(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path, ["device_id", "window_start"])


def latest_job(readings: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Latest reading per device and micro-batch; the view over the log picks the newest, so no state is kept.

    A micro-batch is ranked as it comes: its source is read once.
    """
    def newest(rows: DataFrame) -> DataFrame:
        return serving.latest(rows, ["device_id"], [F.desc("reading_time"), F.desc("id")])

    return start(readings, fan_out({path: newest}), checkpoint, every=every)

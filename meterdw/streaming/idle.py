"""Running windows whose state has a lifetime since its last change, not since the end of the window.

A watermark lets a window go a fixed time after its end, however often it is still revised. Here every (device, window)
has a timer of its own: each reading that reaches it starts the timer again, and a window that nothing reaches for `idle`
leaves the state. Readings are never refused as late. One that comes after its window has left begins a new partial row;
rows carry the moment at which they began, and the reader adds up those of a window, so no count is lost.

This is the one streaming operator with Python code: timers need a function of the state. A call handles one window of a
hash bucket of devices, all of them at once in arrays: one call a device would cost more than the sums. The bucket's timer
is that of its device that is due first. Readings arrive as whole numbers (hundredths, thousandths), so sums are exact.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from meterdw.functions import grading
from meterdw.operators import incremental, rollup
from meterdw.schemas import MEASURE_TYPES
from meterdw.sinks.files import read_latest
from meterdw.streaming import jobs

KEY = ["bucket", "start_us", "end_us"]
BUCKETS = 32
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
NONE = -(1 << 62)  # stands for null inside the arrays


def _digits(measure: str) -> tuple[int, int]:
    precision, scale = re.findall(r"\d+", MEASURE_TYPES[measure])
    return int(precision), int(scale)


def _whole(readings: DataFrame, width: str, profile, measures) -> DataFrame:
    """Key of every reading, and one array: device, counters as 0 or 1, then measures as whole numbers."""
    rows = grading.grade(readings, profile).withColumn(
        "w", F.window(F.col("reading_time").cast("timestamp"), width))
    counters = [f"CAST(coalesce({condition}, false) AS BIGINT)" for condition in rollup.flags().values()]
    whole = [f"coalesce(CAST({m} * {10 ** _digits(m)[1]} AS BIGINT), {NONE})" for m in measures]
    device = f"coalesce(CAST(device_id AS BIGINT), {NONE})"
    return rows.where("reading_time IS NOT NULL").selectExpr(
        f"pmod(xxhash64(device_id), {BUCKETS}) AS bucket", "unix_micros(w.start) AS start_us",
        "unix_micros(w.end) AS end_us", f"array({', '.join([device, *counters, *whole])}) AS measured")


def _declared(rows: DataFrame, measures) -> DataFrame:
    """The arrays as partial rows of the types that a batch makes."""
    def scaled(at: int, name: str, precision: int, scale: int) -> str:
        unit = f"CAST({10 ** -scale:.{scale}f} AS DECIMAL({scale + 1},{scale}))"
        value = f"CAST(nullif(part[{at}], {NONE}) AS DECIMAL(20,0))"
        return f"CAST({value} * {unit} AS DECIMAL({precision},{scale})) AS {name}"

    counters, many = ["n", *rollup.flags()], len(measures)
    columns = [f"part[{at + 1}] AS {name}" for at, name in enumerate(counters)]
    for i, m in enumerate(measures):
        precision, scale = _digits(m)
        at = 1 + len(counters) + i
        columns += [scaled(at, f"{m}_sum", precision + 10, scale), f"part[{at + many}] AS {m}_cnt",
                    scaled(at + 2 * many, f"{m}_max", precision, scale),
                    scaled(at + 3 * many, f"{m}_min", precision, scale)]
    return rows.selectExpr(f"CAST(nullif(device_id, {NONE}) AS INT) AS device_id",
                           "timestamp_micros(start_us) AS window_start", "timestamp_micros(end_us) AS window_end",
                           "part[0] AS born_ms", *columns)


def idle_partials(readings: DataFrame, width: str, idle_ms: int, profile=grading.MAIN,
                  measures=tuple(MEASURE_TYPES)) -> DataFrame:
    """Stream of the partial rows that changed, whose state goes `idle_ms` after its last reading arrived.

    Null measures count nowhere but in `n`; readings without a time fall into no window; null devices are a key.
    """
    flags, many, none = len(rollup.flags()), len(measures), NONE
    # a device's row: its id; readings, counters, sums, counts of the measures; last touch, greatest; beginning, least
    added, most = 1, 2 + flags + 2 * many
    least = most + 1 + many
    width_of_row = least + 1 + many

    def rows_of(readings, now):
        """Every reading as the row that it would make alone; what is null adds nothing."""
        import numpy as np
        found = np.empty((len(readings), width_of_row), dtype=np.int64)
        measured = readings[:, 1 + flags:]
        given = measured != none
        found[:, 0], found[:, added], found[:, most], found[:, least] = readings[:, 0], 1, now, now
        found[:, added + 1:added + 1 + flags] = readings[:, 1:1 + flags]
        found[:, added + 1 + flags:most - many] = np.where(given, measured, 0)
        found[:, most - many:most] = given
        found[:, most + 1:least] = measured
        found[:, least + 1:] = np.where(given, measured, -none)
        return found

    def merged(rows):
        """Rows of one device become one."""
        import numpy as np
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        return np.hstack([rows[starts, :1], np.add.reduceat(rows[:, added:most], starts),
                          np.maximum.reduceat(rows[:, most:least], starts),
                          np.minimum.reduceat(rows[:, least:], starts)])

    def fold(key, pages, state):
        import numpy as np
        import pandas as pd
        now = state.getCurrentProcessingTimeMs()
        kept = np.frombuffer(state.get[0] if state.exists else b"", dtype="<i8").reshape(-1, width_of_row)
        if not state.hasTimedOut:
            for page in pages:
                kept = merged(np.vstack([kept, rows_of(np.stack(page["measured"].to_numpy()), now)]))
        touched = kept[:, most]
        changed, kept = kept[touched == now], kept[touched + idle_ms >= now]
        if len(kept):
            state.update((kept.astype("<i8").tobytes(),))
            state.setTimeoutDuration(max(1, int(kept[:, most].min()) + idle_ms - now))
        else:
            state.remove()
        if state.hasTimedOut:
            return
        empty = np.tile(changed[:, most - many:most] == 0, 3)
        sums, tops, lows = (slice(at, at + many) for at in (most - 2 * many, most + 1, least + 1))
        values = np.where(empty, none, np.hstack([changed[:, at] for at in (sums, tops, lows)]))
        part = np.hstack([changed[:, least:least + 1], changed[:, added:most - 2 * many], values[:, :many],
                          changed[:, most - many:most], values[:, many:]])
        yield pd.DataFrame({"device_id": changed[:, 0], "start_us": key[1],
                            "end_us": key[2], "part": list(part)})

    folded = _whole(readings, width, profile, measures).groupBy(*KEY).applyInPandasWithState(
        fold, "device_id bigint, start_us bigint, end_us bigint, part array<bigint>", "devices binary", "update",
        GroupStateTimeout.ProcessingTimeTimeout)
    return _declared(folded, measures)


def idle_job(readings: DataFrame, width: str, path: str, checkpoint: str, idle_ms: int = 3_600_000,
             profile=grading.MAIN, measures=tuple(MEASURE_TYPES), every: str | None = None) -> StreamingQuery:
    """Continuously revised windows with a lifetime since the last change, written as a log of batches.

    With an interval, timers also run out in micro-batches without rows. A query that drains its source would never
    end that way: there they run out in the next micro-batch with rows, which is when the state is next used.
    """
    session, parts = readings.sparkSession, idle_partials(readings, width, idle_ms, profile, measures)
    before = session.conf.get(EMPTY_BATCHES)
    session.conf.set(EMPTY_BATCHES, before if every else "false")
    try:  # a query keeps the settings that it was started with
        return jobs.start(parts, jobs.fan_out({path: lambda rows: rows}), checkpoint, "update", every)
    finally:
        session.conf.set(EMPTY_BATCHES, before)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """One partial row per device and window: the newest of every life that the window had, added up."""
    lives = read_latest(spark, path, ["device_id", "window_start", "born_ms"])
    return incremental.merged_parts(lives.drop("born_ms"), ["device_id", *rollup.WINDOW])

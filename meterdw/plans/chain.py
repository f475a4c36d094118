"""The layers as a chain: each takes over what changed in the one before since the version it last read.

Raw readings feed the detail layer, detail rows feed the hour partials and the latest states, partials feed the hour
summaries, those the overview. A layer commits its rows together with the versions that it has read, so a run that breaks
off anywhere goes on there, and no change counts twice. A change of a device, its substation or its owners revises the
past: the detail rows concerned leave and come again, and every layer behind follows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterdw import schemas
from meterdw.functions import grading
from meterdw.operators import detail, incremental, serving
from meterdw.operators.joins import listed
from meterdw.sinks.state import KeyedState
from meterdw.sinks.versions import VersionedTable, ddl
from meterdw.streaming import jobs
from meterdw.streaming.source import zoneless

READING = ["id", "reading_time"]
LAYERS_AT_ONCE = 4
# every run of the chain looks devices up anew; the driver holds several times the size of what it broadcasts
BROADCAST_LIMIT = 8 * 1024 * 1024


def _marks(keys: DataFrame, like: DataFrame) -> DataFrame:
    """Keys that changed, in the columns of a table; the others are empty."""
    return keys.select(*keys.columns, *[F.lit(None).alias(c) for c in like.columns if c not in keys.columns])


class Chain:
    """All layers below one root; `advance` brings each up to date with the one before."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        source = {name: spark.createDataFrame([], schemas.ddl(columns)) for name, columns in schemas.ODS.items()}
        readings = source["meter_reading"]
        dim = detail.owned_device_dim(source["device_info"], source["substation"], source["customer_device"],
                                      source["grid_customer"])
        rows = grading.grade(readings.join(dim, "device_id"), grading.MAIN).select(
            "id", *incremental.GROUP, "reading_time", *detail.MEASURES, *detail.GRADES)
        parts = incremental.hour_parts(rows)

        def table(name: str, frame: DataFrame, indexed: str | None) -> VersionedTable:
            return VersionedTable(spark, f"{root}/{name}", ddl(frame), indexed)

        self.ods = table("ods", readings, "reading_time")
        self.dim = table("dim", dim, None)
        self.dwd = table("dwd", rows, "reading_time")
        self.parts = table("dws_parts", parts, "window_start")
        self.hours = {name: table(name, s.make(parts), "stat_date") for name, s in incremental.SUMMARIES.items()}
        self.monitor = KeyedState(spark, f"{root}/ads_device_monitor", ddl(rows.drop(*incremental.OWNER)), ["device_id"],
                                  [F.desc("reading_time"), F.desc("id")])
        overview = serving.substation_overview(self.hours["dws_substation_hour"].frame([]))
        self.overview = table("ads_substation_overview", overview, None)

    # --- what comes in ---

    def deliver(self, readings: DataFrame, batch: int | None = None, writer: str = "") -> int:
        """New readings; a repeated batch changes nothing."""
        return self.ods.append(readings, writer, batch)

    def correct(self, readings: DataFrame) -> int:
        """Other measures for stored readings, one row each, found by id and time. Only files of their days are read."""
        days = [str(row.day) for row in readings.select(F.to_date("reading_time").alias("day")).distinct().collect()]
        old = self.ods.of_days(days)
        stored = self.ods.frame(old)
        fixed = readings.join(stored.select(READING), READING, "left_semi").select(stored.columns)
        gone = stored.join(readings.select(READING), READING, "left_semi").select(stored.columns)
        kept = stored.join(readings.select(READING), READING, "left_anti").select(stored.columns)
        return self.ods.replace(old, kept, fixed, gone)

    def set_dimension(self, dim: DataFrame) -> int:
        """The devices with substation and owners (`owned_device_dim`) as they are from now on, for past readings too."""
        now = self.dim.snapshot()
        old = list(now.files.values())
        stored = self.dim.frame(old)
        fresh = dim.select(stored.columns)
        marks = fresh.exceptAll(stored).unionByName(stored.exceptAll(fresh))
        if now.number and marks.isEmpty():
            return now.number
        return self.dim.replace(old, fresh, marks=marks)

    # --- layers ---

    @staticmethod
    def _reached(target: VersionedTable, source: VersionedTable, name: str) -> tuple[int, int]:
        return target.snapshot().consumed.get(name, 0), source.snapshot().number

    def _details(self, readings: DataFrame, dim_version: int) -> DataFrame:
        return detail.detail(readings, self.dim.read(dim_version), carry=("id",), limit_bytes=BROADCAST_LIMIT)

    def _days_of(self, changed: DataFrame, after: int, upto: int, read: int) -> list[str]:
        """Days on which the changed devices have readings. Devices known so far have them in the partials, so only
        devices that were unknown are sought in the readings themselves."""
        found = [self.parts.read().join(changed, "device_id", "left_semi").select("window_start")]
        if self.parts.snapshot().consumed.get("dwd", 0) < self.dwd.snapshot().number:
            found.append(self.dwd.read().join(changed, "device_id", "left_semi").select("reading_time"))
        known = self.dim.snapshot(after).files.values()
        fresh = (self.dim.read(upto).select("device_id").distinct()
                 .join(listed(self.dim.frame(known).select("device_id"), sum(one.rows for one in known)),
                       "device_id", "left_anti"))
        if read and not fresh.isEmpty():
            fresh = listed(fresh, sum(self.dim.changed_rows(after, upto)))
            found.append(self.ods.read(read).join(fresh, "device_id", "left_semi").select("reading_time"))
        return sorted({str(row.day) for frame in found for row in frame.select(
            F.to_date(frame.columns[0]).alias("day")).distinct().collect()})

    def _revise(self) -> None:
        """Detail rows of devices whose dimension rows changed are made again, on the days that have any."""
        after, upto = self._reached(self.dwd, self.dim, "dim")
        if after == upto:
            return
        read = self.dwd.snapshot().consumed.get("ods", 0)
        changed = listed(self.dim.changes(after, upto).select("device_id").distinct(),
                         sum(self.dim.changed_rows(after, upto)))
        days = self._days_of(changed, after, upto, read) if read else []
        old = self.dwd.of_days(days)
        stored = self.dwd.frame(old)
        readings = self.ods.frame(self.ods.of_days(days, read) if read else [])
        came = self._details(readings.join(changed, "device_id", "left_semi"), upto).select(stored.columns)
        went = stored.join(changed, "device_id", "left_semi").select(stored.columns)
        kept = stored.join(changed, "device_id", "left_anti").select(stored.columns)
        self.dwd.replace(old, kept, came, went, kind="revise", consumed={"dim": upto})

    def advance_detail(self) -> None:
        self._revise()
        after, upto = self._reached(self.dwd, self.ods, "ods")
        if after == upto:
            return
        dim = self.dwd.snapshot().consumed.get("dim", 0)
        changes = self.ods.changes(after, upto)
        came, went = (changes.where(f"_sign = {sign}").drop("_sign") for sign in (1, -1))
        lost = self.ods.changed_days(after, upto)[1]
        if not lost:
            self.dwd.append(self._details(came, dim), consumed={"ods": upto})
            return
        old = self.dwd.of_days(lost)
        stored = self.dwd.frame(old)
        keys = listed(went.select(READING), self.ods.changed_rows(after, upto)[1])
        gone = stored.join(keys, READING, "left_semi").select(stored.columns)
        kept = stored.join(keys, READING, "left_anti").select(stored.columns)
        # a reading that came and went again since the last run leaves no detail row
        fresh = self._details(came.exceptAll(went), dim).select(stored.columns)
        self.dwd.replace(old, kept, fresh, gone, consumed={"ods": upto})

    def advance_parts(self) -> None:
        after, upto = self._reached(self.parts, self.dwd, "dwd")
        if after == upto:
            return
        gained, lost = self.dwd.changed_days(after, upto)
        days = {*gained, *lost}
        changes = self.dwd.changes(after, upto)
        came, went = (changes.where(f"_sign = {sign}").drop("_sign") for sign in (1, -1))
        old = self.parts.of_days(days)
        stored = self.parts.frame(old)
        if lost:
            merged = incremental.parts_recomputed(stored, came, went, self.dwd.frame(self.dwd.of_days(days, upto)),
                                                  self.dwd.changed_rows(after, upto)[1])
        else:
            merged = incremental.parts_after(stored, came)
        groups = incremental.with_hour(changes).select(incremental.PART).distinct()
        self.parts.replace(old, merged, marks=_marks(groups, stored), consumed={"dwd": upto})

    def advance_hours(self, name: str) -> None:
        target, summary = self.hours[name], incremental.SUMMARIES[name]
        after, upto = self._reached(target, self.parts, "parts")
        if after == upto:
            return
        days = self.parts.changed_days(after, upto)[0]
        keys = incremental.touched(self.parts.changes(after, upto), summary.key)
        sought = listed(keys, sum(self.parts.changed_rows(after, upto)))
        old = target.of_days(days)
        stored = target.frame(old)
        made = incremental.summary_of(self.parts.frame(self.parts.of_days(days, upto)), sought, summary)
        names = [summary.key, "stat_date", "stat_hour"]
        kept = stored.join(sought, names, "left_anti").select(stored.columns)
        target.replace(old, kept.unionByName(made), marks=_marks(keys, stored), consumed={"parts": upto})

    def advance_monitor(self) -> None:
        """The newest detail row of every device; devices that lost rows are looked up in the detail layer."""
        after, upto = self._reached(self.monitor, self.dwd, "dwd")
        if after == upto:
            return
        changes = self.dwd.changes(after, upto)
        rows, lost = changes.where("_sign = 1").drop("_sign", *incremental.OWNER), None
        if self.dwd.changed_days(after, upto)[1]:
            lost = listed(changes.where("_sign = -1").select("device_id").distinct(),
                          self.dwd.changed_rows(after, upto)[1])
            again = self.dwd.read(upto).drop(*incremental.OWNER).join(lost, "device_id", "left_semi")
            rows = rows.join(lost, "device_id", "left_anti").unionByName(again)
        self.monitor.merge(rows, consumed={"dwd": upto}, instead=lost)

    def advance_overview(self) -> None:
        """The newest hour of every substation that changed; the others keep their row."""
        hours = self.hours["dws_substation_hour"]
        after, upto = self._reached(self.overview, hours, "hours")
        if after == upto:
            return
        changed = hours.changes(after, upto).select("substation_id").distinct()
        old = list(self.overview.snapshot().files.values())
        stored = self.overview.frame(old)
        made = serving.substation_overview(hours.read(upto).join(changed, "substation_id", "left_semi"))
        kept = stored.join(changed, "substation_id", "left_anti").select(stored.columns)
        self.overview.replace(old, kept.unionByName(made), consumed={"hours": upto})

    def advance(self, hours: Iterable[str] | None = None, states: bool = True) -> None:
        """Brings all layers up to date, or only some of the hour summaries and no latest states.

        Layers that do not rest on each other run side by side.
        """
        hours = tuple(self.hours) if hours is None else tuple(hours)
        self.advance_detail()
        with ThreadPoolExecutor(LAYERS_AT_ONCE) as pool:
            waits = [pool.submit(self.advance_monitor)] if states else []
            if hours:
                self.advance_parts()
            waits += [pool.submit(self.advance_hours, name) for name in hours]
        for wait in waits:
            wait.result()
        if states:
            self.advance_overview()

    def compact(self) -> None:
        for table in (self.ods, self.dwd, self.parts, *self.hours.values()):
            table.compact()

    def expire(self, since: str) -> None:
        """Drops readings and detail rows before a time, by whole files where possible; summaries made of them stay."""
        for table in (self.ods, self.dwd):
            table.expire(since)

    def vacuum(self, grace_s: float = 86400) -> None:
        """Removes files that neither the newest version of a layer nor the layer behind it needs."""
        followers = {"ods": [self.dwd], "dim": [self.dwd], "dwd": [self.parts, self.monitor],
                     "parts": list(self.hours.values()), "hours": [self.overview]}
        tables = {"ods": self.ods, "dim": self.dim, "dwd": self.dwd, "parts": self.parts,
                  "hours": self.hours["dws_substation_hour"]}
        for name, table in tables.items():
            read = min(f.snapshot().consumed.get(name, 0) for f in followers[name])
            if read:
                table.vacuum(read, grace_s)
        for table in (self.monitor, self.overview, self.hours["dws_device_hour"], self.hours["dws_customer_hour"]):
            if table.numbers():
                table.vacuum(table.snapshot().number, grace_s)

    def flow(self, since: str) -> DataFrame:
        """Per layer: rows, rows in files with times from `since` on at most, newest time; from the records alone."""
        found = []
        for name, table in {"ods": self.ods, "dwd": self.dwd, **self.hours}.items():
            files = table.snapshot().files.values()
            found.append((name, sum(f.rows for f in files), sum(f.rows for f in files if f.may_hold(since, None)),
                          max((f.high for f in files if f.high), default=None)))
        return self.spark.createDataFrame(found, "layer string, row_count bigint, fresh_rows_at_most bigint, "
                                                 "last_time string")

    # --- what is served ---

    def device_monitor(self) -> DataFrame:
        return self.monitor.current().select(*detail.monitor_columns(grading.graded_status()))


def chain_job(readings: DataFrame, root: str, checkpoint: str, dimension: Callable[[], DataFrame],
              every: str | None = None, **layers) -> StreamingQuery:
    """Feeds a stream of readings through the chain. `dimension` is read anew for every micro-batch; a change of it
    revises the past. A micro-batch that runs again finds its readings stored and goes on with the layers behind."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        chain = Chain(batch.sparkSession, root)
        chain.set_dimension(dimension())
        chain.deliver(zoneless(batch), batch_id, "readings")
        chain.advance(**layers)

    return jobs.start(readings, handle, checkpoint, every=every)

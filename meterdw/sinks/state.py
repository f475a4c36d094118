"""Keyed state in hash buckets: a batch rewrites the buckets of its keys and no others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw.operators.serving import latest
from meterdw.sinks.versions import DataFile, Record, Snapshot, VersionedTable

BUCKETS = 64


class KeyedState(VersionedTable):
    """The newest row of every key. The bucket of a row is its indexed value, as a text of four digits."""

    def __init__(self, spark: SparkSession, path: str, columns: str, keys: list[str], newest: list[Column],
                 buckets: int = BUCKETS):
        super().__init__(spark, path, f"{columns}, bucket string", "bucket", layout="{}")
        self.keys = keys
        self.order = newest
        self.buckets = buckets

    def bucketed(self, rows: DataFrame) -> DataFrame:
        number = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        return rows.withColumn("bucket", F.lpad(number.cast("string"), 4, "0"))

    def of_buckets(self, wanted: set[str], now: Snapshot) -> list[DataFile]:
        return [one for one in now.files.values() if one.low in wanted]

    def merge(self, rows: DataFrame, writer: str = "", batch: int | None = None, consumed: dict[str, int] | None = None,
              instead: DataFrame | None = None, keep: Column | None = None) -> int:
        """Puts the newer of the stored and the given row of every key into the state.

        Keys of `instead` lose their stored row first. `keep` drops merged rows for which it is false. At most
        `buckets` names reach the driver. A batch that its writer has committed before changes nothing; a bucket that
        another writer changes meanwhile is a `Conflict`.
        """
        now = self.snapshot()
        if batch is not None and now.batches.get(writer, -1) >= batch:
            return now.number
        fresh = self.bucketed(latest(rows, self.keys, self.order))
        names = fresh.select("bucket")
        if instead is not None:
            names = names.unionByName(self.bucketed(instead).select("bucket"))
        wanted = {row.bucket for row in names.distinct().collect()}
        old = self.of_buckets(wanted, now)
        stored = self.frame(old)
        if instead is not None:
            stored = stored.join(instead.select(*self.keys).distinct(), self.keys, "left_anti")
        merged = latest(stored.unionByName(fresh.select(stored.columns)), self.keys, self.order)
        added = self.store(merged if keep is None else merged.where(keep))
        return self.commit(lambda _: Record("merge", added, [one.path for one in old],
                                            batches={} if batch is None else {writer: batch}, consumed=consumed or {}))

    def current(self, version: int | None = None) -> DataFrame:
        return self.read(version).drop("bucket")

"""Buffered JDBC writes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Flush:
    """Rows per JDBC batch, and the trigger interval that stands for a time-based flush."""

    rows: int
    interval: str


# fixed values: flush settings per served table
FLUSH = {
    "device_realtime_monitor": Flush(100, "1 second"),
    "device_hour_summary": Flush(100, "1 second"),
    "substation_overview": Flush(100, "1 second"),
    "generated_device_monitor": Flush(50, "2 seconds"),
    "device_window_summary": Flush(20, "3 seconds"),
    "substation_summary": Flush(10, "3 seconds"),
    "quick_monitor": Flush(10, "2 seconds"),
}


def write_options(url: str, table: str, flush: Flush, connections: int = 8, **extra: str) -> dict[str, str]:
    """Writer options; `connections` bounds how many tasks write at once."""
    return {"url": url, "dbtable": table, "batchsize": str(flush.rows), "numPartitions": str(connections), **extra}


def append(df: DataFrame, url: str, table: str, flush: Flush, **extra: str) -> None:
    df.write.format("jdbc").mode("append").options(**write_options(url, table, flush, **extra)).save()


def refresh(df: DataFrame, url: str, table: str, flush: Flush, **extra: str) -> None:
    """Full refresh that keeps the table definition: truncate, then insert."""
    options = write_options(url, table, flush, **extra) | {"truncate": "true"}
    df.write.format("jdbc").mode("overwrite").options(**options).save()


def batch_sink(url: str, table: str, flush: Flush, **extra: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function; pair it with a trigger of `flush.interval`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, url, table, flush, **extra)
    return write

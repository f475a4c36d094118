"""Hour summaries kept up to date by the rows that came and went.

Partial rows per (device, owner, hour) are stored by date. New readings are summed into partial rows of their own, which
merge with the stored ones: sums and counts add up, extremes compare. Where a reading went (it was corrected, or its device
got another name or owner), the group's rows are aggregated anew from the detail of that date. Coarser summaries are
derived again for the (key, hour) pairs whose partial rows changed, everything else is carried over.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterdw.operators import rollup
from meterdw.operators.detail import DEVICE
from meterdw.operators.joins import listed
from meterdw.schemas import MEASURE_TYPES

OWNER = ["customer_id", "customer_name"]
STATION = ["substation_id", "substation_name"]
GROUP = [*DEVICE, *STATION, *OWNER]
PART = [*GROUP, *rollup.WINDOW]


def hour_parts(detail_rows: DataFrame) -> DataFrame:
    """Partial rows per device, owner and hour of graded detail rows."""
    return rollup.partials(detail_rows, "1 hour", keys=GROUP)


def merged_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Partial rows with equal keys become one."""
    aggs = [f"SUM({c}) AS {c}" if rollup.is_additive(c) else f"{c[-3:]}({c}) AS {c}"
            for c in parts.columns if c not in PART]
    return parts.groupBy(*keys).agg(*map(F.expr, aggs))


def with_hour(detail_rows: DataFrame) -> DataFrame:
    """Detail rows with the window that they fall into."""
    rows = detail_rows.withColumn("_hour", F.window("reading_time", "1 hour"))
    return rows.select("*", "_hour.start", "_hour.end").drop("_hour").withColumnsRenamed(
        {"start": "window_start", "end": "window_end"})


def single_parts(detail_rows: DataFrame, like: DataFrame) -> DataFrame:
    """Every detail row as the partial row that it would make alone, in the columns of `like`: one shuffle merges both."""
    values = {"n": "1", **{name: f"IF({condition}, 1, 0)" for name, condition in rollup.flags().items()}}
    for m in MEASURE_TYPES:
        values |= {f"{m}_sum": m, f"{m}_cnt": f"IF({m} IS NULL, 0, 1)", f"{m}_max": m, f"{m}_min": m}
    return with_hour(detail_rows).select(
        *[F.expr(values.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in like.schema])


def parts_after(stored: DataFrame, came: DataFrame) -> DataFrame:
    """Stored partial rows with those of new detail rows."""
    return merged_parts(stored.unionByName(single_parts(came, stored)), PART)


def parts_recomputed(stored: DataFrame, came: DataFrame, went: DataFrame, fact: DataFrame,
                     went_rows: int) -> DataFrame:
    """As `parts_after`, with the groups that lost rows aggregated anew from `fact`, the detail rows as they are now.
    `went_rows` is the number of rows that went."""
    keys = [*GROUP, "window_start"]
    broken = listed(with_hour(went).select([F.col(c).alias(f"_{c}") for c in keys]).distinct(), went_rows)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])

    def split(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(broken, same, how)

    # a group is either broken or not, so one aggregation serves both
    rows = split(with_hour(came), "left_anti").unionByName(split(with_hour(fact), "left_semi")).drop(*rollup.WINDOW)
    return parts_after(split(stored, "left_anti"), rows)


@dataclass(frozen=True)
class Summary:
    """A coarser table: its key, and how its rows are made of partial rows per device, owner and hour."""

    key: str
    make: Callable[[DataFrame], DataFrame]


def _device_parts(parts: DataFrame) -> DataFrame:
    """One partial row per device and hour; a reading counts once an owner, as in the detail rows."""
    return merged_parts(parts, [*DEVICE, *STATION, *rollup.WINDOW])


SUMMARIES = {
    "dws_device_hour": Summary("device_id", lambda parts: rollup.device_hour(_device_parts(parts))),
    "dws_substation_hour": Summary("substation_id", lambda parts: rollup.substation_hour(_device_parts(parts))),
    "dws_customer_hour": Summary("customer_id", lambda parts: rollup.customer_hour(
        merged_parts(parts.where("customer_id > 0"), ["device_id", *OWNER, *rollup.WINDOW]))),
}


def touched(changes: DataFrame, key: str) -> DataFrame:
    """The (key, date, hour) of changed partial rows."""
    return changes.selectExpr(key, *rollup.CALENDAR).distinct()


def summary_of(parts: DataFrame, keys: DataFrame, summary: Summary) -> DataFrame:
    """Summary rows of the touched keys, made of the stored partial rows."""
    columns = [summary.key, "stat_date", "stat_hour"]
    rows = parts.selectExpr("*", *rollup.CALENDAR).join(keys, columns, "left_semi").drop("stat_date", "stat_hour")
    return summary.make(rows)

"""Event-time stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw import schemas
from meterdw.sources.tables import EVENTS, readings_from

WATERMARK = "5 seconds"


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream over the Parquet files below a path; `max_files` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def reading_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Meter readings from the event table of a data folder, without watermark.

    The path is written as a pattern because a stream takes a plain path for a folder;
    this way the table may be one file or a folder of files.
    """
    return readings_from(file_stream(spark, f"{folder.rstrip('/')}/event[s].parquet", EVENTS, max_files))


def stored_stream(spark: SparkSession, folder: str, table: str, max_files: int | None = None) -> DataFrame:
    """Stream over the rows that arrive in a stored source table (Parquet at `<folder>/<table>`), declared columns only."""
    return file_stream(spark, f"{folder.rstrip('/')}/{table}", schemas.ddl(schemas.ODS[table]), max_files)


def with_event_time(readings: DataFrame, delay: str = WATERMARK, column: str = "reading_time") -> DataFrame:
    """Zoned event time plus watermark; the session must be in UTC (see session.utc_session)."""
    return readings.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def zoneless(df: DataFrame) -> DataFrame:
    """Zoned columns back to the declared zone-less type, at the output edge."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

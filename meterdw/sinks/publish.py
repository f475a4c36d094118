"""Batches that become visible once and whole, in targets that only take inserts.

A database table written by many tasks is not one transaction: a task that is tried again, or a batch that is replayed
after a failure, inserts rows a second time. Here a target is two tables. `<table>_rows` takes the rows with the id of
their batch and of the attempt that wrote them; `<table>_marks` takes one row when an attempt has written all of them.
Readers see the rows of the first marked attempt of every batch: `visible` as a frame, `visible_sql` as the text of a view.
A replayed batch is a no-op once marked; rows of attempts that failed are never seen and `leftovers_sql` deletes them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw.sinks.jdbc import Flush, append

MARKS = "writer string, batch_id bigint, attempt string, whole boolean"
TAGS = ["writer", "batch_id", "attempt"]


class Target(Protocol):
    def append(self, rows: DataFrame, table: str) -> None: ...

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame: ...


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database; both must exist, or the writer's user must be allowed to make them."""

    url: str
    flush: Flush
    options: dict[str, str] = field(default_factory=dict)

    def append(self, rows: DataFrame, table: str) -> None:
        append(rows, self.url, table, self.flush, **self.options)

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, dbtable=table, **self.options).load()


@dataclass(frozen=True)
class FolderTarget:
    """Parquet folders below a root; a table without a folder is empty."""

    root: str

    def append(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("append").parquet(f"{self.root}/{table}")

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)


def _first_marks(table: str) -> str:
    return (f"(SELECT writer, batch_id, MIN(attempt) AS attempt FROM {table}_marks "
            "GROUP BY writer, batch_id)")


@dataclass(frozen=True)
class Published:
    """One served table. With `keys`, the row of the last batch counts (a batch holds a key once); ties between writers go
    to the one last by name. `columns` are the declared ones; batches must have them all, others are not written.
    """

    target: Target
    table: str
    columns: dict[str, str]
    keys: tuple[str, ...] = ()

    def marks(self, spark: SparkSession) -> DataFrame:
        return self.target.read(spark, f"{self.table}_marks", MARKS)

    def is_marked(self, spark: SparkSession, batch_id: int, writer: str = "") -> bool:
        known = (F.col("writer") == writer) & (F.col("batch_id") == batch_id)
        return not self.marks(spark).where(known).isEmpty()

    def publish(self, rows: DataFrame, batch_id: int, writer: str = "", whole: bool = False) -> bool:
        """Writes a batch and marks it; False if it was marked before. A `whole` batch replaces all earlier ones of its
        writer. An empty batch is marked too.
        """
        spark = rows.sparkSession
        if self.is_marked(spark, batch_id, writer):
            return False
        attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        declared = rows.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in self.columns.items()])
        self.target.append(declared.withColumns({
            "writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)}),
            f"{self.table}_rows")
        self.target.append(spark.createDataFrame([(writer, batch_id, attempt, whole)], MARKS).coalesce(1),
                           f"{self.table}_marks")
        return True

    def handler(self, writer: str = "", whole: bool = False) -> Callable[[DataFrame, int], None]:
        """A foreachBatch function; a query and its checkpoint are one writer."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.publish(batch, batch_id, writer, whole)
        return write

    def visible_sql(self) -> str:
        """The visible rows as SQL over the two tables, in terms that any database knows."""
        names = ", ".join(f"r.{name}" for name in self.columns)
        rows = (f"SELECT {names}, r.writer, r.batch_id FROM {self.table}_rows r "
                f"JOIN {_first_marks(self.table)} m "
                "ON r.writer = m.writer AND r.batch_id = m.batch_id AND r.attempt = m.attempt "
                f"LEFT JOIN (SELECT writer, MAX(batch_id) AS least FROM {self.table}_marks WHERE whole GROUP BY writer) w "
                "ON r.writer = w.writer WHERE w.least IS NULL OR r.batch_id >= w.least")
        plain = ", ".join(self.columns)
        if not self.keys:
            return f"SELECT {plain} FROM ({rows}) v"
        order = f"PARTITION BY {', '.join(self.keys)} ORDER BY batch_id DESC, writer DESC"
        return (f"SELECT {plain} FROM (SELECT v.*, ROW_NUMBER() OVER ({order}) AS place FROM ({rows}) v) p "
                "WHERE place = 1")

    def leftovers_sql(self) -> str:
        """Deletes rows of attempts that are not seen. Run it while nothing writes: an attempt under way has no mark yet."""
        return (f"DELETE FROM {self.table}_rows WHERE NOT EXISTS (SELECT 1 FROM {_first_marks(self.table)} m "
                f"WHERE m.writer = {self.table}_rows.writer AND m.batch_id = {self.table}_rows.batch_id "
                f"AND m.attempt = {self.table}_rows.attempt)")

    def visible(self, spark: SparkSession) -> DataFrame:
        """The rows that readers see. The same statement as the view, over the target's tables."""
        tags = {"writer": "string", "batch_id": "bigint", "attempt": "string"}
        schema = ", ".join(f"{name} {kind}" for name, kind in (self.columns | tags).items())
        view = f"_{self.table}_{uuid.uuid4().hex}"
        text = self.visible_sql()
        for part, declared in (("rows", schema), ("marks", MARKS)):
            self.target.read(spark, f"{self.table}_{part}", declared).createOrReplaceTempView(f"{view}_{part}")
            text = text.replace(f"{self.table}_{part}", f"{view}_{part}")
        found = spark.sql(text)
        for part in ("rows", "marks"):
            spark.catalog.dropTempView(f"{view}_{part}")
        return found

"""Tables kept as numbered versions: lists of Parquet files, each committed by one small record.

A record names the files that a version adds and removes, and the rows that came and went by it. Records are put in place
by a rename that fails if the number is taken; the writer then looks again and tries the next number. So an appending
job, a compaction and a retention run can work on a table at the same time, and a reader that holds a version number sees
the same rows until `vacuum` is told that nobody needs it any more. The list of files, with the least and greatest time of
each, is held by the driver, as Spark's own file listing would be; reads open only files that can hold the wanted times.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw.operators.serving import latest

# every so many versions a record lists all files, so that a reader opens few records
WHOLE_EVERY = 16
ATTEMPTS = 50
RECORD = re.compile(r"(\d{12})\.json$")


def ddl(df: DataFrame) -> str:
    """The columns of a frame, as a table's schema."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


class Conflict(RuntimeError):
    """Files that a change rests on are no longer part of the table."""


@dataclass(frozen=True)
class DataFile:
    """Path below the table, rows, and the least and greatest indexed value as text (None without any)."""

    path: str
    rows: int
    low: str | None = None
    high: str | None = None
    nulls: int = 0

    @property
    def part(self) -> str:
        """The part of the layout that the file belongs to."""
        folder = self.path.rsplit("/", 2)[-2]
        return folder if folder.startswith("_part=") else ""

    def may_hold(self, since: str | None, until: str | None) -> bool:
        """Whether a row with since <= value <= until can be in the file."""
        if since is None and until is None:
            return True
        return (self.low is not None and (since is None or self.high >= since)
                and (until is None or self.low <= until))


@dataclass
class Record:
    kind: str
    added: list[DataFile] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    # rows that came and that went, for those who follow the table; a compaction changes no rows
    plus: list[DataFile] = field(default_factory=list)
    minus: list[DataFile] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    consumed: dict[str, int] = field(default_factory=dict)
    whole: bool = False

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def parse(cls, text: str) -> "Record":
        found = cls(**json.loads(text))
        for name in ("added", "plus", "minus"):
            setattr(found, name, [DataFile(**one) for one in getattr(found, name)])
        return found


@dataclass
class Snapshot:
    """A version: its files, the last batch of every writer, and how far it has read other tables."""

    number: int = 0
    files: dict[str, DataFile] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    consumed: dict[str, int] = field(default_factory=dict)


class Folder:
    """The few file operations needed, on any file system that Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return [one.getPath().getName() for one in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Writes a file that must not be there yet; False if it is. Readers see all of it or nothing."""
        draft = f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._at(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self.conf)
        no_options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(self._at(draft)), context.makeQualified(self._at(name)), no_options)
        except Py4JJavaError:
            self.fs.delete(self._at(draft), False)
            if not self.fs.exists(self._at(name)):
                raise
            return False
        return True

    def files_below(self, name: str) -> list[tuple[str, float]]:
        """(path, time of last change in seconds) of all files at any depth."""
        if not self.fs.exists(self._at(name)):
            return []
        found, walk = [], self.fs.listFiles(self._at(name), True)
        base = self.fs.makeQualified(self._at("")).toString().rstrip("/") + "/"
        while walk.hasNext():
            one = walk.next()
            found.append((one.getPath().toString().removeprefix(base), one.getModificationTime() / 1000))
        return found

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), False)

    def relative(self, uri: str) -> str:
        """A file path as Spark reports it, below this folder."""
        base = self.fs.makeQualified(self._at("")).toString().rstrip("/") + "/"
        path = self.fs.makeQualified(self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(uri))).toString()
        return path.removeprefix(base)


class VersionedTable:
    """A table at `path` with the columns of `schema` (DDL); `indexed` names the column of the file index.

    Files hold rows of one value of `layout`: the day of the indexed time, unless told otherwise. Indexed values are
    compared as text, so they are times, dates or texts.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, indexed: str | None = None,
                 layout: str = "to_date({})"):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.indexed = indexed
        self.layout = layout.format(indexed)
        self.fields = spark.createDataFrame([], schema).schema.fields
        self.folder = Folder(spark, self.path)
        self.records: dict[int, Record] = {}

    # --- versions ---

    def numbers(self) -> list[int]:
        return sorted(int(m[1]) for name in self.folder.names("log") if (m := RECORD.match(name)))

    def record(self, number: int) -> Record:
        """A record; the last ones read are remembered, since a record never changes."""
        if number not in self.records:
            while len(self.records) >= 2 * WHOLE_EVERY:
                self.records.pop(next(iter(self.records)), None)
            self.records[number] = Record.parse(self.folder.read(f"log/{number:012d}.json"))
        return self.records[number]

    def snapshot(self, version: int | None = None) -> Snapshot:
        known = self.numbers()
        if version is None:
            version = known[-1] if known else 0
        elif version and version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        records = []
        for number in reversed([n for n in known if n <= version]):
            records.append(self.record(number))
            if records[-1].whole:
                break
        found = Snapshot(version)
        for record in reversed(records):
            if record.whole:
                found.files = {}
            for path in record.removed:
                found.files.pop(path, None)
            found.files |= {one.path: one for one in record.added}
            found.batches, found.consumed = record.batches, record.consumed
        return found

    def commit(self, build: Callable[[Snapshot], Record | None]) -> int:
        """Puts the record that `build` makes of the newest version. Returns the version that then holds; none is made
        if `build` returns None. `build` is called again if another writer was faster."""
        for attempt in range(ATTEMPTS):
            now = self.snapshot()
            record = build(now)
            if record is None:
                return now.number
            gone = [path for path in record.removed if path not in now.files]
            if gone:
                raise Conflict(f"{len(gone)} files, {gone[0]} among them, left {self.path} meanwhile")
            record.batches = now.batches | record.batches
            record.consumed = now.consumed | record.consumed
            number = now.number + 1
            if number % WHOLE_EVERY == 0:
                left = {path: one for path, one in now.files.items() if path not in set(record.removed)}
                # what came by this version stays readable for those who follow the table
                record = Record(record.kind, [*left.values(), *record.added], [], record.plus, record.minus,
                                record.batches, record.consumed, True)
            if self.folder.put(f"log/{number:012d}.json", record.text()):
                return number
            time.sleep(0.01 * attempt)
        raise Conflict(f"{ATTEMPTS} attempts to commit to {self.path} failed")

    # --- rows ---

    def frame(self, files: Iterable[DataFile]) -> DataFrame:
        paths = sorted(f"{self.path}/{one.path}" for one in files)
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def store(self, rows: DataFrame) -> list[DataFile]:
        """Writes rows to new files, a few a part of the layout, and notes each file's bounds; nothing refers to them yet."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.fields])
        bounds = [F.count("*").alias("rows")]
        if self.indexed:
            rows = rows.withColumn("_part", F.expr(self.layout)).hint("rebalance", "_part")
            bounds += [F.min(self.indexed).cast("string").alias("low"), F.max(self.indexed).cast("string").alias("high"),
                       F.count_if(F.col(self.indexed).isNull()).alias("nulls")]
        rows.write.partitionBy(*["_part"] * bool(self.indexed)).parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        found = written.groupBy(F.col("_metadata.file_path").alias("path")).agg(*bounds).collect()
        return [DataFile(self.folder.relative(row.path), *row[1:]) for row in found]

    def matching(self, version: int | None = None, since: str | None = None, until: str | None = None) -> list[DataFile]:
        """Files of a version that can hold rows from `since` to `until` (both inclusive, as text)."""
        return [one for one in self.snapshot(version).files.values() if one.may_hold(since, until)]

    def read(self, version: int | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
        """Rows of a version, the newest by default, with indexed values from `since` to `until`."""
        rows = self.frame(self.matching(version, since, until))
        if since is not None:
            rows = rows.where(F.col(self.indexed) >= F.lit(since).cast(rows.schema[self.indexed].dataType))
        if until is not None:
            rows = rows.where(F.col(self.indexed) <= F.lit(until).cast(rows.schema[self.indexed].dataType))
        return rows

    def newest(self, version: int | None = None) -> str | None:
        """The greatest indexed value, from the records alone."""
        return max((one.high for one in self.snapshot(version).files.values() if one.high is not None), default=None)

    def changes(self, after: int, upto: int | None = None) -> DataFrame:
        """Rows that came (`_sign` 1) and went (-1) by the versions after one and up to another."""
        upto = self.snapshot().number if upto is None else upto
        known = self.numbers()
        missing = [n for n in range(after + 1, upto + 1) if n not in known]
        if missing:
            raise ValueError(f"versions {missing[0]} to {missing[-1]} of {self.path} are gone")
        records = [self.record(n) for n in range(after + 1, upto + 1)]
        signed = [self.frame(one for r in records for one in files(r)).withColumn("_sign", F.lit(sign))
                  for sign, files in ((1, lambda r: r.plus), (-1, lambda r: r.minus)) if any(map(files, records))]
        if not signed:
            return self.spark.createDataFrame([], self.schema).withColumn("_sign", F.lit(1))
        return signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])

    # --- changes ---

    def changed_days(self, after: int, upto: int) -> tuple[list[str], list[str]]:
        """Days (texts of ten characters) of the rows that came, and of those that went, from the records alone."""
        records = [self.record(n) for n in range(after + 1, upto + 1)]
        return tuple(sorted({day[:10] for r in records for one in files(r) for day in (one.low, one.high) if day})
                     for files in (lambda r: r.plus, lambda r: r.minus))

    def changed_rows(self, after: int, upto: int) -> tuple[int, int]:
        """How many rows came, marks among them, and how many went, from the records alone."""
        records = [self.record(n) for n in range(after + 1, upto + 1)]
        return tuple(sum(one.rows for r in records for one in files(r)) for files in (lambda r: r.plus, lambda r: r.minus))

    def of_days(self, days: Iterable[str], version: int | None = None) -> list[DataFile]:
        """Files with rows of the given days."""
        wanted = set(days)
        return [one for one in self.snapshot(version).files.values() if one.low and {one.low[:10], one.high[:10]} & wanted]

    def append(self, rows: DataFrame, writer: str = "", batch: int | None = None,
               consumed: dict[str, int] | None = None) -> int:
        """Adds rows. A batch that its writer has committed before, or an earlier one, changes nothing."""
        def known(now: Snapshot) -> bool:
            return batch is not None and now.batches.get(writer, -1) >= batch

        now = self.snapshot()
        if known(now):
            return now.number
        added = self.store(rows)
        return self.commit(lambda now: None if known(now) else Record(
            "append", added, plus=added, batches={} if batch is None else {writer: batch}, consumed=consumed or {}))

    def replace(self, old: Iterable[DataFile], kept: DataFrame, came: DataFrame | None = None,
                went: DataFrame | None = None, marks: DataFrame | None = None, kind: str = "replace",
                consumed: dict[str, int] | None = None) -> int:
        """Puts the rows of `kept` and `came` in the place of files.

        Followers hear of the rows that `came` and `went`, and of `marks`: rows that are not part of the table and only
        say which keys changed. Fails with `Conflict` if one of the files has left the table since it was read.
        """
        removed = [one.path for one in old]
        stored, plus, minus, told = ([] if part is None else self.store(part) for part in (kept, came, went, marks))
        return self.commit(lambda now: Record(kind, stored + plus, removed, plus + told, minus, consumed=consumed or {}))

    def expire(self, since: str) -> dict[str, int]:
        """Drops rows with indexed values before `since`; rows without a value stay.

        Files that hold older rows only leave the list unread; only files across the boundary are read and written again.
        Returns how many files were dropped and how many rewritten.
        """
        files = self.snapshot().files.values()
        old = [one for one in files if one.low is not None and one.low < since]
        across = [one for one in old if one.high >= since or one.nulls]
        dropped = [one for one in old if one not in across]
        if old:
            value = F.col(self.indexed)
            rows = self.frame(across)
            kept = rows.where(value.isNull() | (value >= F.lit(since).cast(rows.schema[self.indexed].dataType)))
            added = self.store(kept) if across else []
            # followers do not hear of expired rows: what was made of them stays
            self.commit(lambda now: Record("expire", added, [one.path for one in old]))
        return {"dropped": len(dropped), "rewritten": len(across)}

    def compact(self) -> int:
        """Writes the files of every part that has several as one more version; what is appended meanwhile stays beside."""
        now = self.snapshot()
        parts = Counter(one.part for one in now.files.values())
        old = [one for one in now.files.values() if parts[one.part] > 1]
        return self.replace(old, self.frame(old), kind="compact") if old else now.number

    def vacuum(self, keep_from: int, grace_s: float = 86400) -> int:
        """Removes files that no version from `keep_from` on shows or tells its followers of, and the records before it.

        Files younger than `grace_s` stay: their writer may not have committed them yet. Returns the number removed.
        """
        known = [n for n in self.numbers() if n >= keep_from]
        if not known:
            raise ValueError(f"{self.path} has no version {keep_from}")
        needed = set(self.snapshot(known[0]).files)
        for number in known:
            record = self.record(number)
            needed |= {one.path for part in (record.added, record.plus, record.minus) for one in part}
        before = time.time() - grace_s
        gone = [path for path, changed in self.folder.files_below("data")
                if path.endswith(".parquet") and path not in needed and changed <= before]
        for path in gone:
            self.folder.delete(path)
        # records back to the last complete list stay: versions from `keep_from` on are read from there
        start = max((n for n in self.numbers() if n <= keep_from and self.record(n).whole), default=0)
        for number in [n for n in self.numbers() if n < start]:
            self.folder.delete(f"log/{number:012d}.json")
        return len(gone)


class KeyedLog(VersionedTable):
    """Rows in batches; the newest of a key counts: by `newest`, then by batch."""

    def __init__(self, spark: SparkSession, path: str, columns: str, keys: list[str], newest: list[Column] | None = None,
                 indexed: str | None = None):
        super().__init__(spark, path, f"{columns}, batch_id bigint", indexed)
        self.keys = keys
        self.order = [*(newest or []), F.desc("batch_id")]

    def upsert(self, rows: DataFrame, batch: int, writer: str = "") -> int:
        return self.append(rows.withColumn("batch_id", F.lit(batch).cast("bigint")), writer, batch)

    def current(self, version: int | None = None) -> DataFrame:
        return latest(self.read(version), self.keys, self.order).drop("batch_id")

    def compact(self) -> int:
        """Writes the newest row of every key as one more version; batches that come meanwhile stay beside it."""
        now = self.snapshot()
        if len(now.files) < 2:
            return now.number
        files = list(now.files.values())
        return self.replace(files, latest(self.frame(files), self.keys, self.order), kind="compact")

"""Compresses vectors to the indexes of their parts' nearest codebook entries.

Components become integers, vectors are cut into equal parts, and every part position has a codebook that a few rounds of
assigning and averaging move to its parts. The nearest entry is sought by grid cell: the cell that a part falls into is
hashed, and a task remembers for every cell the entries that can be nearest to any point of its box: those whose least
distance to the box does not exceed the smallest of the largest distances. Only these are evaluated exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import BROADCAST_BYTES, mapped, staged
from meterdw.operators.joins import split_join

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# integers are held at this size, so that distances and their sums fit 64 bits
HIGHEST = 1 << 27
CELLS = 1 << 15
BLOCK = 1024


def whole_numbers(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key, label, integer components of the rows whose vector is there and finite throughout."""
    number = F.col("vector").cast("array<double>")
    kept = F.col("vector").isNotNull() & F.forall(number, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    held = lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(HIGHEST)), F.lit(-HIGHEST))
    top = float(HIGHEST // SCALE)
    return (vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
            .where(kept).select("key", "label", F.transform(number, lambda x: held(
                F.greatest(F.least(x, F.lit(top)), F.lit(-top))).cast("int")).alias("vector")))


def dimension(rows: DataFrame, parts: int) -> int:
    """The common length of all vectors, 0 without rows."""
    ends = rows.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    if ends.least is None:
        return 0
    if ends.least != ends.most or ends.most % parts:
        raise ValueError(f"vectors have {ends.least} to {ends.most} components: one length, divisible by {parts}, is needed")
    return ends.most


def first_books(rows: DataFrame, dim: int, parts: int, entries: int) -> np.ndarray:
    """The vectors of the least ids, cut into parts: part x entry x component. At most `entries` rows reach the driver."""
    first = rows.orderBy(F.asc_nulls_last("key"), "vector").limit(entries).select("vector").collect()
    return np.array([row.vector for row in first], np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2)


def cell_width(book: np.ndarray) -> int:
    """A quarter of the entries' spread: boxes so small leave few entries for a cell."""
    return max(1, int(np.sqrt(np.mean((book - book.mean(axis=0)) ** 2)) / 4)) if book.size else 1


class Nearest:
    """Nearest entries of one codebook, with the candidates of every grid cell remembered."""

    def __init__(self, book: np.ndarray, width: int):
        self.book = book
        self.width = width
        self.cells: dict[bytes, int] = {}
        self.found: list[np.ndarray] = []

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell the entries, in order, that no other is nearer than for every point of the box."""
        least = np.zeros((len(cells), len(self.book)), np.int64)
        most = np.zeros_like(least)
        for place in range(cells.shape[1]):
            values, at = np.unique(cells[:, place], return_inverse=True)
            low = (values * self.width)[:, None]
            high = low + self.width - 1
            entry = self.book[:, place][None, :]
            near = np.maximum(np.maximum(low - entry, entry - high), 0)
            far = np.maximum(np.abs(entry - low), np.abs(high - entry))
            least += (near * near)[at]
            most += (far * far)[at]
        return [np.flatnonzero(row).astype(np.uint8) for row in least <= most.min(axis=1, keepdims=True)]

    def _of_cells(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates of all points, one after the other, and how many each point has."""
        flat = np.ascontiguousarray(cells)
        keys = flat.view(np.dtype((np.void, flat.itemsize * flat.shape[1]))).ravel().tolist()
        if len(self.cells) > CELLS:
            self.cells.clear()
            self.found.clear()
        fresh = {key: at for at, key in enumerate(keys) if key not in self.cells}
        if fresh:
            self.cells.update(zip(fresh, range(len(self.found), len(self.found) + len(fresh))))
            self.found += self.candidates(cells[list(fresh.values())])
        chosen = [self.found[self.cells[key]] for key in keys]
        return np.concatenate(chosen), np.array([len(one) for one in chosen])

    def assign(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, the lower of equally near ones, and the squared distance."""
        if not points.shape[1]:
            return np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        index, error = [], []
        for at in range(0, len(points), BLOCK):
            block = points[at:at + BLOCK]
            entries, many = self._of_cells(block // self.width)
            away = self.book[entries] - np.repeat(block, many, axis=0)
            distance = np.einsum("ij,ij->i", away, away)
            starts = np.cumsum(many) - many
            nearest = np.minimum.reduceat(distance, starts)
            hits = np.flatnonzero(distance == np.repeat(nearest, many))
            index.append(entries[hits[np.searchsorted(hits, starts)]].astype(np.int64))
            error.append(nearest)
        return np.concatenate(index), np.concatenate(error)


def _points(batch: pa.RecordBatch, parts: int, dim: int) -> np.ndarray:
    """Rows x parts x components."""
    flat = pc.list_flatten(batch.column("vector")).to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(batch.num_rows, parts, dim // parts)


def _searchers(books, widths: list[int]) -> list[Nearest]:
    return [Nearest(book, width) for book, width in zip(books.value, widths)]


def _sums(rows: DataFrame, books, widths: list[int], dim: int) -> DataFrame:
    """Per part and entry the parts assigned to it: their number and their components' sums, added up by task first."""
    parts = len(widths)

    def run(batches: Iterator[pa.RecordBatch]):
        searchers = _searchers(books, widths)
        shape = books.value.shape
        sums, number = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            points = _points(batch, parts, dim)
            for part, searcher in enumerate(searchers):
                index, _ = searcher.assign(points[:, part])
                np.add.at(sums[part], index, points[:, part])
                number[part] += np.bincount(index, minlength=shape[1])
        part, entry = np.nonzero(number)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(number[part, entry]),
                 pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "number", "sums"])

    found = mapped(rows.select("vector"), run, "part int, entry int, number bigint, sums array<bigint>")
    places = F.posexplode("sums").alias("place", "sum")
    return (found.select("part", "entry", "number", places).groupBy("part", "entry", "place")
            .agg(F.sum("number").alias("number"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")))


def trained_books(rows: DataFrame, dim: int, parts: int, entries: int, rounds: int) -> tuple[np.ndarray, list[int]]:
    """Codebooks after all rounds, and the cell widths. Each round sends sums of at most parts x entries to the driver."""
    context = rows.sparkSession.sparkContext
    books = first_books(rows, dim, parts, entries)
    widths = [cell_width(book) for book in books]
    for _ in range(rounds):
        sent = context.broadcast(books)
        moved = books.copy()
        for row in _sums(rows, sent, widths, dim).collect():
            moved[row.part, row.entry, row.place] = int(row.sum) // row.number
        sent.destroy()
        books = moved
    return books, widths


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per kept vector: key, code (an index a part, two hex digits each), error, label_error, codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped. Components are floor(1024 x), held at
    +-2^27. Rows with equal or null keys are coded apart; for the first codebook null keys come last and equal keys go by
    their vectors. Fewer rows than entries make a smaller codebook. Null labels are one label. Vectors of several
    lengths, or of a length that the parts do not divide, are an error. An empty table gives no rows. Other columns are
    not read. The sums of labels are broadcast while small, else shuffled with large labels cut into pieces.
    """
    if entries > 256:
        raise ValueError("two hex digits name at most 256 entries")
    rows = staged(whole_numbers(vectors, key, vector, label), "vectors")
    dim = dimension(rows, parts)
    books, widths = trained_books(rows, dim, parts, entries, rounds)
    sent = rows.sparkSession.sparkContext.broadcast(books)
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("key", "label")}

    def run(batches):
        searchers = _searchers(sent, widths)
        for batch in batches:
            points = _points(batch, parts, dim)
            found = [searcher.assign(points[:, part]) for part, searcher in enumerate(searchers)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([row.tobytes().hex() for row in codes], pa.string()),
                 pa.array(sum(error for _, error in found))], ["key", "label", "code", "error"])

    coded = staged(mapped(rows, run, f"key {kinds['key']}, label {kinds['label']}, code string, error bigint"), "codes")
    # null labels meet as one: a text that no label has stands for them
    named = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("name")
    coded = coded.select("*", named)
    totals = coded.groupBy("name").agg(F.sum("error").alias("label_error"))
    if totals.count() * 64 <= broadcast_bytes:
        joined = coded.join(F.broadcast(totals), "name")
    else:
        joined = split_join(coded, totals, "name", "inner", spread_by=["key", "code"])
    return joined.select(F.col("key").alias(key), "code", "error", "label_error",
                         F.lit(books_digest(books)).alias("codebooks_sha256"))

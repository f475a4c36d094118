"""Helpers of the operators: staged tables, bounded batches, hashes of words and shingles, monotone calibration."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw.session import scratch_dir

BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared scratch folder and reads them back, which cuts the lineage there."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """`mapInArrow`, for functions of this package: its modules go to the executors once per application."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_meterdw_sent", False):
        package = Path(__file__).resolve().parent.parent
        archive = f"{tempfile.mkdtemp(prefix='meterdw-')}/meterdw.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(archive)
        context._meterdw_sent = True
    return df.mapInArrow(run, schema)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """The frame, marked for broadcast if its counted rows come to at most 64 MB; otherwise Spark shuffles it."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def fold(key: str) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5


def text_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that the texts of a slice stay within `limit` bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    # the worker lives on: it gives back what the batches took
    pa.default_memory_pool().release_unused()


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [value or "" for value in batch.column(column).to_pylist()]


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins and the last ends. Nulls are empty."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


# --- words and shingles as 64-bit hashes ---

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += np.uint64(32)
BASE = np.uint64(0x9E3779B97F4A7C15)
WIDTH = 5
FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                    0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)
SEGMENT = 1 << 20

_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    global _powers
    if len(_powers) < count:
        steps = np.full(max(count, 1024), BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values, one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hash_segment(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word; words also end at `breaks`."""
    gap = SEPARATOR[data]
    begins = ~gap
    begins[1:] &= gap[:-1]
    breaks = breaks[breaks < len(data)]
    begins[breaks] = ~gap[breaks]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    word = np.cumsum(begins) - 1
    within = np.arange(len(data)) - starts[np.maximum(word, 0)]
    within[gap] = 0
    terms = (LOWER[data] + np.uint64(1)) * powers(int(within.max(initial=0)) + 1)[within]
    terms[gap] = 0
    return mix(np.add.reduceat(terms, starts)), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order (A-Z lower-cased), and the index of each text's first word.

    Long texts are hashed in segments that end at white space, so that the work arrays stay small.
    """
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data) and not SEPARATOR[data[end - 1]]:
            ahead = np.flatnonzero(SEPARATOR[data[end:end + SEGMENT]])
            end = end + int(ahead[0]) + 1 if len(ahead) else min(len(data), end + SEGMENT)
        inside = offsets[(offsets >= at) & (offsets < end)] - at
        found, where = _hash_segment(data[at:end], inside)
        hashes.append(found)
        starts.append(where + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(array: pa.Array) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its five-word shingles; fewer words make one shingle, no words none."""
    hashes, first = word_hashes(*utf8(array))
    rolled = np.zeros(max(0, len(hashes) - WIDTH + 1), np.uint64)
    for j in range(WIDTH):
        rolled += hashes[j:j + len(rolled)] * FACTORS[j]
    rolled = mix(rolled)
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin >= WIDTH:
            out.append(np.unique(rolled[begin:end - WIDTH + 1]))
        elif end > begin:
            total = (hashes[begin:end] * FACTORS[:end - begin]).sum(keepdims=True)
            out.append(mix(total + FACTORS[WIDTH:] * np.uint64(end - begin)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_id(tokens: np.ndarray) -> int:
    """One signed 64-bit value per set, whatever the order of its elements."""
    total = mix(tokens + FACTORS[0]).sum(keepdims=True) + FACTORS[1:2] * np.uint64(len(tokens))
    return int(mix(total).view(np.int64)[0])


# --- calibration ---

def isotonic(x: np.ndarray, positives: np.ndarray, rows: np.ndarray) -> tuple[list[float], list[float]]:
    """Pools neighbours until the rates rise with x. Returns the lower end and the rate of every pool.

    Where two pools meet, the middle between their nearest values parts them. Each pool's rate is drawn towards the rate of all rows by one row, so that none is exactly 0 or 1.
    """
    if not len(x) or not rows.sum():
        return [0.0], [0.5]
    prior = (positives.sum() + 0.5) / (rows.sum() + 1)
    order = np.argsort(x)
    pools: list[list[float]] = []
    for at, good, count in zip(x[order], positives[order], rows[order]):
        pools.append([float(at), float(at), float(good), float(count)])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, last, more, rest = pools.pop()
            pools[-1][1:] = [last, pools[-1][2] + more, pools[-1][3] + rest]
    rates = [(good + prior) / (count + 1) for _, _, good, count in pools]
    starts = [pools[0][0], *((one[1] + other[0]) / 2 for one, other in zip(pools, pools[1:]))]
    return starts, list(np.maximum.accumulate(rates))


def calibrated(raw: np.ndarray, starts: list[float], rates: list[float]) -> np.ndarray:
    """The rate of the pool that each raw score falls into; scores below the first pool take its rate."""
    at = np.searchsorted(np.asarray(starts), raw, side="right") - 1
    return np.asarray(rates)[np.maximum(at, 0)]

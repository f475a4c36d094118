"""Finds benchmark passages in texts by the q-gram lemma and banded alignment.

A passage of m characters that lies in a text with at most k edits shares at least m - q + 1 - k q of its q-grams
with it, all on neighbouring diagonals (place in the text minus place in the passage). Shared q-grams are counted in
overlapping bands of diagonals; only bands that reach the bound are aligned, inside the band.

Texts are read once, where they lie; the benchmark goes to them in blocks of bounded size. Letters A-Z and those of
Latin-1 and Latin Extended-A are compared without regard to case, and every white-space character as a blank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import mapped, text_slices, texts

Q = 10
EDIT_RATE = 0.08
# characters of benchmark text that go to the tasks at once; further blocks follow in further passes
BLOCK_CHARS = 2_000_000
SLOT_BITS = 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)
COST = np.int64(1) << np.int64(40)
ALIGN_CELLS = 1 << 21
# pairs of equal q-grams that are laid out at once
PAIRS = 1 << 20


def _folded() -> np.ndarray:
    """The comparison form of every code point below 0x180; those above stay as they are."""
    out = np.arange(0x180, dtype=np.uint32)
    for point in range(0x180):
        char = chr(point)
        low = char.lower()
        out[point] = 32 if char.isspace() else ord(low) if len(low) == 1 else point
    return out


FOLDED = _folded()


def code_points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < len(FOLDED), FOLDED[np.minimum(points, len(FOLDED) - 1)], points)


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters from every place on, put together from hashes of 1, 2, 4, ... characters."""
    out, have, double, width = None, 0, (points.astype(np.uint64) + np.uint64(1)) * FACTOR, 1
    scale = FACTOR
    while width <= q:
        if q & width:
            if out is None:
                out, have = double, width
            else:
                n = len(points) - have - width + 1
                if n <= 0:
                    return np.empty(0, np.uint64)
                out = out[:n] * scale + double[have:have + n]
                have += width
        n = len(points) - 2 * width + 1
        if n <= 0 and have < q:
            return np.empty(0, np.uint64)
        double = double[:max(n, 0)] * scale + double[width:width + max(n, 0)]
        scale = np.uint64(int(scale) * int(scale) & 0xFFFFFFFFFFFFFFFF)
        width *= 2
    return out ^ (out >> np.uint64(29))


@dataclass
class Index:
    """The q-grams of a block of passages, sorted, with the passage and place of each. Equal passages are kept once."""

    ids: list[list]
    points: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    slots: np.ndarray
    short: list[int]
    q: int

    @classmethod
    def of(cls, rows: list[tuple], q: int, rate: float) -> Index:
        same: dict[bytes, list] = {}
        for item, text in rows:
            same.setdefault(code_points(text).tobytes(), []).append(item)
        points = [np.frombuffer(passage, np.uint32) for passage in same]
        size = np.array([len(p) for p in points], np.int64)
        # the largest budget within the rate for which the lemma still asks for one shared q-gram
        edits = np.maximum(0, np.minimum((size * rate + 1e-9).astype(np.int64), (size - q) // q))
        grams = [gram_hashes(p, q) if len(p) >= q else np.empty(0, np.uint64) for p in points]
        item = np.repeat(np.arange(len(points)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams] or [np.empty(0, np.int64)])
        flat = np.concatenate(grams or [np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        slots = np.zeros(1 << SLOT_BITS, bool)
        slots[flat >> np.uint64(64 - SLOT_BITS)] = True
        return cls(list(same.values()), points, edits, size - q + 1 - edits * q, flat[order], item[order],
                   place[order].astype(np.int64), slots, [i for i, s in enumerate(size) if 0 < s < q], q)


def banded(points: np.ndarray, jobs: list[tuple[int, int, int, int]], passages: list[np.ndarray]) -> list[tuple]:
    """Aligns whole passages within bands of a text: per job (passage, first diagonal, diagonals, edits allowed).

    Returns (edits, start, end) of the best place of each job, or None beyond the budget. All jobs advance together,
    one character of their passages at a time. A cell holds edits and start in one number, fewer edits first.
    """
    out: list[tuple | None] = [None] * len(jobs)
    at = 0
    order = sorted(range(len(jobs)), key=lambda j: len(passages[jobs[j][0]]))
    while at < len(order):
        upto = at + 1
        width = jobs[order[at]][2]
        while upto < len(order) and (upto - at + 1) * max(width, jobs[order[upto]][2]) <= ALIGN_CELLS:
            width = max(width, jobs[order[upto]][2])
            upto += 1
        group = order[at:upto]
        longest = max(len(passages[jobs[j][0]]) for j in group)
        first = np.array([jobs[j][1] for j in group], np.int64)
        size = np.array([len(passages[jobs[j][0]]) for j in group], np.int64)
        chars = np.full((len(group), longest), 0xFFFFFFFF, np.uint32)
        for row, j in enumerate(group):
            chars[row, :size[row]] = passages[jobs[j][0]]
        budget = np.array([jobs[j][3] for j in group], np.int64)
        lane = np.arange(width, dtype=np.int64)
        begin = first[:, None] + lane
        # a path may begin at any diagonal of the band that lies in the text; ties take the latest start
        cell = np.where((begin >= 0) & (begin <= len(points)), len(points) - begin, 64 * COST)
        padded = np.concatenate([points, np.full(1, 0xFFFFFFFE, np.uint32)])
        for i in range(longest):
            where = begin + i
            inside = (where >= 0) & (where < len(points))
            same = inside & (padded[np.where(inside, where, len(points))] == chars[:, i:i + 1])
            step = np.where(inside, cell + np.where(same, 0, COST), 64 * COST + cell)
            skip = np.full_like(cell, 1 << 60)
            skip[:, :-1] = cell[:, 1:] + COST
            skip[where + 1 > len(points)] = 1 << 60
            cell = np.minimum(step, skip)
            cell = np.minimum.accumulate(cell - lane * COST, axis=1) + lane * COST
            for row in np.flatnonzero(size == i + 1).tolist():
                ends = begin[row] + i + 1
                fit = np.where((ends >= 0) & (ends <= len(points)), cell[row], 1 << 60)
                lane_at = int(fit.argmin())
                edits, start = divmod(int(fit[lane_at]), int(COST))
                if edits <= budget[row]:
                    out[group[row]] = (edits, len(points) - start, int(ends[lane_at]))
            if i % 16 == 15:
                # jobs that are done or have spent their edits leave; edits never fall from one character to the next
                live = np.flatnonzero((size > i + 1) & (cell.min(axis=1) < (budget + 1) * COST))
                if 2 * len(live) <= len(group):
                    group = [group[row] for row in live.tolist()]
                    chars, size, budget, begin, cell = (part[live] for part in (chars, size, budget, begin, cell))
                if not group:
                    break
        at = upto
    return out


def shared_grams(points: np.ndarray, first: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, passage and strip of diagonals, in order, with the number of q-grams that they share there.

    A gram that stands in many places of the texts and of the passages makes very many pairs: they are counted in pieces
    of bounded size, and only the counts are kept.
    """
    q = index.q
    hits = gram_hashes(points, q) if len(points) >= q and len(index.grams) else np.empty(0, np.uint64)
    where = np.flatnonzero(index.slots[hits >> np.uint64(64 - SLOT_BITS)])
    left = np.searchsorted(index.grams, hits[where], "left")
    count = np.searchsorted(index.grams, hits[where], "right") - left
    # a gram must not run over the end of its text
    text = np.searchsorted(first, where, "right") - 1
    real = (count > 0) & (where + q <= first[text + 1])
    where, left, count, text = where[real], left[real], count[real], text[real]
    low = int(np.diff(first).max(initial=0)) + max((len(p) for p in index.points), default=0) + 1
    strips = 2 * low + 1
    ends = np.cumsum(count)
    keys, sums, waiting, at = [], [], 0, 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        return found, np.bincount(place, np.concatenate(sums), len(found)).astype(np.int64)

    while at < len(where):
        base = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
        many = count[at:stop]
        entry = np.repeat(left[at:stop] - (ends[at:stop] - many - base), many) + np.arange(many.sum())
        item = index.item[entry]
        # overlapping bands: two neighbouring strips of k + 1 diagonals hold any run of k + 1
        width = index.edits[item] + 1
        diagonal = np.repeat(where[at:stop] - first[text[at:stop]], many) - index.place[entry]
        key = (np.repeat(text[at:stop], many) * len(index.points) + item) * strips + (diagonal + low * width) // width
        found, shared = np.unique(key, return_counts=True)
        keys.append(found)
        sums.append(shared)
        waiting += len(found)
        if waiting > 4 * PAIRS:
            keys, sums = ([one] for one in merged())
            waiting = len(keys[0]) // 2
        at = stop
    if not keys:
        none = np.empty(0, np.int64)
        return none, none, none, none
    key, shared = merged()
    pair, strip = np.divmod(key, strips)
    return *np.divmod(pair, len(index.points)), strip - low, shared


def passages_in(values: list[str], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, passage, start, end, edits) of every passage that lies in a text, best place of overlapping ones."""
    first = np.concatenate([[0], np.cumsum(np.array([len(value) for value in values], np.int64))])
    points = code_points("".join(values))
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    text, item, strip, shared = shared_grams(points, first, index)
    if len(text):
        neighbour = np.zeros(len(text), bool)
        neighbour[:-1] = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (strip[1:] == strip[:-1] + 1)
        band = shared + np.where(neighbour, np.append(shared[1:], 0), 0)
        jobs: dict[int, list[tuple[int, int, int, int]]] = {}
        for at in np.flatnonzero(band >= index.bound[item]).tolist():
            t, i, s = int(text[at]), int(item[at]), int(strip[at])
            k = int(index.edits[i])
            jobs.setdefault(t, []).append((i, s * (k + 1) - k, 2 * (k + 1) + 2 * k, k))
        for t, todo in jobs.items():
            inside = points[first[t]:first[t + 1]]
            for (i, *_), place in zip(todo, banded(inside, todo, index.points)):
                if place:
                    found.setdefault((t, i), []).append((place[1], place[2], place[0]))
    for i in index.short:
        needle = index.points[i].tobytes()
        for t in range(len(values)):
            hay, at = points[first[t]:first[t + 1]].tobytes(), 0
            while (at := hay.find(needle, at)) >= 0:
                if at % 4 == 0:
                    found.setdefault((t, i), []).append((at // 4, (at + len(needle)) // 4, 0))
                at += 1
    for (t, i), places in sorted(found.items()):
        kept: list[tuple[int, int, int]] = []
        for start, end, edits in sorted(set(places), key=lambda p: (p[2], p[0], p[1])):
            if all(end <= a or start >= b for a, b, _ in kept):
                kept.append((start, end, edits))
        yield from ((t, i, *place) for place in sorted(kept))


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The passages in blocks of bounded size; empty and null ones are left out, as nothing can match them."""
    rows, chars = [], 0
    for row in benchmark.select(item, text).where(F.length(text) > 0).toLocalIterator():
        rows.append((row[0], row[1]))
        chars += len(row[1])
        if chars >= BLOCK_CHARS:
            yield rows
            rows, chars = [], 0
    if rows:
        yield rows


def _indexes(benchmark: DataFrame, item: str, text: str, q: int, rate: float) -> Iterator:
    context = benchmark.sparkSession.sparkContext
    for rows in blocks(benchmark, item, text):
        yield context.broadcast(Index.of(rows, q, rate))


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
         item_text: str = "text", q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """One row per passage and place: key, item, start, end (code points, end exclusive), edits, passage.

    A passage may differ from the benchmark by edits of single characters up to `rate` of its length, or by as many
    as the lemma allows if those are fewer; one shorter than q must lie there as it is. Overlapping places of one
    passage give the one with the fewest edits. Null and empty texts and passages match nothing; repeated rows and
    repeated passages are reported each. An empty table on either side gives no rows. Other columns are not read.
    """
    key_kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    schema = f"key {key_kind}, item {item_kind}, start bigint, end bigint, edits bigint, passage string"
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(item_kind, pa.int64())
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def search(index):
        def run(batches):
            for batch in text_slices(batches, "text"):
                values = texts(batch, "text")
                hits = [(*h, name) for h in passages_in(values, index.value) for name in index.value.ids[h[1]]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array([h[0] for h in hits], pa.int64())),
                     pa.array([h[5] for h in hits], arrow),
                     *[pa.array([h[j] for h in hits], pa.int64()) for j in (2, 3, 4)],
                     pa.array([values[h[0]][h[2]:h[3]] for h in hits], pa.string())],
                    ["key", "item", "start", "end", "edits", "passage"])
        return run

    out = None
    for index in _indexes(benchmark, item, item_text, q, rate):
        part = mapped(source, search(index), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"key": key, "item": item})


def without_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                     item_text: str = "text", q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of `docs`, all columns, whose text holds no benchmark passage (as in `find`); nothing is shuffled."""

    def drop(index):
        def run(batches):
            for batch in text_slices(batches, text):
                hit = {h[0] for h in passages_in(texts(batch, text), index.value)}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))
        return run

    for index in _indexes(benchmark, item, item_text, q, rate):
        docs = mapped(docs, drop(index), docs.schema)
    return docs

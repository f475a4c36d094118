"""Scores texts for quality: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics are read from whole texts once. cos(W x + b) with normal W and uniform b approximates a Gaussian kernel over
them, so ridge regression on these features is kernel ridge regression. Its normal equations are sums over rows: each
partition adds up its own, and the sums are added in a second, smaller round. Scores of labelled rows that took no
part in the fit then calibrate it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import calibrated, fold, isotonic, mapped, staged, text_slices, utf8, word_hashes

THRESHOLD = 0.3
FEATURES = 256
RIDGE = 1e-3
SEED = 11
# raw scores are calibrated on this many steps between -1 and 2
STEPS = 1500
# the second round of sums has at most this many tasks, whose sums go to the driver
ROUNDS = 32
FIT_FOLDS, CALIBRATION_FOLD = (1, 2, 3), 4

# classes of bytes: the statistics count each of them
CLASSES = {
    "lower": range(0x61, 0x7B), "upper": range(0x41, 0x5B), "digit": range(0x30, 0x3A), "blank": [0x20],
    "line": [0x0A], "control": [*range(0x00, 0x0A), *range(0x0B, 0x20), 0x7F], "stop": b".,;:", "quote": b"'\"-()",
    "loud": b"!?", "bar": b"|", "symbol": b"#$%&*+/<=>@[\\]^_`{}~", "beyond": range(0x80, 0x100),
}
CLASS_OF = np.zeros(256, np.int64)
for _number, _members in enumerate(CLASSES.values()):
    CLASS_OF[list(_members)] = _number
COUNT = len(CLASSES)
WORDS = ["chars", "words", "word_length", "distinct", "distinct_triples", "most_frequent", "same_as_before",
         "ends_in_letter", "lines", "distinct_lines", "lines_end_in_stop", "empty"]
NAMES = [*CLASSES, *WORDS]


def statistics(array: pa.Array) -> np.ndarray:
    """One row of statistics per text; an empty text has zeros and the mark `empty`."""
    data, offsets = utf8(array)
    n = len(offsets) - 1
    out = np.zeros((n, len(NAMES)))
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(owner * COUNT + CLASS_OF[data], minlength=n * COUNT).reshape(n, COUNT)
    out[:, :COUNT] = kinds / np.maximum(sizes, 1)[:, None]
    hashes, first = word_hashes(data, offsets)
    chars = out[:, COUNT:]
    chars[:, 0] = np.log1p(sizes)
    chars[:, 11] = sizes == 0
    raw = data.tobytes()
    letter = (CLASS_OF[data] <= 1) | (CLASS_OF[data] >= COUNT - 1)
    blank = (CLASS_OF[data] == 3) | (CLASS_OF[data] == 4)
    ends = np.zeros(len(data), bool)
    ends[:-1] = ~blank[:-1] & blank[1:]
    ends[offsets[1:][sizes > 0] - 1] = ~blank[offsets[1:][sizes > 0] - 1]
    ended = np.add.reduceat(np.append(ends & letter, False).astype(np.int64), offsets[:-1]) * (sizes > 0)
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        words = hashes[a:b]
        if not len(words):
            continue
        _, counts = np.unique(words, return_counts=True)
        triples = words[:-2] + words[1:-1] * np.uint64(3) + words[2:] * np.uint64(7) if len(words) > 2 else words
        lines = [x for x in raw[offsets[i]:offsets[i + 1]].split(b"\n") if x.strip()]
        chars[i, 1:11] = (
            np.log1p(len(words)), np.log1p((sizes[i] - kinds[i, 3] - kinds[i, 4]) / len(words)),
            len(counts) / len(words), len(np.unique(triples)) / len(triples), counts.max() / len(words),
            (words[1:] == words[:-1]).mean() if len(words) > 1 else 0, ended[i] / len(words),
            np.log1p(len(lines)), len(set(lines)) / len(lines),
            sum(x.rstrip()[-1:] in b".!?:" for x in lines) / len(lines))
    return out


@dataclass
class Model:
    """A fitted scorer of statistics; `starts` and `rates` are the calibration."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    starts: list[float]
    rates: list[float]

    def features(self, x: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(SEED)
        w = draw.normal(size=(x.shape[1], FEATURES)) / np.sqrt(x.shape[1])
        b = draw.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.centre) / self.spread, -5, 5)
        # products row by row: the same text gives the same score in whatever batch it lies
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(np.einsum("ij,jk->ik", z, w) + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.einsum("ij,j->i", self.features(x), self.weights), 9)

    def score(self, x: np.ndarray) -> np.ndarray:
        return calibrated(self.raw(x), self.starts, self.rates)


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key and statistics of every text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in text_slices(batches, "text"):
            rows = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(list(rows), pa.list_(pa.float64()))], ["key", "x"])

    return mapped(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run,
                  f"key {kind}, x array<double>")


def labelled(rows: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """The measured rows of the learning folds with y, the mean label of their id. Held-out rows never enter."""
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
             .select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"))
             .groupBy("key").agg(F.avg("y").alias("y")))
    return rows.join(known, "key").withColumn("fold", fold("key")).where("fold <> 0").select("x", "y", "fold")


def _arrays(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("x").to_pylist(), np.float64).reshape(batch.num_rows, len(NAMES))


def fit(rows: DataFrame) -> Model:
    """Fits on rows (x, y, fold). Without any labelled row every score is 0.5; with one class only, near its rate."""
    learn = rows.where(F.col("fold").isin(*FIT_FOLDS))
    columns = [F.col("x")[i] for i in range(len(NAMES))]
    shape = learn.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    filled = np.array([v or 0.0 for v in shape])
    spread = filled[len(NAMES):]
    model = Model(filled[:len(NAMES)], np.where(spread > 1e-9, spread, 1.0), np.zeros(FEATURES + 1), [0.0], [0.5])

    def sums(batches):
        a, b = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            z = model.features(_arrays(batch))
            a += z.T @ z
            b += z.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_pydict({"a": [a.tobytes()], "b": [b.tobytes()]})

    def add(batches):
        a, b = np.zeros((FEATURES + 1) ** 2), np.zeros(FEATURES + 1)
        for batch in batches:
            for one, two in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a += np.frombuffer(one)
                b += np.frombuffer(two)
        yield pa.RecordBatch.from_pydict({"a": [a.tobytes()], "b": [b.tobytes()]})

    partial = mapped(learn, sums, "a binary, b binary")
    summed = mapped(partial.repartition(ROUNDS), add, "a binary, b binary")
    a, b = np.zeros((FEATURES + 1) ** 2), np.zeros(FEATURES + 1)
    for row in summed.toLocalIterator():
        a += np.frombuffer(bytes(row.a))
        b += np.frombuffer(bytes(row.b))
    a = a.reshape(FEATURES + 1, FEATURES + 1)
    count = a[-1, -1]
    if count:
        model.weights = np.linalg.solve(a + RIDGE * count * np.eye(FEATURES + 1), b)

    def raws(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"raw": pa.array(model.raw(_arrays(batch))), "y": batch.column("y")})

    step = F.floor((F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) + 1) * (STEPS / 3))
    steps = (mapped(rows.where(F.col("fold") == CALIBRATION_FOLD).select("x", "y"), raws, "raw double, y double")
             .groupBy(step.alias("step")).agg(F.sum("y").alias("good"), F.count("y").alias("n")).collect())
    if steps:
        model.starts, model.rates = isotonic(np.array([s.step / (STEPS / 3) - 1 for s in steps], np.float64),
                                             np.array([s.good for s in steps], np.float64),
                                             np.array([s.n for s in steps], np.float64))
    elif count:
        model.starts, model.rates = [0.0], [(b[-1] + 0.5) / (count + 1)]
    return model


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            label: str = "quality") -> tuple[DataFrame, Model]:
    """The staged statistics of all texts, and the model fitted on the labelled ones."""
    rows = staged(measured(docs, key, text), "quality")
    marks = labels.select(F.col(key).alias("key"), F.col(label).alias("mark"))
    return rows, fit(staged(labelled(rows, marks, "key", "mark"), "quality-fit"))


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
           label: str = "quality") -> DataFrame:
    """key, held_out, score, predicted per row of `docs`.

    Null and empty texts share one score, the model's for a text without statistics. Rows with equal texts score
    alike. Null ids are held out; ids labelled several times count with the mean of their labels, null labels with
    none. An empty table gives no rows; without labels every score is 0.5. Other columns are not read.
    """
    rows, model = learned(docs, labels, key, text, label)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.score(_arrays(batch)))],
                                             ["key", "score"])

    return (mapped(rows, run, f"key {kind}, score double")
            .select(F.col("key").alias(key), (fold("key") == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def keeper(model: Model, text: str) -> Callable:
    """A function for mapInArrow that keeps the rows whose text the model accepts."""

    def run(batches):
        for batch in text_slices(batches, text):
            yield batch.filter(pa.array(model.score(statistics(batch.column(text))) >= THRESHOLD))

    return run


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "quality") -> DataFrame:
    """The rows of `docs`, all columns, whose text the classifier accepts. Texts are measured a second time where they
    lie, which is cheaper than sending them to their scores."""
    _, model = learned(docs, labels, key, text, label)
    return mapped(docs, keeper(model, text), docs.schema)

"""Scores texts for toxicity: gradient-boosted trees over dense features of whole texts, calibrated by isotonic steps.

The lexicon is a short fixed list and the words (and word beginnings) that labelled toxic texts use much more often
than others. It is learned from other labelled rows than the trees, and these from other rows than the calibration, so
each step sees what the one before does on texts that it has not learned from. Held-out rows enter none of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import fold, isotonic, mapped, staged, text_slices, texts

THRESHOLD = 0.5
LEXICON_FOLDS, TREE_FOLDS, CALIBRATION_FOLD = (1, 2), (3,), 4
# labelled texts that the lexicon is learned from, at most; trees and calibration use all of their folds
LEXICON_ROWS = 40_000
LEAST_TEXTS, LEAST_ODDS = 5, 12.0
# units that a task counts before it hands them on
COUNTED = 500_000
BEGINNINGS = (5, 6, 7)
TREES, DEPTH, STEP = 30, 3, 0.2
STEPS = 1000

# fixed values: insults and forms of address in the languages of the corpus
INSULTS = frozenset("""
    idiot idiots moron morons stupid dumb dumbass trash garbage pathetic worthless disgusting clown scum loser losers
    fool imbecile jerk bastard bitch asshole shit crap fuck fucking retard freak vermin filth pig hate ugly
    idiotin trottel dumm dummkopf arschloch scheisse abschaum versager depp widerlich ekelhaft wertlos
    imbécile crétin connard salaud merde ordure abruti débile dégoûtant nul
    idiota imbécil estúpido estúpida basura mierda cabrón asqueroso inútil tonto escoria
    """.split())
BY_LENGTH = {size: [word for word in sorted(INSULTS) if len(word) == size] for size in set(map(len, INSULTS))}
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta vous votre
    tú ti tuyo usted ustedes vosotros os
    """.split())
# fixed values: what stands for a letter in obfuscated words
STANDS_FOR = str.maketrans("013457@$!", "oieastasi")

CAPITALS = bytes(range(0x41, 0x5B))
SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")
WORD = re.compile(r"[^\W_]+")
MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[\d@$!*#]++[^\W\d_]++)++")
SPELLED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
NAMES = ["words", "fixed_rate", "fixed_count", "learned_rate", "learned_count", "learned_sum", "learned_most",
         "learned_distinct", "near_second_person", "second_person", "capitals", "capital_words", "exclaims",
         "questions", "marks", "digits", "masked", "masked_insults", "spelled", "word_length", "distinct"]


def units(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class Lexicon:
    """The learned units, with a quick way to the few words of a text that may be among them."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self.words = frozenset(u for u in odds if not u.endswith("*"))
        self.heads = frozenset(u[:BEGINNINGS[0]] for u in odds if u.endswith("*"))

    def of(self, words: set[str]) -> dict[str, float]:
        """The words that are known, or begin like known ones, with the largest odds of their units."""
        head = BEGINNINGS[0]
        maybe = (words & self.words) | ({w for w in words if w[:head] in self.heads} if self.heads else set())
        found = {w: max((self.odds[u] for u in units(w) if u in self.odds), default=0.0) for w in maybe}
        return {w: odds for w, odds in found.items() if odds}


def hides_insult(masked: str) -> bool:
    """Whether an insult has the length of the masked word and its letters wherever * and # do not stand."""
    return any(all(m in "*#" or m == c for m, c in zip(masked, word)) for word in BY_LENGTH.get(len(masked), ()))


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The features of one whole text, in the order of NAMES; an empty text has zeros."""
    low = text.lower()
    words = WORD.findall(low)
    count = len(words)
    if not count:
        return [0.0] * 12 + [text.count("!") / max(1, len(text)), text.count("?") / max(1, len(text))] + [0.0] * 7
    different = set(words)
    known = lexicon.of(different)
    fixed = different & INSULTS
    bad = known.keys() | fixed
    at_bad = [i for i, word in enumerate(words) if word in bad] if bad else []
    sums = [known.get(words[i], 0.0) for i in at_bad]
    fixed_count = sum(words[i] in fixed for i in at_bad)
    at_you = [i for i, word in enumerate(words) if word in SECOND_PERSON] if different & SECOND_PERSON else []
    near = 0.0
    if at_bad and at_you:
        places = np.array(at_you)
        for i in at_bad:
            j = int(np.searchsorted(places, i))
            gap = min(abs(int(places[k]) - i) for k in (j - 1, j) if 0 <= k < len(places))
            near += 1 / (1 + gap)
    masked = MASKED.findall(text)
    plain = [m.lower().translate(STANDS_FOR) for m in masked]
    hidden = sum(p in INSULTS or p in lexicon.words for p in plain) + sum(
        hides_insult(m.lower()) for m in masked if "*" in m or "#" in m)
    letters = sum(map(len, words))
    coded = text.encode("utf-8", "replace")
    upper = len(coded) - len(coded.translate(None, CAPITALS))
    shouted = len(SHOUTED.findall(coded))
    size = len(text)
    return [math.log1p(count), fixed_count / count, float(fixed_count), len(at_bad) / count, float(len(at_bad)),
            sum(sums), max(sums, default=0.0), float(len(bad)), near / count, len(at_you) / count,
            upper / max(1, letters), shouted / count, text.count("!") / size, text.count("?") / size,
            sum(map(text.count, "#$%&*|")) / size, sum(map(text.count, "0123456789")) / size, len(masked) / count,
            float(hidden), float(len(SPELLED.findall(text))), letters / count, len(different) / count]


def _labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """key and y of the learning folds: the mean label of an id, rounded half up to 0 or 1."""
    return (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key"))
            .agg((F.avg(label) >= 0.5).cast("double").alias("y")).withColumn("fold", fold("key")).where("fold <> 0"))


def unit_counts(rows: DataFrame) -> DataFrame:
    """In how many of the texts each unit occurs; every task adds up its own first."""
    def run(batches):
        counted: Counter = Counter()

        def handed_on():
            return pa.RecordBatch.from_arrays([pa.array(list(counted), pa.string()), pa.array(
                list(counted.values()), pa.int64())], ["unit", "n"])

        for batch in text_slices(batches, "text"):
            for value in texts(batch, "text"):
                counted.update({u for w in set(WORD.findall(value.lower())) for u in units(w)})
            if len(counted) > COUNTED:
                yield handed_on()
                counted.clear()
        yield handed_on()

    return mapped(rows.select("text"), run, "unit string, n bigint").groupBy("unit").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, known: DataFrame) -> dict[str, float]:
    """Words and word beginnings (marked *) of toxic texts with their log odds: all units that pass LEAST_ODDS.

    `known` has key and y of at most LEXICON_ROWS texts, which is why it is broadcast and what bounds the units. Equal
    texts with one label count once, in the units and in the classes.
    """
    rows = staged(docs.join(F.broadcast(known), "key").select(F.coalesce("text", F.lit("")).alias("text"), "y")
                  .distinct(), "lexicon")
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get(1.0, 0), totals.get(0.0, 0)
    if not toxic or not clean:
        return {}
    often = unit_counts(rows.where("y = 1")).where(F.col("n") >= LEAST_TEXTS)
    other = unit_counts(rows.where("y = 0")).withColumnRenamed("n", "clean")
    odds = ((F.col("n") + 0.5) / (toxic + 1)) / ((F.coalesce("clean", F.lit(0)) + 0.5) / (clean + 1))
    kept = often.join(other, "unit", "left").select("unit", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS)
    return {r.unit: math.log(r.odds) for r in kept.collect()}


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
           label: str = "toxic") -> DataFrame:
    """key, held_out, score, predicted per row of `docs`.

    Null and empty texts share the score of a text without words. Rows with equal texts score alike. Null ids are held
    out; an id labelled several times counts with its more frequent label (1 on a tie), null labels with none. Where
    the learning rows lack one of the classes, all scores are their rate (0.5 without any). An empty table gives no
    rows. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = staged(_labels(labels, key, label), "labels")
    share = known.where(F.col("fold").isin(*LEXICON_FOLDS))
    size = share.count()
    # a bounded sample by a hash of the id: the limit below it is rarely met
    part = min(1.0, 0.95 * LEXICON_ROWS / max(1, size))
    sample = share.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(part * (1 << 20))).limit(LEXICON_ROWS)
    learned = docs.sparkSession.sparkContext.broadcast(lexicon(rows, staged(sample.select("key", "y"), "sample")))

    def run(batches):
        words = Lexicon(learned.value)
        for batch in text_slices(batches, "text"):
            out = [features(value, words) for value in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.list_(pa.float64()))], ["key", "x"])

    measured = staged(mapped(rows, run, f"key {kind}, x array<double>"), "toxicity")
    learn = staged(measured.join(known, "key").select("x", "y", "fold"), "toxicity-fit")
    trees = learn.where(F.col("fold").isin(*TREE_FOLDS)).select("y", array_to_vector("x").alias("features"))
    classes = {r.y: r.n for r in learn.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = F.col("key").alias(key), (fold("key") == 0).alias("held_out")
    if trees.select("y").distinct().count() < 2:
        rate = (classes.get(1.0, 0) + 0.5) / (sum(classes.values()) + 1)
        return measured.select(*out, F.lit(rate).alias("score"), F.lit(int(rate >= THRESHOLD)).alias("predicted"))
    model = GBTClassifier(labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(trees)

    def raw(frame, *columns):
        judged = model.transform(frame.select(*columns, array_to_vector("x").alias("features")))
        return judged.select(*columns, vector_to_array("probability")[1].alias("raw"))

    steps = (raw(learn.where(F.col("fold") == CALIBRATION_FOLD), "x", "y")
             .groupBy(F.floor(F.col("raw") * STEPS).alias("step"))
             .agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")).collect())
    starts, rates = isotonic(*(np.array([float(v) for v in c]) for c in zip(
        *[(s.step / STEPS, s.good, s.n) for s in steps]))) if steps else ([0.0], [0.5])
    place = F.greatest(F.lit(1), F.size(F.filter(F.lit(starts), lambda start: start <= F.col("raw"))))
    score = F.element_at(F.lit(rates), place) if steps else F.col("raw")
    return (raw(measured, "key", "x").select(*out, score.alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))

"""Toxicity by gradient-boosted trees over dense features, calibrated.

1. A lexicon is learned from a bounded sample of labelled texts: words and
   word beginnings that are in more toxic texts than chance explains, and rare
   in others.
2. Each text gives a dozen features: densities of lexicon words, how close
   they stand to second-person words, and rates of capitals, punctuation and
   obfuscated words. A token's share is worked out once per distinct token.
3. Spark's gradient-boosted trees are fitted to the sample, and isotonic
   regression on rows they have not seen turns their output into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .frames import fold, small_batches, written
from .units import _Numbers
from .words import slices

SAMPLE = 20_000      # labelled rows that are learned from, at most
DRAWN = 4            # labels drawn for each one that is taken, on average
POSITIVE = 8_000     # of them toxic, at most
SUPPORT = 3          # toxic texts that a lexicon entry is in, at least
LIFT = 10.0          # how many times as common it is in toxic texts, at least
CHANCE = 0.05        # entries of any kind that chance may bring into the lexicon
ENTRIES = 100_000    # entries of the lexicon, at most: the strongest
BEGINNINGS = (4, 5, 6, 7)
TREES, DEPTH = 20, 3
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1  # crc32 remainders: never learned from; only calibrated with
NEAR = 6             # words between a lexicon word and a second-person word that count as close
MOST_TOKENS = 200_000
MOST_KEYS = 400_000  # keys that a task counts before it hands them on

# Second-person words of English, German, French, Spanish, Italian and Portuguese.
SECOND_PERSON = frozenset("""
you your yours yourself yourselves u ur ya
du dich dir dein deine deinen deiner ihr euch euer
tu te toi ton ta tes vous votre vos
tú ti tuyo usted ustedes vosotros vuestro
voi vostro lei você vocês seu sua
""".split())
# Characters that stand for letters.
LEET = str.maketrans("013457@$!|", "oieastasii")

_LETTERS = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"[^\W\d_][\d@$!|*#.\-_+]+[^\W\d_]")
_RUN = re.compile(r"(.)\1\1")


def entries_of(token: str) -> set[str]:
    """Lexicon keys of a lower-case token: its words, and their beginnings
    (marked by a hyphen)."""
    out = set()
    for word in _LETTERS.findall(token):
        if len(word) > 2:
            out.add(word)
        out.update(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)
    return out


class Features:
    """Feature rows of texts, given a lexicon (key -> weight)."""

    NAMES = ["hits", "log_hits", "weight", "strongest", "distinct", "close", "addressed", "second_person",
             "capitals", "exclaiming", "punctuation", "runs", "hidden", "hidden_hits", "log_words"]

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.known = 0
        self.shares = np.zeros((1 << 12, 10), np.float32)

    def _weight(self, token: str) -> float:
        return max((self.lexicon.get(k, 0.0) for k in entries_of(token)), default=0.0)

    def _share(self, token: str) -> tuple:
        low = token.lower()
        weight = self._weight(low)
        hidden = bool(_HIDDEN.search(token))
        uncovered = self._weight(re.sub(r"[\W\d_]", "", low.translate(LEET))) if hidden and not weight else 0.0
        bare = low.strip(".,;:!?\"'()[]")
        return (weight, weight > 0, uncovered, hidden, bare in SECOND_PERSON, sum(map(str.isupper, token)),
                sum(map(str.isalpha, token)), token.count("!") + token.count("?"),
                sum(not c.isalnum() for c in token), bool(_RUN.search(low)))

    def rows(self, texts: list[str | None]) -> np.ndarray:
        if len(self.numbers) > MOST_TOKENS:
            self._clear()
        tokens = [(t or "").split() for t in texts]
        which = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(tokens)), np.int64)
        if self.known < len(self.numbers):
            fresh = list(self.numbers)[self.known:]
            while len(self.shares) < len(self.numbers):
                self.shares = np.concatenate([self.shares, np.zeros_like(self.shares)])
            self.shares[self.known:len(self.numbers)] = [self._share(t) for t in fresh]
            self.known = len(self.numbers)
        ends = np.cumsum([0, *map(len, tokens)])
        return np.array([self._row(which[a:b], self.shares[which[a:b]]) for a, b in zip(ends[:-1], ends[1:])])

    def _row(self, which: np.ndarray, s: np.ndarray) -> list[float]:
        n = max(1, len(s))
        total = s.sum(axis=0, dtype=np.float64) if len(s) else np.zeros(10)
        found = np.flatnonzero((s[:, 1] > 0) | (s[:, 2] > 0))
        second = np.flatnonzero(s[:, 4] > 0)
        close = nearest = 0.0
        if len(found) and len(second):
            at = np.searchsorted(second, found)
            gap = np.minimum(np.abs(found - second[np.maximum(at - 1, 0)]),
                             np.abs(second[np.minimum(at, len(second) - 1)] - found))
            close, nearest = float((gap <= NEAR).mean()), 1 / (1 + float(gap.min()))
        letters = max(1.0, total[6])
        return [100 * len(found) / n, math.log1p(len(found)), 100 * (total[0] + total[2]) / n,
                float(s[:, [0, 2]].max()) if len(s) else 0.0, math.log1p(len(np.unique(which[found]))),
                close, nearest, 100 * total[4] / n, total[5] / letters, total[7] / n, total[8] / n,
                100 * total[9] / n, 100 * total[3] / n, 100 * (s[:, 2] > 0).sum() / n, math.log1p(len(s))]


@dataclass
class Model:
    """A lexicon, the fitted trees and calibration; without both classes in
    the sample there are no trees, and every text scores ``base``."""

    lexicon: dict[str, float] = field(default_factory=dict)
    trees: object = None
    calibration: object = None
    base: float = 0.0


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of a bounded number of labelled rows outside the
    held-out fold, the smallest id hashes of each class. Labels are first
    drawn by their hashes, at a rate that leaves a few times the number wanted
    whatever the table's size, so a class is never one task's rows."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id is not null and toxic in (0, 1)").where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    hashed = F.xxhash64("doc_id")
    share = F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    parts = []
    for toxic, most in ((1, POSITIVE), (0, SAMPLE - POSITIVE)):
        drawn = marked.where((F.col("toxic") == toxic) & (share < DRAWN * most / max(1, sizes.get(toxic, 0))))
        parts.append(drawn.orderBy(hashed, "doc_id").limit(most).select("doc_id", "toxic"))
    chosen = parts[0].union(parts[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(texts.join(F.broadcast(chosen), "doc_id"), "labelled")  # at most SAMPLE ids


def _counted(sample: DataFrame) -> DataFrame:
    """(key, n, c): toxic and other texts that hold each lexicon key."""
    def emptied(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        keys = list(counts[1].keys() | counts[0].keys())
        for a in range(0, len(keys), 50_000):
            some = keys[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())] + [
                pa.array([counts[toxic][k] for k in some], pa.int64()) for toxic in (1, 0)], names=["key", "n", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for part in slices(batches, "text"):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                counts[toxic].update(set().union(*map(entries_of, set((text or "").lower().split()))))
            if sum(map(len, counts)) > MOST_KEYS:
                yield from emptied(counts)
                counts = Counter(), Counter()
        yield from emptied(counts)
    found = sample.select("text", "toxic").mapInArrow(run, "key string, n long, c long")
    return found.groupBy("key").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def learn_lexicon(sample: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Key -> log of its lift, of the keys that chance doesn't explain. No
    share of the toxic texts is asked for, as a language may have few of them.
    Counts stay in Spark; the entries alone reach the driver."""
    hot = written(_counted(sample).where(F.col("n") >= SUPPORT), "keys")
    base, doubt = toxic / (toxic + clean), math.log(max(1, hot.count()) / CHANCE)
    n, c = F.col("n"), F.col("c")
    share = n / (n + c)
    # log odds against so many toxic ones of n + c by chance (Chernoff's bound)
    surprise = n * F.log(share / base) + F.when(c > 0, c * F.log((1 - share) / (1 - base))).otherwise(0.0)
    lift = (n / toxic) / ((c + 0.5) / (clean + 1))
    best = (hot.where((share > base) & (surprise >= doubt)).select("key", lift.alias("lift"))
            .where(F.col("lift") >= LIFT).orderBy(F.desc("lift"), "key").limit(ENTRIES))
    return {r["key"]: math.log(r["lift"]) for r in best.toLocalIterator()}


def _featured(docs: DataFrame, lexicon: dict[str, float], prefix: str) -> DataFrame:
    """``docs`` (with a text column) and its feature columns."""
    names = [prefix + n for n in Features.NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(lexicon)
        for part in slices(batches, "text"):
            rows = features.rows(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(rows[:, k]) for k in range(len(names)))],
                                             names=[*part.schema.names, *names])
    schema = StructType([*docs.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    return docs.mapInArrow(run, schema)


def _vectors(df: DataFrame, prefix: str) -> DataFrame:
    return VectorAssembler(inputCols=[prefix + n for n in Features.NAMES], outputCol=prefix + "v").transform(df)


def learn(docs: DataFrame, labels: DataFrame, prefix: str = "tox__") -> Model:
    """A model from the labelled rows outside the held-out fold."""
    small_batches(docs.sparkSession)
    sample = _sample(docs, labels)
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Model(base=1.0 if toxic else 0.0)
    lexicon = learn_lexicon(sample, toxic, clean)
    rows = written(_vectors(_featured(sample, lexicon, prefix), prefix).select(
        "doc_id", "toxic", prefix + "v", fold(F.col("doc_id"), FOLDS).alias("fold")), "features")
    fit, rest = rows.where(F.col("fold") != CALIBRATION), rows.where(F.col("fold") == CALIBRATION)
    fit, rest = fit.coalesce(2), rest.coalesce(2)  # at most SAMPLE short rows
    classes = lambda df: df.select("toxic").distinct().count()
    if classes(fit) < 2:
        return Model(lexicon, base=toxic / (toxic + clean))
    grown = GBTClassifier(labelCol="toxic", featuresCol=prefix + "v", predictionCol=prefix + "p",
                          maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7)
    trees = grown.setProbabilityCol(prefix + "q").setRawPredictionCol(prefix + "r").fit(fit)
    model = Model(lexicon, trees)
    if classes(rest) == 2:
        seen = trees.transform(rest).select(F.col("toxic").cast("double").alias("toxic"),
                                            _probability(prefix).alias(prefix + "raw"))
        model.calibration = IsotonicRegression(labelCol="toxic", featuresCol=prefix + "raw",
                                               predictionCol=prefix + "calibrated").fit(seen)
    return model


def _probability(prefix: str) -> Column:
    return vector_to_array(F.col(prefix + "q"))[1]


def scored(docs: DataFrame, model: Model, prefix: str = "tox__") -> DataFrame:
    """``docs`` with ``<prefix>score``. The score follows the calibration; the
    trees' own output orders rows inside its steps."""
    if model.trees is None:
        return docs.withColumn(prefix + "score", F.lit(model.base))
    out = model.trees.transform(_vectors(_featured(docs, model.lexicon, prefix), prefix))
    out = out.withColumn(prefix + "raw", _probability(prefix))
    if model.calibration is None:
        return out.withColumn(prefix + "score", F.col(prefix + "raw"))
    out = model.calibration.transform(out)
    return out.withColumn(prefix + "score", 0.98 * F.col(prefix + "calibrated") + 0.02 * F.col(prefix + "raw"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Null and empty texts have all features zero and get their score from
    that. A doc_id labelled twice counts as toxic if one label says so; labels
    other than 0 and 1 are skipped; without labels of both kinds every row
    gets the same score. A null doc_id is not held out. Other columns are
    ignored.
    """
    model = learn(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return scored(rows, model).select("doc_id", "held_out", F.col("tox__score").alias("score"),
                                      (F.col("tox__score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    prefix = "tox__"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return scored(docs, learn(docs, labels, prefix), prefix).where(
        F.col(prefix + "score") < 0.5).select(*docs.columns)

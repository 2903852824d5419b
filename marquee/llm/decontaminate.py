"""Benchmark decontamination: rare n-gram seeds, then local alignment.

1. The document frequency of every n-gram of the benchmark is counted over
   all documents.
2. Of every ``WINDOW`` n-grams in a row of an item the rarest is a seed, so
   that each run of ``GRAM + WINDOW - 1`` unchanged words holds one, however
   common an item's words or however often it leaked.
3. Where a document holds a seed, the words around it are aligned with the
   item (Smith-Waterman, linear gaps). The score is the alignment's share of
   the item aligned with itself. Words weigh by rarity, so that chains of
   very common words alone don't reach the threshold.

The benchmark is worked through in blocks of a bounded number of words, each
against all documents; texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import small_batches, written
from .words import PUNCTUATION, shingle_hashes, slices, word_hashes

GRAM = 3             # words to an n-gram
WINDOW = 3           # n-grams in a row of which the rarest is a seed
BLOCK_WORDS = 2_000_000  # words of the benchmark that a pass holds
GAP = 0.5            # price of a word that only one side has, in mean weights of the item's words
SWAP = 0.5           # price of a word that differs, likewise
RARE = 0.001         # share of the items that have a word from which it weighs fully
LIGHTEST = 0.1       # weight of a word that most items have
THRESHOLD = 0.5      # least score of a leak


def _lowered(texts: pa.Array) -> pa.Array:
    return pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string())


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(_lowered(texts), PUNCTUATION)


@dataclass
class Items:
    """A block of benchmark items; all arrays are aligned by n-gram or item."""

    ids: list
    words: list[np.ndarray]
    grams: np.ndarray    # distinct n-gram hashes, ascending

    @classmethod
    def of(cls, rows: list) -> Items:
        hashes, before = _words(pa.array([r["text"] for r in rows], pa.string()))
        words = [hashes[before[i]:before[i + 1]] for i in range(len(rows))]
        kept = [i for i, w in enumerate(words) if len(w)]
        words = [words[i] for i in kept]
        grams = [shingle_hashes(w, GRAM) for w in words]
        return cls([rows[i]["item_id"] for i in kept], words,
                   np.unique(np.concatenate(grams)) if grams else np.empty(0, np.uint64))


def _listed(items: DataFrame) -> DataFrame:
    """(item_id, text) of the benchmark's items, each once."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.where("text is not null").distinct()


def _blocks(listed: DataFrame) -> Iterator[Items]:
    """The benchmark's items, a bounded number of words at a time."""
    held, words = [], 0
    for row in listed.orderBy("item_id", "text").toLocalIterator():
        held.append(row)
        words += row["text"].count(" ") + 1
        if words >= BLOCK_WORDS:
            yield Items.of(held)
            held, words = [], 0
    if held:
        yield Items.of(held)


def _spread(listed: DataFrame) -> DataFrame:
    """(word, n): items of the whole benchmark that hold each word; n of the
    null word is the number of items with words."""
    def run(batches):
        for part in slices(batches, "text"):
            words, before = _words(part.column("text"))
            own = [np.unique(words[a:b]) for a, b in zip(before[:-1], before[1:]) if b > a]
            if own:
                every, count = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([None, *every.view(np.int64).tolist()], pa.int64()),
                                                  pa.array([len(own), *count.tolist()], pa.int64())],
                                                 names=["word", "n"])
    found = listed.select("text").mapInArrow(run, "word long, n long")
    return written(found.groupBy("word").agg(F.sum("n").alias("n")), "spread")


class _Lookup:
    """Places of hashes in a sorted table, with a bit map before the search."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.bits = 1 << min(24, max(16, (16 * len(table)).bit_length()))
        self.seen = np.zeros(self.bits, bool)
        self.seen[(table & np.uint64(self.bits - 1)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``hashes``, places in the table) of those in both."""
        if not len(self.table):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.seen[(hashes & np.uint64(self.bits - 1)).astype(np.int64)])
        to = np.minimum(np.searchsorted(self.table, hashes[at]), len(self.table) - 1)
        same = self.table[to] == hashes[at]
        return at[same], to[same]


def _sizes(items: Items) -> list[int]:
    """n-gram sizes: an item shorter than ``GRAM`` is one gram of its length."""
    return sorted({min(GRAM, len(w)) for w in items.words})


def _frequencies(docs: DataFrame, items: Items) -> np.ndarray:
    """Documents that hold each of the items' n-grams."""
    sizes, table = _sizes(items), items.grams

    def run(batches):
        lookup, counts = _Lookup(table), np.zeros(len(table), np.int64)
        for part in slices(batches, "text"):
            words, before = _words(part.column("text"))
            for i in range(part.num_rows):
                own = words[before[i]:before[i + 1]]
                for size in sizes:
                    if len(own) >= size:
                        counts[np.unique(lookup.find(shingle_hashes(own, size))[1])] += 1
        some = np.flatnonzero(counts)
        for a in range(0, len(some), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(some[a:a + 50_000]), pa.array(counts[some[a:a + 50_000]])],
                                             names=["gram", "n"])
    found = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(len(table), np.int64)
    for gram, n in found.toLocalIterator():  # a row for each n-gram of the block at most
        out[gram] = n
    return out


def _seeds(items: Items, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, item, place) of the seeds, by hash."""
    out = []
    for k, words in enumerate(items.words):
        grams = shingle_hashes(words, GRAM)
        n = often[np.searchsorted(items.grams, grams)]
        chosen = {a + int(n[a:a + WINDOW].argmin()) for a in range(max(1, len(grams) - WINDOW + 1))}
        out += [(int(grams[p]), k, p) for p in sorted(chosen)]
    out.sort()
    return (np.array([h for h, _, _ in out], np.uint64), np.array([k for _, k, _ in out], np.int64),
            np.array([p for _, _, p in out], np.int64))


def _weights(items: Items, spread: DataFrame) -> list[np.ndarray]:
    """Weight of an item's words, relative to their mean: the smaller the share
    of the benchmark's items that have a word, the heavier."""
    every = np.unique(np.concatenate(items.words))

    def run(batches):
        lookup = _Lookup(every)
        for part in batches:
            words = part.column("word").fill_null(0).to_numpy().view(np.uint64)
            at, to = lookup.find(words)
            real = part.column("word").is_valid().to_numpy(zero_copy_only=False)[at]
            yield pa.RecordBatch.from_arrays([pa.array(to[real]), part.column("n").take(pa.array(at[real]))],
                                             names=["place", "n"])
    count = np.ones(len(every))
    for place, n in spread.mapInArrow(run, "place long, n long").toLocalIterator():  # a row for each word of the block
        count[place] = n
    total = spread.where("word is null").first()["n"]
    rarity = np.clip(np.log(total / count) / -np.log(RARE), LIGHTEST, 1.0)
    weights = [rarity[np.searchsorted(every, w)] for w in items.words]
    return [w / w.mean() for w in weights]


def align(item: np.ndarray, weight: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of ``item`` with each row of ``windows`` (0 pads):
    (score, column of its last word). The dearest path through a row's gaps is
    a running maximum, so a whole batch moves one item word at a time."""
    rows, width = windows.shape
    above = np.zeros((rows, width + 1))
    best, end = np.zeros(rows), np.zeros(rows, np.int64)
    slope = GAP * np.arange(width + 1)
    for word, w in zip(item, weight):
        now = np.maximum(above - GAP, 0)
        now[:, 1:] = np.maximum(now[:, 1:], above[:, :-1] + np.where(windows == word, w, -SWAP))
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        at = now.argmax(axis=1)
        top = now[np.arange(rows), at]
        end = np.where(top > best, at - 1, end)
        best = np.maximum(best, top)
        above = now
    return best, end


_FOUND = ["doc_id", "item_id", "score", "first_word", "n_words"]


class _Search:
    """Leaks of a block of items in texts."""

    def __init__(self, items: Items, often: np.ndarray, spread: DataFrame, threshold: float):
        self.items, self.threshold, self.sizes = items, threshold, _sizes(items)
        self.hashes, self.item, self.place = _seeds(items, often)
        self.weights = _weights(items, spread)

    def ready(self) -> _Search:
        self.table, self.first = np.unique(self.hashes, return_index=True)
        self.last = np.append(self.first[1:], len(self.hashes))
        self.lookup = _Lookup(self.table)
        return self

    def _candidates(self, words: np.ndarray, before: np.ndarray) -> dict[int, set]:
        """item -> {(row, stretch)}: a stretch is where the item would start,
        in steps of its own length."""
        out: dict[int, set] = {}
        for size in self.sizes:
            for i in range(len(before) - 1):
                own = words[before[i]:before[i + 1]]
                if len(own) < size:
                    continue
                for at, to in zip(*map(np.ndarray.tolist, self.lookup.find(shingle_hashes(own, size)))):
                    for s in range(self.first[to], self.last[to]):
                        k = int(self.item[s])
                        out.setdefault(k, set()).add((i, (at - int(self.place[s])) // len(self.items.words[k])))
        return out

    def leaks(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """(row, item, score, first word, words) of every leak."""
        words, before = _words(texts)
        best: dict[tuple[int, int], tuple] = {}
        for k, places in self._candidates(words, before).items():
            item, weight = self.items.words[k], self.weights[k]
            full = float(weight.sum())
            rim = max(4, len(item) // 2)
            width = 2 * len(item) + 2 * rim
            places = sorted(places)
            for a in range(0, len(places), 256):
                some = places[a:a + 256]
                start = np.array([before[i] + s * len(item) - rim for i, s in some])
                low = np.array([before[i] for i, _ in some])
                high = np.array([before[i + 1] for i, _ in some])
                at = start[:, None] + np.arange(width)
                inside = (at >= low[:, None]) & (at < high[:, None])
                windows = np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))
                # no alignment scores more than all of the item's words found there
                most = (np.array([(windows == w).any(axis=1) for w in item]) * weight[:, None]).sum(axis=0)
                hope = np.flatnonzero(most >= self.threshold * full)
                if not len(hope):
                    continue
                score, end = align(item, weight, windows[hope])
                for h, s, e in zip(hope.tolist(), (score / full).tolist(), end.tolist()):
                    if s < self.threshold:
                        continue
                    back = windows[h:h + 1, e::-1]
                    length = int(align(item[::-1], weight[::-1], back)[1][0]) + 1
                    row, first = some[h][0], int(start[h] + e - length + 1 - low[h])
                    if s > best.get((row, k), (0,))[0]:
                        best[row, k] = (s, first, length)
        return [(row, k, *v) for (row, k), v in sorted(best.items())]


def _searches(docs: DataFrame, items: DataFrame, threshold: float) -> Iterator[_Search]:
    small_batches(docs.sparkSession)
    listed = _listed(items)
    spread = _spread(listed)
    for block in _blocks(listed):
        if block.ids:
            yield _Search(block, _frequencies(docs, block), spread, threshold)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, first_word, n_words): for each row of ``docs``
    and item it leaks, the best alignment and the words it covers.

    Null and empty texts and items leak nothing; an item shorter than
    ``GRAM`` words is one seed and has to be there whole; repeated rows are
    reported each; an item that is listed twice counts once per item_id.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, first_word long, n_words long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [texts.mapInArrow(_report(s), schema) for s in _searches(texts, items, threshold)]
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.union(written(more, "leaks"))
    return out


def _report(search: _Search):
    def run(batches):
        ready = search.ready()
        for part in slices(batches, "text"):
            leaks = ready.leaks(part.column("text"))
            if leaks:
                rows = pa.array([r[0] for r in leaks])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(rows), pa.array([ready.items.ids[r[1]] for r in leaks], pa.int64()),
                     pa.array([r[2] for r in leaks]), pa.array([r[3] for r in leaks], pa.int64()),
                     pa.array([r[4] for r in leaks], pa.int64())], names=_FOUND)
    return run


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item."""
    out = docs
    for search in _searches(docs.select(F.col("text").cast("string").alias("text")), items, threshold):
        def run(batches, search=search):
            ready = search.ready()
            for part in slices(batches, "text"):
                clean = np.ones(part.num_rows, bool)
                clean[[r[0] for r in ready.leaks(part.column("text"))]] = False
                yield part.filter(pa.array(clean))
        out = out.mapInArrow(run, docs.schema)
    return out

"""Near-duplicate documents by SetSketch registers, banding and verification.

1. Every text becomes its set of word shingles (hashes); texts with the same
   set form one class, and only one row per class goes on, so a group of
   exact copies of any size costs one row.
2. A class's sketch has ``registers`` values ``K = floor(1 - log_b(x))``
   clipped to 0..65535, x the set's smallest exponential value under that
   register's hash. Sketches merge by the maximum.
3. Bands of ``rows`` registers are hashed; classes that share a band meet.
   A frequent band is dealt out in block pairs of about ``BLOCK`` classes.
   Inside a pair of blocks the likelihood of the counts of smaller, equal and
   larger registers gives the resemblance; what may reach the threshold joins
   a family. Only a spanning forest leaves a task, never pairs.
4. Families are dealt out in block pairs again, now with whole texts, and
   links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import groups, small_batches, written
from .words import mix, shingle_set, slices, word_hashes

BASE = 1.001        # register spacing b
RATE = 20.0         # rate a of the exponential values
TOP = 65535         # registers are clipped to 0..TOP
BLOCK = 512         # classes of one band that meet in a task, from each side
FAMILY_BLOCK = 256  # texts of one family that meet in a task, from each side
FAMILY_SHINGLES = 1_000_000  # and their shingles together, about


@dataclass(frozen=True)
class NearDup:
    """Settings: shingle size in words, threshold as percent (100 * shared >=
    percent * union), bands x rows registers."""

    shingle: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 4

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def floor(self) -> float:
        """Least estimate that is verified: 4.5 deviations below the threshold."""
        t = self.percent / 100
        return t - 4.5 * (t * (1 - t) / self.registers) ** 0.5


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    c = mix(seeds)
    return c[:n], c[n:] | np.uint64(1)


def sketch(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """SetSketch registers (uint16) of non-empty sets of hashes, a row each."""
    flip, factor = _constants(registers)
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    low = np.empty((len(sets), registers), np.uint64)
    for j in range(registers):
        low[:, j] = np.minimum.reduceat((every ^ flip[j]) * factor[j], starts)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _log_odds(j: np.ndarray, plus, minus, equal, u, v) -> np.ndarray:
    chance = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    log = lambda x: np.log(np.clip(x, 1e-12, 1))
    p, q = chance(u - v * j), chance(v - u * j)
    return plus * log(p) + minus * log(q) + equal * log(1 - p - q)


def estimate(plus: np.ndarray, minus: np.ndarray, registers: int,
             n_a: np.ndarray, n_b: np.ndarray, steps: int = 100) -> np.ndarray:
    """Resemblance of greatest likelihood, given how many registers are larger
    and smaller in the first sketch and the two sets' sizes."""
    u = (n_a / (n_a + n_b))[:, None]
    top = np.minimum(u / (1 - u), (1 - u) / u)
    j = np.linspace(0, 1, steps + 1)[None, :] * top
    odds = _log_odds(j, plus[:, None], minus[:, None], (registers - plus - minus)[:, None], u, 1 - u)
    return j[np.arange(len(j)), odds.argmax(axis=1)]


def reaches(level: float, plus: np.ndarray, minus: np.ndarray, registers: int,
            n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether :func:`estimate` is at least ``level``: the likelihood has one
    peak, so it is enough to see that it still rises there."""
    u = n_a / (n_a + n_b)
    at = lambda j: _log_odds(j, plus, minus, registers - plus - minus, u, 1 - u)
    top = np.minimum(u / (1 - u), (1 - u) / u)
    return (top >= level) & (at(np.minimum(level + 1e-3, top)) >= at(np.minimum(level, top)))


def _sketches(how: NearDup):
    from hashlib import blake2b

    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                        ("node", pa.binary()), ("n", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("regs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, how.bands + 1, dtype=np.uint64))
        for part in slices(batches, "text"):
            words, before = word_hashes(part.column("text"))
            sets = [shingle_set(words[before[i]:before[i + 1]], how.shingle)
                    for i in range(part.num_rows)]
            full = [s for s in sets if len(s)]
            if full:
                regs = sketch(full, how.registers)
                h = np.zeros((len(full), how.bands), np.uint64)
                for r in range(how.rows):
                    h = mix(h * np.uint64(31) + regs[:, r::how.rows].astype(np.uint64) + salt)
                h = h.view(np.int64)
            k, nodes, keys, values = 0, [], [], []
            for s in sets:
                if len(s):
                    nodes.append(blake2b(s.tobytes(), digest_size=16).digest())
                    keys.append(h[k])
                    values.append(regs[k].tobytes())
                    k += 1
                else:
                    nodes.append(None)
                    keys.append(None)
                    values.append(None)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "k1", "k2")), pa.array(nodes, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(values, pa.binary())], schema=schema)
    return run


class _Union:
    """Union-find over 0..n-1; ``link`` tells whether it joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def link(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def roots(self, which: np.ndarray) -> np.ndarray:
        return np.array([self.root(i) for i in which.tolist()])


_EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _forest(found: list[tuple[int, int]], nodes: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([nodes[i] for i, _ in found], pa.binary()),
         pa.array([nodes[j] for _, j in found], pa.binary())], schema=_EDGES)


def _pairs(rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of the first block, the rows it has to meet: the later
    ones of its own block, or all of the other block."""
    side = rows.column("side").to_numpy()
    if rows.column("diagonal")[0].as_py():
        for i in range(len(side)):
            yield i, np.arange(i + 1, len(side))
    else:
        other = np.flatnonzero(side == 1)
        for i in np.flatnonzero(side == 0).tolist():
            yield i, other


def _alike(regs, n, i, others, how: NearDup) -> np.ndarray:
    """Which of ``others`` may reach the threshold with row ``i``."""
    ok = 100 * np.minimum(n[others], n[i]) >= how.percent * np.maximum(n[others], n[i])
    others = others[ok]
    if not len(others):
        return others
    larger = (regs[i] > regs[others]).sum(axis=1)
    smaller = (regs[i] < regs[others]).sum(axis=1)
    near = larger + smaller <= how.registers * (1 - how.floor) + 1
    others, larger, smaller = others[near], larger[near], smaller[near]
    if not len(others):
        return others
    return others[reaches(how.floor, larger, smaller, how.registers, float(n[i]),
                          n[others].astype(float))]


def _meet(how: NearDup):
    """Spanning forest of the classes of a band block pair that look alike."""
    def run(batches):
        for rows in groups(batches, "unit"):
            if rows.num_rows < 2:
                continue
            nodes = rows.column("node").to_pylist()
            n = rows.column("n").to_numpy()
            regs = np.frombuffer(b"".join(rows.column("regs").to_pylist()), np.uint16)
            regs = regs.reshape(len(nodes), how.registers)
            trees, found = _Union(len(nodes)), []
            for i, others in _pairs(rows):
                if len(others) > 8:
                    others = others[trees.roots(others) != trees.root(i)]
                for j in _alike(regs, n, i, others, how).tolist():
                    if nodes[i] != nodes[j] and trees.link(i, j):
                        found.append((i, j))
            if found:
                yield _forest(found, nodes)
    return run


def _confirm(how: NearDup):
    """Spanning forest of the links of a family block pair, on full sets."""
    from hashlib import blake2b

    def run(batches):
        for rows in groups(batches, "unit"):
            if rows.num_rows < 2:
                continue
            words, before = word_hashes(rows.column("text").combine_chunks())
            sets = [shingle_set(words[before[i]:before[i + 1]], how.shingle)
                    for i in range(rows.num_rows)]
            nodes = rows.column("node").to_pylist()
            # a doc_id that stands for two texts: only the class's own text counts
            own = [blake2b(s.tobytes(), digest_size=16).digest() == k for s, k in zip(sets, nodes)]
            n = np.array([len(s) if o else 0 for s, o in zip(sets, own)])
            regs = sketch([s if len(s) else np.zeros(1, np.uint64) for s in sets], how.registers)
            trees, found = _Union(len(nodes)), []
            for i, others in _pairs(rows):
                if not n[i]:
                    continue
                others = others[n[others] > 0]
                for j in _alike(regs, n, i, others, how).tolist():
                    if nodes[i] == nodes[j] or trees.root(i) == trees.root(j):
                        continue
                    small, large = sorted((sets[i], sets[j]), key=len)
                    at = np.searchsorted(large, small)
                    shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                    union = len(small) + len(large) - shared
                    if 100 * shared >= how.percent * union and trees.link(i, j):
                        found.append((i, j))
            if found:
                yield _forest(found, nodes)
    return run


def _deal(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Rows dealt out to block pairs of their key: (unit, side, diagonal)."""
    mine = F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    return (rows.withColumn("mine", mine).withColumn("other", other)
            .withColumn("unit", F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")))
            .withColumn("side", F.when(F.col("mine") <= F.col("other"), 0).otherwise(1))
            .withColumn("diagonal", F.col("mine") == F.col("other"))
            .drop("mine", "other", key, blocks)
            .repartition("unit").sortWithinPartitions("unit"))


def _classified(docs: DataFrame, how: NearDup) -> DataFrame:
    """(doc_id, k1, k2, n, group, component_id) of every row: k1 and k2 are its
    text's key, ``group`` is one value for each component (null without
    shingles), and component_id its smallest doc_id (null if it has none)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    marked = written(texts.mapInArrow(_sketches(how), (
        "doc_id long, k1 long, k2 long, node binary, n long, bands array<long>, regs binary")), "sketches")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2")  # that stands for a class
    classes = written(marked.where("n > 0").groupBy("node").agg(
        F.min(row).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("regs").alias("regs")).select("node", "row.*", "n", "bands", "regs"), "classes")

    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = written(bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    members = (bands.join(shared, "band")
               .select("node", "band", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    meeting = _deal(members.join(classes.select("node", "n", "regs"), "node"), "band", "blocks")
    alike = meeting.mapInArrow(_meet(how), "a binary, b binary")
    families = written(components(alike, "families"), "families")

    sized = families.join(classes.select("node", "unnamed", "doc_id", "k1", "k2", "n"), "node")
    blocks = written(sized.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / FAMILY_BLOCK),
        F.ceil(F.sum("n") / FAMILY_SHINGLES)).alias("blocks")), "blocks")
    wanted = written(sized.join(blocks, "root").select("node", "root", "blocks", "doc_id", "k1", "k2"), "wanted")
    links = _deal(_one_text_each(texts, wanted), "root", "blocks").mapInArrow(_confirm(how), "a binary, b binary")
    roots = components(links, "links")

    linked = roots.join(classes.select("node", "doc_id"), "node")
    lowest = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = written(classes.select("node", F.col("doc_id").alias("first_id"))
                    .join(roots, "node", "left").join(lowest, "root", "left")
                    .select("node", F.coalesce("root", "node").alias("group"),
                            F.coalesce("component_id", "first_id").alias("component_id")), "named")
    return (marked.select("doc_id", "k1", "k2", "n", "node").join(named, "node", "left")
            .select("doc_id", "k1", "k2", "n", "group", "component_id"))


def _one_text_each(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, root, blocks, text) of the rows that stand for the classes: by
    doc_id and text, so that rows without doc_id and several texts of one are
    told apart. Rows that repeat one of them are in its task and count once."""
    found = _rows_of(texts, wanted.select("node", "root", "blocks", "doc_id", "k1", "k2"))
    return found.select("node", "root", "blocks", "text")


_ROW = ["_id", "_unnamed", "k1", "k2"]


def _named(rows: DataFrame) -> DataFrame:
    """Rows with a key of plain columns for doc_id, text key: joins, and what
    follows by the same key, then share one exchange."""
    return rows.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
                             "_unnamed": F.col("doc_id").isNull()})


def _rows_of(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows (doc_id, k1, k2, ...) that are chosen (doc_id, k1, k2, ...), one of
    those that repeat each other, with the columns of both. Always joined by a
    shuffle, which the last step needs by the same key anyway: a broadcast of
    few chosen rows would make small inputs no guide to large ones."""
    return _named(rows).join(_named(chosen).drop("doc_id").hint("merge"), _ROW).dropDuplicates(_ROW)


def near_duplicates(docs: DataFrame, how: NearDup = NearDup()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Null and empty texts have no shingles and stay alone. Repeated rows and
    texts with equal sets share a class; rows with equal doc_id but different
    texts are different texts, and rows without doc_id are linked by their
    texts like others. ``component_id`` is the smallest doc_id of the
    component; a null doc_id gets it too and is kept only if it has none.
    Other columns of ``docs`` are ignored.
    """
    return (_classified(docs, how)
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_of_each(docs: DataFrame, how: NearDup = NearDup()) -> DataFrame:
    """The rows of ``docs``, all columns, that are left when one row of each
    component stays: that of the smallest doc_id (null last), then text key; of
    rows that repeat it one stays. Rows without shingles all stay."""
    first = (_classified(docs, how).where(F.col("group").isNotNull()).groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k1", "k2")).alias("row"))
        .select("row.doc_id", "row.k1", "row.k2"))
    first = written(first, "firsts")
    text = F.col("text").cast("string")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
                        F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("words"))
    return (_rows_of(whole.where("words"), first).select("row.*")
            .union(whole.where("not words").select("row.*")))

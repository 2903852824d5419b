"""Bottom-k fingerprints of documents.

A text's fingerprint is the ``k`` smallest of its word shingles' hashes (48
bits each). Fewer than ``k`` values are the whole set. Fingerprints of parts
merge into the whole's: unite and keep the ``k`` smallest. Below the lesser of
two fingerprints' largest values both sets are known in full, so the shared
share there estimates resemblance and containment; the largest value's place
in the hash range estimates the number of distinct shingles.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import groups, partitions, small_batches
from .words import shingle_hashes, slices, word_hashes

K = 128
SHINGLE = 5
BITS = 48


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The ``k`` smallest distinct values, ascending."""
    if len(hashes) > 8 * k:  # repeated shingles may fill the first cut
        cut = np.unique(np.partition(hashes, 4 * k)[:4 * k])
        if len(cut) >= k:
            return cut[:k]
    return np.unique(hashes)[:k]


def sketches(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    words, before = word_hashes(texts)
    return [bottom(shingle_hashes(words[before[i]:before[i + 1]], shingle) >> np.uint64(64 - BITS), k)
            for i in range(len(texts))]


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.hstack([np.zeros((len(raw), 2), np.uint8), raw]).view(">u8").ravel().astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def _known(a: np.ndarray, b: np.ndarray, k: int) -> tuple[int, int, int]:
    """Values of a, of b and of both in the range where both are complete."""
    tops = [s[-1] for s in (a, b) if len(s) >= k]
    if tops:
        a, b = a[:np.searchsorted(a, min(tops), "right")], b[:np.searchsorted(b, min(tops), "right")]
    if not len(a) or not len(b):
        return len(a), len(b), 0
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return len(a), len(b), int((a[at] == b).sum())


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated shared share of the union; two empty sets are alike."""
    n, m, both = _known(a, b, k)
    return both / (n + m - both) if n + m else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; an empty a is contained."""
    n, _, both = _known(a, b, k)
    return both / n if n else 1.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**BITS / float(a[-1] + 1)


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, distinct_shingles) of every row; a null text is
    empty and has the empty fingerprint."""
    small_batches(docs.sparkSession)

    def run(batches):
        for part in slices(batches, "text"):
            found = sketches(part.column("text"), k, shingle)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([to_text(s) for s in found]),
                 pa.array([distinct(s, k) for s in found])],
                names=["doc_id", "fingerprint", "distinct_shingles"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string, distinct_shingles double")


def merged(parts: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, fingerprint, distinct_shingles) of each key's united parts
    (columns ``key`` and ``fingerprint``). Every task first merges what it has
    of a key, so that a key of any size sends ``k`` values a task."""
    def fold(rows: pa.Table) -> np.ndarray:
        at = np.empty(0, np.uint64)
        for f in rows.column("fingerprint").to_pylist():
            at = merge(at, from_text(f), k) if f is not None else at
        return at

    def early(batches):
        held: dict = {}
        for batch in batches:
            for name, f in zip(batch.column("key").to_pylist(), batch.column("fingerprint").to_pylist()):
                if f is None:
                    continue
                held[name] = merge(held.get(name, np.empty(0, np.uint64)), from_text(f), k)
                if len(held) >= 50_000:
                    yield rows_of(held)
                    held = {}
        yield rows_of(held)

    def rows_of(held: dict):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                           pa.array([to_text(s) for s in held.values()], pa.string())],
                                          names=["key", "fingerprint"])

    def late(batches):
        for rows in groups(batches, "key"):
            s = fold(rows)
            yield pa.RecordBatch.from_arrays([rows.column("key")[:1].combine_chunks(), pa.array([to_text(s)]),
                                              pa.array([distinct(s, k)])],
                                             names=["key", "fingerprint", "distinct_shingles"])
    return (parts.select(F.col(key).cast("string").alias("key"), "fingerprint")
            .mapInArrow(early, "key string, fingerprint string")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(late, "key string, fingerprint string, distinct_shingles double")
            .withColumnRenamed("key", key))


def _blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the range block of their doc_id: the same in every job, as
    the edges are values and not one shuffle's sample. Null ids are block 0."""
    wanted = partitions(docs.sparkSession)
    edges = docs.approxQuantile("doc_id", [i / wanted for i in range(1, wanted)], 0.2 / wanted) if wanted > 1 else []
    edges = [-float("inf"), *sorted({0.0, *edges}), float("inf")]
    cut = Bucketizer(splits=edges, inputCol="place", outputCol="cut", handleInvalid="keep")
    out = (cut.transform(docs.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
           .withColumn("block", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("cut").cast("int") + 1)))
    return out.drop("place", "cut"), len(edges)


def _edited(k: int, shingle: int):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
               "near_edited", "near_next", "distinct_shingles", "kept_in_edited"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # the last row that still waits for the next one
        for part in slices(batches, "text", 2 << 20):
            rows = list(zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(),
                            sketches(part.column("text"), k, shingle), part.column("extra").to_pylist()))
            done = []
            for row in rows:
                if carried is not None:
                    done.append((carried, row))
                carried = None if row[3] else row
            if not done:
                continue
            edited = [a[1][:len(a[1]) - len(a[1]) // 2] + b[1][:len(a[1]) // 2] for a, b in done]
            after = sketches(pa.array(edited, pa.string()), k, shingle)
            values = [(a[0], len(a[1]), sha256(t.encode()).hexdigest(), to_text(a[2]), to_text(s),
                       resemblance(a[2], s, k), resemblance(a[2], b[2], k), distinct(a[2], k),
                       containment(a[2], s, k)) for (a, b), t, s in zip(done, edited, after)]
            yield pa.RecordBatch.from_arrays([pa.array(v) if n != "doc_id" else pa.array(v, pa.int64())
                                              for n, v in zip(columns, zip(*values))], names=columns)
    return run


def edit_likeness(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Each text's fingerprint beside that of its edited text, whose last
    floor(n_chars / 2) code points give way to the first as many of the next
    document's, in descending doc_id (after the last: the first).

    Null texts are empty. Rows of one doc_id follow each other by text, null
    ids come last; other columns are ignored; an empty table gives no rows.
    Rows are dealt out once, by range of doc_id; each range also gets the
    first row of the next one, so nobody waits for another task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranged, n = _blocks(texts)
    heads = ranged.groupBy("block").agg(F.max("doc_id").alias("doc_id")).orderBy(F.desc("block")).collect()
    follows = [(heads[(i + 1) % len(heads)]["doc_id"], h["block"]) for i, h in enumerate(heads)]
    heads = F.broadcast(spark.createDataFrame(follows, "head long, target int"))  # a row for each range
    extra = (texts.join(heads, F.col("doc_id").eqNullSafe(F.col("head")))
             .groupBy("target", "doc_id").agg(F.min("text").alias("text")))
    rows = (ranged.select("block", F.lit(False).alias("extra"), "doc_id", "text")
            .union(extra.select("target", F.lit(True), "doc_id", "text")))
    dealt = (rows.repartitionById(n + 1, "block")
             .sortWithinPartitions("block", "extra", F.desc_nulls_last("doc_id"), "text"))
    return dealt.mapInArrow(_edited(k, shingle), (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, distinct_shingles double, kept_in_edited double"))

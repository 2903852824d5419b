"""Phrase collocations by the stripes pattern.

A prefix keys an associative counter of what follows it. The stripe of a word
``w`` in a language holds ``{(next, after): f}``, with empty words at the
piece's end. Tasks count a few megabytes of text at a time and send one stripe
for each word, so a phrase that fills a third of the corpus is one entry of a
stripe; stripes of one word are then merged elementwise. Its sums are the
prefix totals f(w) and f(w next), its entries the extensions; their maxima say
which phrases a longer one subsumes.

A frequent word's stripe is no single task's work. Words that make up a
``SHARE``-th of the corpus or more (at most ``SHARE`` of them) are found by a
first count; a stripe of such a word is dealt out over as many parts as it has
shares, by the hash of ``next``, or of both words where ``next`` is frequent
too (then the pair itself has an entry, as its extensions lie in several
parts). So no part stands for more than about a share of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import small_batches, written

#: Bytes of text counted at once, and stripe entries merged at once.
CHUNK_BYTES = 8 << 20
CHUNK_ENTRIES = 1 << 19
#: Words of this share of the corpus are frequent: there are no more than so many.
SHARE = 20_000
#: Parts of a language whose first phrases are picked before they meet.
PARTS = 16

_BREAK, _BLANK = 0x0A, 0x20
_BYTES = bytearray(range(256))
for _b in range(ord("A"), ord("Z") + 1):
    _BYTES[_b] = _b + 32
for _b in b".,;:!?\x0a\x0b\x0c\x0d":
    _BYTES[_b] = _BREAK
_BYTES[0x09] = _BLANK
_BYTES = bytes(_BYTES)


@dataclass(frozen=True)
class Collocations:
    """Least count of a phrase, the share in percent of its count at which a
    longer candidate subsumes it, and phrases returned for each language."""

    least: int = 10
    subsumed: int = 50
    top: int = 2000


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _pieces(texts: list[bytes], limit: int) -> Iterator[np.ndarray]:
    """The texts' bytes, mapped to lower case, breaks and blanks, in parts of
    about ``limit`` bytes that end at a break."""
    held, size = [], 0
    for text in texts:
        mapped = text.translate(_BYTES)
        while size + len(mapped) > limit:
            cut = mapped.rfind(b"\n", 0, max(0, limit - size)) + 1
            if not cut and not size:  # a piece that is longer than the limit stays whole
                cut = mapped.find(b"\n", limit) + 1 or len(mapped)
            held.append(mapped[:cut])
            mapped = mapped[cut:]
            yield np.frombuffer(b"\n".join(held), np.uint8)
            held, size = [], 0
        held.append(mapped)
        size += len(mapped) + 1
    if size:
        yield np.frombuffer(b"\n".join(held), np.uint8)


def _words(raw: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words after an empty one, each word's number, its piece)."""
    breaks = raw == _BREAK
    gap = breaks | (raw == _BLANK)
    word = ~gap
    before, behind = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:], behind[:-1] = gap[:-1], gap[1:]
    starts = np.flatnonzero(word & before)
    lengths = np.flatnonzero(word & behind) + 1 - starts
    coded = _binary(raw[word], lengths).dictionary_encode()
    names = pa.concat_arrays([pa.array([b""], pa.large_binary()), coded.dictionary])
    return names, coded.indices.to_numpy().astype(np.int64) + 1, np.cumsum(breaks)[starts]


def _stripes(raw: np.ndarray, parts_of: dict[bytes, int]) -> tuple[pa.Array, np.ndarray, pa.Array, pa.Array] | None:
    """(first word, part, entries, counts) of each stripe of some pieces. An
    entry is ``next after`` with a line feed; ``parts_of`` has the frequent words."""
    names, ids, piece = _words(raw)
    if not len(ids):
        return None
    second, third = np.zeros_like(ids), np.zeros_like(ids)
    second[:-1] = np.where(piece[1:] == piece[:-1], ids[1:], 0)
    third[:-2] = np.where(piece[2:] == piece[:-2], ids[2:], 0)
    if len(names) < 1 << 21:
        triple, n = np.unique(ids << 42 | second << 21 | third, return_counts=True)
        one, two, three = triple >> 42, triple >> 21 & (1 << 21) - 1, triple & (1 << 21) - 1
    else:  # a pair's place stands for it
        pair, place = np.unique(ids * len(names) + second, return_inverse=True)
        triple, n = np.unique(place * len(names) + third, return_counts=True)
        one, three = np.divmod(pair[triple // len(names)], len(names))[0], triple % len(names)
        two = pair[triple // len(names)] % len(names)

    listed = names.to_pylist()
    parts = np.fromiter((parts_of.get(w, 1) for w in listed), np.int64, len(listed))
    both = (parts[one] > 1) & (parts[two] > 1)
    edge = np.flatnonzero((np.diff(one, prepend=-1) != 0) | (np.diff(two, prepend=-1) != 0))
    pairs, kept = edge[both[edge]], ~(both & (three == 0))
    n = np.concatenate([np.add.reduceat(n, edge)[both[edge]], n[kept]])
    code = np.fromiter(map(crc32, listed), np.int64, len(listed))
    spread = code[two] + np.where(both, 31 * code[three], 0)
    spread = np.concatenate([code[two[pairs]] + 31 * code[0], spread[kept]])
    one, two = np.concatenate([one[pairs], one[kept]]), np.concatenate([two[pairs], two[kept]])
    three = np.concatenate([np.zeros_like(pairs), three[kept]])

    stripe = one * (SHARE + 1) + spread % parts[one]
    order = np.argsort(stripe, kind="stable")
    stripe = stripe[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(stripe)) + 1, [len(stripe)]])
    big = lambda b: pa.scalar(b, pa.large_binary())
    entries = pc.binary_join_element_wise(names.take(pa.array(two[order])), names.take(pa.array(three[order])), big(b" "))
    entries = pc.binary_join_element_wise(entries, big(b""), big(b"\n"))
    _, offsets, data = entries.buffers()
    ends = np.frombuffer(offsets, np.int64)[:len(stripe) + 1][edges]
    blobs = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(ends.copy()), data])
    counts = _binary(n[order].astype("<u4").view(np.uint8), np.diff(edges) * 4)
    first = stripe[edges[:-1]]
    return names.take(pa.array(first // (SHARE + 1))), first % (SHARE + 1), blobs, counts


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """(lang, mapped bytes) in parts of about ``CHUNK_BYTES``."""
    texts, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            texts.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                for key, held in texts.items():
                    yield from ((key, raw) for raw in _pieces(held, CHUNK_BYTES))
                texts, size = {}, 0
    for key, held in texts.items():
        yield from ((key, raw) for raw in _pieces(held, CHUNK_BYTES))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of each chunk's words that make up a share of it, and
    the chunk's number of words (null word). A share of the corpus is one of
    some chunk, so none that is frequent is missed, only counted too low."""
    for lang, raw in _chunks(batches):
        names, ids, _ = _words(raw)
        n = np.bincount(ids, minlength=len(names))
        often = np.flatnonzero(n * SHARE >= max(1, len(ids)))
        often = often[n[often] > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(often) + 1), pa.string()),
             pa.array([None] + names.take(pa.array(often)).to_pylist(), pa.binary()),
             pa.array(np.concatenate([[len(ids)], n[often]]), pa.int64())], names=["lang", "word", "n"])


_STRIPE = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("part", pa.int32()),
                     ("entries", pa.binary()), ("counts", pa.binary())])


def _count(hot: dict[str, dict[bytes, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, raw in _chunks(batches):
            found = _stripes(raw, hot.get(lang, {}))
            if found is None:
                continue
            first, part, entries, counts = found
            for at in range(0, len(first), 20_000):
                cut = slice(at, at + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(first[cut]), pa.string()), first[cut].cast(pa.binary()),
                     pa.array(part[cut], pa.int32()), entries[cut].cast(pa.binary()),
                     counts[cut].cast(pa.binary())], schema=_STRIPE)
    return run


class _Merged:
    """Stripes being merged elementwise: (stripe number, entry, count), where
    equal entries of a stripe are united whenever the buffer is full."""

    def __init__(self):
        self.keys: list[tuple] = []
        self.parts: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        self.size = 0

    def add(self, key: tuple, entries: bytes, counts: bytes) -> None:
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
        self.parts.append((len(self.keys) - 1, entries, counts))
        self.size += len(counts) // 4

    def fold(self, held=None) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """All entries so far, each once for its stripe; ``held`` is an earlier fold."""
        raw = np.frombuffer(b"".join(e for _, e, _ in self.parts), np.uint8)
        n = np.frombuffer(b"".join(c for _, _, c in self.parts), "<u4").astype(np.int64)
        of = np.repeat([k for k, _, _ in self.parts], [len(c) // 4 for _, _, c in self.parts]).astype(np.int64)
        line = raw == _BREAK
        lengths = np.diff(np.flatnonzero(line), prepend=-1) - 1
        entries = _binary(raw[~line], lengths)
        if held is not None:
            of, n = np.concatenate([held[0], of]), np.concatenate([held[2], n])
            entries = pa.concat_arrays([held[1], entries])
        coded = entries.dictionary_encode()
        width = max(1, len(coded.dictionary))
        key, at = np.unique(of * width + coded.indices.to_numpy().astype(np.int64), return_inverse=True)
        total = np.bincount(at.ravel(), n, len(key)).astype(np.int64)
        return key // width, coded.dictionary.take(pa.array(key % width)), total


def _merge(least: int, hot: dict[str, dict[bytes, int]]):
    """(lang, first, next, after, n) of the pairs (``after`` is null) and
    triples that reach ``least``, and each stripe's part of the prefix total
    (``next`` is null there)."""
    schema = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("next", pa.binary()),
                        ("after", pa.binary()), ("n", pa.int64())])

    def halves(entries: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(next word, whether there is none after it) of each entry."""
        _, offsets, data = entries.buffers()
        edges = np.frombuffer(offsets, np.int64)[entries.offset:entries.offset + len(entries) + 1]
        raw = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]] if len(entries) else np.empty(0, np.uint8)
        edges = edges - edges[0]
        blank = np.flatnonzero(raw == _BLANK)
        step = np.zeros(len(raw) + 1, np.int8)
        step[edges[:-1]] += 1
        step[blank] -= 1
        return _binary(raw[np.cumsum(step[:-1]) > 0], blank - edges[:-1]), blank + 1 == edges[1:]

    def rows(keys: list, of: np.ndarray, entries: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        following, bare = halves(entries)
        coded = following.dictionary_encode()
        names, two = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        langs = {lang: k for k, lang in enumerate(dict.fromkeys(k[0] for k in keys))}
        lang = np.array([langs[k[0]] for k in keys])
        often = np.array([k[1] in hot.get(k[0], ()) for k in keys])
        table = np.array([[w in hot.get(name, ()) for w in names] if often[lang == k].any() else [False] * len(names)
                          for name, k in langs.items()], bool).reshape(len(langs), len(names))
        counted = bare | ~(often[of] & table[lang[of], two])  # frequent pairs have an entry of their own
        key, at = np.unique(of[counted] * len(names) + two[counted], return_inverse=True)
        pair = np.bincount(at.ravel(), n[counted], len(key)).astype(np.int64)
        totals = np.bincount(key // len(names), pair, len(keys)).astype(np.int64)
        has = np.flatnonzero(totals)
        named = np.fromiter(map(len, names), np.int64, len(names)) > 0
        pairs = np.flatnonzero((pair >= least) & named[key % len(names)])
        triples = np.flatnonzero((n >= least) & ~bare)
        split = [e.split(b" ") for e in entries.take(pa.array(triples)).to_pylist()]
        who = [keys[k] for k in np.concatenate([has, key[pairs] // len(names), of[triples]]).tolist()]
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in who], pa.string()), pa.array([k[1] for k in who], pa.binary()),
            pa.array([None] * len(has) + [names[k] for k in (key[pairs] % len(names)).tolist()] + [x for x, _ in split],
                     pa.binary()),
            pa.array([None] * (len(has) + len(pairs)) + [y for _, y in split], pa.binary()),
            pa.array(np.concatenate([totals[has], pair[pairs], n[triples]]), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = _Merged(), None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for lang, first, shard, entries, counts in zip(*columns):
                key = (lang, first, shard)
                if now.size >= CHUNK_ENTRIES:
                    held = now.fold(held)
                    if now.keys[-1] == key:  # the stripe goes on: keep what is merged of it
                        last = held[0] == len(now.keys) - 1
                        if len(now.keys) > 1:
                            yield rows(now.keys[:-1], held[0][~last], held[1].filter(pa.array(~last)), held[2][~last])
                        held = (np.zeros(int(last.sum()), np.int64), held[1].filter(pa.array(last)), held[2][last])
                    else:
                        yield rows(now.keys, *held)
                        held = None
                    now = _Merged()
                    if held is not None:
                        now.keys.append(key)
                now.add(key, entries, counts)
        if now.keys:
            yield rows(now.keys, *now.fold(held))
    return run


def phrase_counts(docs: DataFrame, least: int = 10) -> DataFrame:
    """(lang, first, next, after, n): the merged stripes of ``docs``. Rows
    with ``next`` are phrases of two words (``after`` null) or three that
    occur ``least`` times or more; the sum of the others is a word's count."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = rows.mapInArrow(_frequent, "lang string, word binary, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))
    counted = written(counted, "frequent")
    corpus = counted.where("word is null").agg(F.sum("n")).first()[0] or 0
    hot: dict[str, dict[bytes, int]] = {}
    for row in counted.where("word is not null").where(F.col("n") * SHARE >= 2 * corpus).collect():
        hot.setdefault(row["lang"], {})[bytes(row["word"])] = row["n"] * SHARE // corpus
    stripes = rows.mapInArrow(_count(hot), "lang string, first binary, part int, entries binary, counts binary")
    dealt = (stripes.repartition("lang", "first", "part")
             .sortWithinPartitions("lang", "first", "part"))
    merged = dealt.mapInArrow(_merge(least, hot), "lang string, first binary, next binary, after binary, n long")
    return merged.select("lang", *[F.col(c).cast("string").alias(c) for c in ("first", "next", "after")], "n")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in decimals, which hold counts up to 10**15."""
    wide = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)).cast("decimal(31,0)"),
                           wide(left) * wide(right)).cast("long")


def collocations(docs: DataFrame, how: Collocations = Collocations()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): for each language the phrases
    of two or three words that hold together best, by their weakest cut.

    A null text is empty and a null lang is ``und``; repeated rows count each
    time; columns other than ``text`` and ``lang`` are ignored; an empty
    table, or one without frequent phrases, gives no rows. Ties in score go
    by count, then by the phrase's bytes. A piece of text is a task's at once.
    """
    found = written(phrase_counts(docs, how.least), "stripes")
    words = written(found.where("next is null").groupBy("lang", F.col("first").alias("word"))
                    .agg(F.sum("n").alias("f")), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    two = found.where("next is not null and after is null").select("lang", "first", "next", F.col("n").alias("a"))
    three = found.where("after is not null").select("lang", "first", "next", "after", F.col("n").alias("a"))

    def count_of(key: str, name: str) -> DataFrame:
        return words.select("lang", F.col("word").alias(key), F.col("f").alias(name))

    def pair_of(one: str, other: str, name: str) -> DataFrame:
        return two.select("lang", F.col("first").alias(one), F.col("next").alias(other), F.col("a").alias(name))

    longer = (three.select("lang", "first", "next", "a")
              .union(three.select("lang", F.col("next"), F.col("after"), "a"))
              .groupBy("lang", "first", "next").agg(F.max("a").alias("longest")))
    short = (two.join(longer, ["lang", "first", "next"], "left")
             .where(f"longest is null or 100 * longest < {how.subsumed} * a")
             .join(count_of("first", "l"), ["lang", "first"]).join(count_of("next", "r"), ["lang", "next"])
             .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
             .select("lang", F.concat_ws(" ", "first", "next").alias("phrase"), "a", "l", "r", "score"))
    cut = (three.join(count_of("first", "l1"), ["lang", "first"])
           .join(pair_of("next", "after", "r1"), ["lang", "next", "after"])
           .join(pair_of("first", "next", "l2"), ["lang", "first", "next"])
           .join(count_of("after", "r2"), ["lang", "after"])
           .withColumn("s1", _score(F.col("a"), F.col("l1"), F.col("r1")))
           .withColumn("s2", _score(F.col("a"), F.col("l2"), F.col("r2"))))
    early = F.col("s1") <= F.col("s2")
    long = cut.select("lang", F.concat_ws(" ", "first", "next", "after").alias("phrase"), "a",
                      *[F.when(early, F.col(x)).otherwise(F.col(y)).alias(z)
                        for x, y, z in (("l1", "l2", "l"), ("r1", "r2", "r"), ("s1", "s2", "score"))])
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    some = (short.union(long).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= how.top))
    best = Window.partitionBy("lang").orderBy(*order)  # of a bounded number of rows for each language
    ranked = some.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= how.top)
    return (ranked.join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))

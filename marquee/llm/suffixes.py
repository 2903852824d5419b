"""Repeated byte strings by a common-prefix-aware distributed merge sort.

Every 400-byte string of a text has an anchor: of its first ``window`` places
the one whose 16 bytes hash lowest (the leftmost of equals). It depends on the
string alone, so equal strings have their anchors at the same distance. A text
falls into runs of starts that share an anchor, about one in 150 bytes, and
all strings of a run contain the bytes from the anchor on that every one of
them reaches, the run's core. Sorting needs the runs' suffixes at the anchor
(and, backwards, their prefixes) instead of every suffix of the corpus:

1. Duplicate detection, as a merge sort that sends distinguishing prefixes
   only does it first: cores are counted by hash. A core that occurs once holds
   no repeated string; one whose occurrences all have the same bytes repeats
   whole. Only cores with different surroundings (the ends of repeated
   passages) are sorted, one occurrence for each distinct surrounding.
2. Tasks sort these suffixes and the reversed prefixes, front-code the sorted
   runs (common prefix length and the rest) and send them by core.
3. A loser tree merges the runs. It keeps for every candidate the length it
   shares with the last winner, so known prefixes are never compared again,
   and leaves the lengths shared by neighbours.
4. Neighbours that share ``r`` bytes or more form an interval. A string that
   begins ``d`` bytes before the anchor repeats if another suffix of its
   interval for ``400 - d`` is also in its interval for ``d`` among the
   prefixes. No pair of suffixes is compared outside the merge.

A core with more than ``HOT`` different surroundings is not merged in one
task: its strings are counted one by one by their digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import groups, small_batches, written
from .words import mix

GRAM = 16                 # bytes whose hash makes an anchor
CHUNK_BYTES = 4 << 20     # bytes of text that are cut into runs at once
HELD_BYTES = 48 << 20     # bytes of suffixes that a task sorts at once
BUCKET_BYTES = 16 << 20   # bytes of suffixes that are merged at once, about
HOT = 1 << 16             # surroundings of a core that are merged in one task


@dataclass(frozen=True)
class Repeats:
    """Length in bytes from which a string counts as repeated, and the places
    at its beginning where its anchor may be."""

    length: int = 400
    window: int = 300

    @property
    def core(self) -> int:
        return self.length - self.window + 1


# --- runs of starts with one anchor -----------------------------------------

def _segments(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, start, bytes) of the texts in lists of about ``CHUNK_BYTES``; a
    longer text is cut into parts that share ``length - 1`` bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while len(text) - at >= length:
            part = text[at:at + CHUNK_BYTES + length - 1]
            held.append((i, at, part))
            size += len(part)
            at += CHUNK_BYTES
            if size >= CHUNK_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs_of(texts: list[bytes], how: Repeats) -> Iterator[tuple]:
    """(text, first start, anchor, last start, core hash, digest) arrays of the
    runs of each part of the texts."""
    for parts in _segments(texts, how.length):
        joined = b"".join(p for _, _, p in parts)
        raw = np.frombuffer(joined, np.uint8)
        sizes = np.array([len(p) for _, _, p in parts])
        begins = np.concatenate([[0], np.cumsum(sizes)])
        eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        gram = mix(mix(eight[:-8] + np.uint64(1)) + eight[8:])
        low = np.uint64(max(24, len(raw).bit_length()))
        place = np.arange(len(gram), dtype=np.uint64)
        least = _lowest((gram >> low << low) | place, how.window)
        of = np.repeat(np.arange(len(parts)), sizes)
        starts = np.flatnonzero(np.arange(len(least)) + how.length <= begins[of[:len(least)] + 1])
        anchor = (least[starts] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        # a place is the anchor of starts in one part only
        edge = np.flatnonzero(np.diff(anchor, prepend=-1))
        lo, hi = starts[edge], starts[np.concatenate([edge[1:], [len(starts)]]) - 1]
        anchor = anchor[edge]
        core = np.full(len(anchor), 7, np.uint64)
        for k in range(0, how.core - 7, 8):
            core = mix(core * np.uint64(31) + eight[anchor + k])
        core = mix(core * np.uint64(31) + eight[anchor + how.core - 8])
        digest = np.frombuffer(b"".join(
            blake2b(joined[s:e], digest_size=8).digest()
            for s, e in zip(lo.tolist(), (hi + how.length).tolist())), "<i8")
        part = of[lo]
        shift = np.array([at for _, at, _ in parts])[part] - begins[part]
        yield (np.array([i for i, _, _ in parts])[part], lo + shift, anchor + shift, hi + shift,
               core.view(np.int64), digest)


_RUNS = "k1 long, k2 long, lo long, a long, hi long, core long, digest long"


def _runs(how: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in (0, 1)]
            for which, *columns in runs_of(batch.column("text").cast(pa.binary()).to_pylist(), how):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[0][which]), pa.array(keys[1][which]), *map(pa.array, columns)],
                    names=["k1", "k2", "lo", "a", "hi", "core", "digest"])
    return run


# --- front-coded sorted runs and their merge --------------------------------

def shared(a: bytes, b: bytes, h: int) -> int:
    """Length of the common prefix of two strings that share ``h`` bytes."""
    n, step = min(len(a), len(b)), 16
    while h < n:
        x, y = a[h:min(h + step, n)], b[h:min(h + step, n)]
        if x != y:
            differs = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return h + len(x) - (differs.bit_length() + 7) // 8
        h += step
        step *= 2
    return n


def front_coded(ordered: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(bytes shared with the one before, further bytes, those bytes)."""
    same = np.zeros(len(ordered), np.uint16)
    for i in range(1, len(ordered)):
        same[i] = shared(ordered[i - 1], ordered[i], 0)
    rest = [s[h:] for s, h in zip(ordered, same.tolist())]
    return same, np.fromiter(map(len, rest), np.uint16, len(rest)), b"".join(rest)


def decoded(same: np.ndarray, more: np.ndarray, rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for h, m in zip(same.tolist(), more.tolist()):
        last = last[:h] + rest[at:at + m]
        at += m
        out.append(last)
    return out


def merged(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Order ((run, place) each) of sorted runs' strings, and the bytes that
    each shares with the one before it. A run is its strings and the bytes
    that each shares with the run's one before.

    A node of the loser tree holds the run that lost there; ``known`` is how
    much of a run's next string equals the last winner that beat it.
    """
    size = 1
    while size < len(runs):
        size *= 2
    strings = [s for s, _ in runs] + [[]] * (size - len(runs))
    lcps = [h for _, h in runs]
    at = [0] * size
    head = [s[0] if s else None for s in strings]
    known = [0] * size
    losers = [0] * size

    def contest(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); the loser learns what it shares with the winner."""
        a, b = head[i], head[j]
        if b is None:
            return i, j
        if a is None:
            return j, i
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        h = shared(a, b, known[i])
        if a[h:h + 1] <= b[h:h + 1]:
            known[j] = h
            return i, j
        known[i] = h
        return j, i

    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = contest(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    order, same = [], []
    while head[best] is not None:
        order.append((best, at[best]))
        same.append(known[best])
        at[best] += 1
        if at[best] < len(strings[best]):
            head[best] = strings[best][at[best]]
            known[best] = lcps[best][at[best]]
        else:
            head[best] = None
        node = (best + size) // 2
        while node:
            best, losers[node] = contest(best, losers[node])
            node //= 2
    return order, np.array(same, np.int64)


_SORTED = pa.schema([("bucket", pa.int64()), ("about", pa.binary())] + [
    (f"{side}_{part}", pa.binary()) for side in ("after", "before") for part in ("which", "same", "more", "rest")])
_ABOUT = np.dtype([("core", "<i8"), ("digest", "<i8"), ("n", "<i8"), ("least", "<i2"), ("most", "<i2")])


def _wanted(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[tuple[bytes, int, dict]]:
    """(bytes of the run, place of the anchor in them, run) of what is wanted
    of each text; rows of one text that follow each other count once."""
    last = None
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for i, (k1, k2) in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist())):
            if (k1, k2) == last:
                continue
            last = (k1, k2)
            text = texts[i].as_py()
            for run in batch.column("wanted")[i].as_py():
                yield text[run["lo"]:run["hi"] + how.length], run["a"] - run["lo"], run


def _sorted(how: Repeats, buckets: int):
    """Front-coded sorted runs of suffixes from the anchors on and of reversed
    prefixes, both after the core's hash, one row for each bucket of cores."""
    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for bucket, items in held.items():
            about = np.array([x[2] for x in items], _ABOUT)
            row = [pa.array([bucket], pa.int64()), pa.array([about.tobytes()], pa.binary())]
            for side in (0, 1):
                order = sorted(range(len(items)), key=lambda i: items[i][side])
                same, more, rest = front_coded([items[i][side] for i in order])
                row += [pa.array([x], pa.binary())
                        for x in (np.array(order, "<i4").tobytes(), same.tobytes(), more.tobytes(), rest)]
            yield pa.RecordBatch.from_arrays(row, schema=_SORTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for text, at, r in _wanted(batches, how):
            core = r["core"].to_bytes(8, "big", signed=True)
            held.setdefault(r["core"] % buckets, []).append(
                (core + text[at:], core + text[:at][::-1],
                 (r["core"], r["digest"], r["n"], r["a"] - r["hi"], r["a"] - r["lo"])))
            size += len(text) + 300
            if size >= HELD_BYTES:
                yield from flush(held)
                held, size = {}, 0
        yield from flush(held)
    return run


def _thinned(order: np.ndarray, same: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and shared lengths of the kept rows alone."""
    at = np.flatnonzero(keep[order])
    out = np.zeros(len(at), np.int64)
    if len(at) > 1:
        out[1:] = np.minimum.reduceat(same, at[:-1] + 1)[:len(at) - 1]
        for i in np.flatnonzero(np.diff(at) > 1).tolist():
            out[i + 1] = same[at[i] + 1:at[i + 1] + 1].min()
    return order[at], out


def repeated_places(about: np.ndarray, after: tuple, before: tuple, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each surrounding the least and the greatest distance before the
    anchor at which a repeated string begins (-1: none). ``after`` and
    ``before`` are (order, bytes shared with the one before it, core's hash
    included) of the suffixes and of the reversed prefixes."""
    n = len(about)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    twice = about["n"] > 1
    low[twice], high[twice] = about["least"][twice], about["most"][twice]
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int(about["least"].min()), int(about["most"].max()) + 1):
        active = np.flatnonzero((about["least"] <= d) & (d <= about["most"]))
        right[after[0]] = np.cumsum(after[1] < length - d + 8)
        left[before[0]] = np.cumsum(before[1] < d + 8)
        key = right[active] * (n + 1) + left[active]
        order = np.argsort(key, kind="stable")
        equal = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        if len(equal):
            hit = active[np.unique(np.concatenate([order[equal], order[equal + 1]]))]
            low[hit[low[hit] < 0]] = d
            high[hit] = np.maximum(high[hit], d)
    return low, high


def _merge_buckets(how: Repeats):
    def side(rows: list[dict], name: str, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        runs, which = [], []
        for row in rows:
            same = np.frombuffer(row[f"{name}_same"], np.uint16)
            runs.append((decoded(same, np.frombuffer(row[f"{name}_more"], np.uint16), row[f"{name}_rest"]),
                         same.tolist()))
            which.append(np.frombuffer(row[f"{name}_which"], "<i4"))
        order, same = merged(runs)
        return np.array([firsts[r] + which[r][i] for r, i in order], np.int64), same

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "bucket"):
            rows = table.to_pylist()
            parts = [np.frombuffer(r["about"], _ABOUT) for r in rows]
            firsts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            about = np.concatenate(parts)
            keep = np.zeros(len(about), bool)
            keep[np.unique(about[["core", "digest"]], return_index=True)[1]] = True
            place = np.cumsum(keep) - 1
            sides = []
            for name in ("after", "before"):
                order, same = _thinned(*side(rows, name, firsts), keep)
                sides.append((place[order], same))
            about = about[keep]
            low, high = repeated_places(about, *sides, how.length)
            found = np.flatnonzero(low >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(about["core"][found]), pa.array(about["digest"][found]),
                 pa.array(low[found]), pa.array(high[found])], names=["core", "digest", "low", "high"])
    return run


def _strings(how: Repeats):
    """Every string of the wanted runs, by its digest."""
    names = ["s1", "s2", "core", "digest", "n", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, at, r in _wanted(batches, how):
            places = range(len(text) - how.length + 1)
            s = np.frombuffer(b"".join(blake2b(text[p:p + how.length], digest_size=16).digest() for p in places), "<i8")
            fixed = [pa.array(np.full(len(places), r[c])) for c in ("core", "digest", "n")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[::2]), pa.array(s[1::2]), *fixed, pa.array(at - np.arange(len(places)))], names=names)
    return run


# --- the operator ------------------------------------------------------------

def _keyed(docs: DataFrame, *columns: Column) -> DataFrame:
    """Texts with a 128-bit key of their bytes: equal texts are one."""
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *columns)
    return rows.select(F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text",
                       *[c for c in rows.columns if c != "text"])


def _verdicts(texts: DataFrame, mixed: DataFrame, how: Repeats) -> DataFrame:
    """(core, digest, low, high) of the surroundings of mixed cores in which a
    string repeats: the distances before the anchor where the outer ones begin."""
    spark = texts.sparkSession
    classes = mixed.groupBy("core", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "lo", "a", "hi")).alias("one"))
    classes = classes.select("one.*", "core", "digest", "n")
    kinds = classes.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
    classes = written(classes.join(kinds, "core"), "classes")
    size = classes.where(f"kinds <= {HOT}").agg(F.sum(F.col("hi") - F.col("lo") + how.length + 24)).first()[0] or 0
    wanted = lambda which: texts.join(
        classes.where(which).groupBy("k1", "k2").agg(F.collect_list(
            F.struct("lo", "a", "hi", "core", "digest", "n")).alias("wanted")), ["k1", "k2"]).select(
        "k1", "k2", "text", "wanted")
    buckets = 1 + size // BUCKET_BYTES
    spread = f"bucket long, {', '.join(f'{f.name} binary' for f in _SORTED if f.name != 'bucket')}"
    found = (wanted(f"kinds <= {HOT}").mapInArrow(_sorted(how, buckets), spread)
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_merge_buckets(how), "core long, digest long, low long, high long"))
    if classes.where(f"kinds > {HOT}").isEmpty():
        return found
    single = written(wanted(f"kinds > {HOT}").mapInArrow(
        _strings(how), "s1 long, s2 long, core long, digest long, n long, d long").distinct(), "strings")
    several = single.groupBy("s1", "s2").agg(F.sum("n").alias("m")).where("m > 1")
    return found.union(single.join(several, ["s1", "s2"]).groupBy("core", "digest")
                       .agg(F.min("d").alias("low"), F.max("d").alias("high")))


def repeated_spans(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(doc_id, text, spans) of every row: spans are the byte ranges (start,
    end) of the text's UTF-8 that repeated strings cover, in no order and with
    overlaps; null where there are none.

    A string repeats if it also starts anywhere else, in the same text or
    another. A null text is empty; rows with one text repeat each other, also
    with equal or null doc_id; other columns are ignored; an empty table gives
    no rows.
    """
    small_batches(docs.sparkSession)
    texts = _keyed(docs, F.col("doc_id").cast("long").alias("doc_id"))
    runs = written(texts.select("k1", "k2", "text").where(F.octet_length("text") >= how.length)
                   .mapInArrow(_runs(how), _RUNS), "runs")
    cores = written(runs.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("d1"),
                                             F.max("digest").alias("d2"))
                    .where("n > 1").select("core", (F.col("d1") != F.col("d2")).alias("mixed")), "cores")
    again = written(runs.join(cores, "core"), "shared")
    mixed = again.where("mixed")
    ends = written(_verdicts(texts, mixed, how), "verdicts")
    span = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    whole = again.where("not mixed").select("k1", "k2", span(F.col("lo"), F.col("hi") + how.length).alias("span"))
    parts = mixed.join(ends, ["core", "digest"]).select(
        "k1", "k2", span(F.col("a") - F.col("high"), F.col("a") - F.col("low") + how.length).alias("span"))
    spans = whole.union(parts).groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"))
    return texts.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")


def _cut(keep_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, spans in zip(batch.column("doc_id").to_pylist(),
                                        batch.column("text").cast(pa.binary()).to_pylist(),
                                        batch.column("spans").to_pylist()):
                merged_spans, kept, at = [], [], 0
                for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged_spans and start <= merged_spans[-1][1]:
                        merged_spans[-1][1] = max(merged_spans[-1][1], end)
                    else:
                        merged_spans.append([start, end])
                for start, end in merged_spans:
                    kept.append(text[at:start])
                    at = end
                kept.append(text[at:])
                left = b"".join(kept)
                rows.append((doc, len(text), len(text) - len(left), len(merged_spans), sha256(left).hexdigest(), left))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(columns[k], types[k]) for k in range(len(names))], names=names)
    return run


def without_repeats(docs: DataFrame, how: Repeats = Repeats(), keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, with ``keep_text``
    also kept): every row's UTF-8 bytes without :func:`repeated_spans`."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeated_spans(docs, how).mapInArrow(_cut(keep_text), schema + (", kept binary" if keep_text else ""))

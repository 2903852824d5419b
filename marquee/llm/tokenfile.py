"""Token ids in bit-packed files.

A file holds, in this order (integers little-endian, 64 bits unless said):

* ``IDPACK1\\n``, then bits of an id (8 bits) and ids of a block (32 bits);
* the ids, each in ``bits`` bits, first bit first, in blocks of ``BLOCK`` ids;
  a block starts on a byte;
* the offset of every block, then doc_id and number of ids of every document;
* the number of blocks, of documents and of ids, and ``IDPACK1\\n`` again.

Any id is found from its number alone: block ``n // BLOCK``, and inside it a
fixed number of bits from the start, so ranges unpack with numpy.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.session import scratch_path

from .frames import partitions, small_batches, written
from .units import ColumnUnits
from .words import gathered, text_buffers

MAGIC = b"IDPACK1\n"
BLOCK = 65_536
HEAD = len(MAGIC) + 5
TAIL = 24 + len(MAGIC)
MOST_UNITS = 400_000  # kept by a worker before it drops the rare ones
MOST_PIECES = 100     # units that the library encodes in one call
NO_DOC = -(1 << 63)  # stands for a null doc_id in a file


def bits_for(vocabulary: int) -> int:
    """Least bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits(((ids.astype(np.uint32)[:, None] >> shifts) & 1).astype(np.uint8)).tobytes()


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f">u{bits // 8}", count).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(raw, np.uint8), count=count * bits).reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits:] = each
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (a bare path is a local one)."""
    if re.match(r"file:/+", path) or "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


class Writer:
    """Writes one file; it appears under its name when it is complete."""

    def __init__(self, path: str, bits: int):
        self.fs, self.path = store(path)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.out.write(MAGIC + struct.pack("<BI", bits, BLOCK))
        self.bits, self.at, self.offsets, self.held, self.n_held = bits, HEAD, [], [], 0
        self.docs: list[int] = []
        self.counts: list[int] = []

    def add(self, docs: list[int | None], counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs += [NO_DOC if d is None else d for d in docs]
        self.counts += counts.tolist()
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            every = np.concatenate(self.held)
            full = len(every) // BLOCK * BLOCK
            for a in range(0, full, BLOCK):
                self._block(every[a:a + BLOCK])
            self.held, self.n_held = [every[full:]], len(every) - full

    def _block(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> int:
        if self.n_held:
            self._block(np.concatenate(self.held))
        total = sum(self.counts)
        self.out.write(np.array(self.offsets, "<u8").tobytes() + np.array(self.docs, "<i8").tobytes()
                       + np.array(self.counts, "<u8").tobytes()
                       + struct.pack("<QQQ", len(self.offsets), len(self.docs), total) + MAGIC)
        self.out.close()
        self.fs.move(self.part, self.path)
        return total


class Reader:
    """Random access to one file."""

    def __init__(self, path: str):
        system, name = store(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        n_blocks, n_docs, self.total = struct.unpack("<QQQ", self._at(size - TAIL, 24))
        if self._at(size - len(MAGIC), len(MAGIC)) != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no complete file of packed ids")
        self.bits, self.block = struct.unpack("<BI", self._at(len(MAGIC), 5))
        index = size - TAIL - 8 * n_blocks - 16 * n_docs
        self.offsets = np.frombuffer(self._at(index, 8 * n_blocks), "<u8")
        self.docs = np.frombuffer(self._at(index + 8 * n_blocks, 8 * n_docs), "<i8")
        self.counts = np.frombuffer(self._at(index + 8 * n_blocks + 8 * n_docs, 8 * n_docs), "<u8").astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def _at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset) if length else b""

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the file, reading their blocks only."""
        out = []
        while count > 0:
            b, skip = divmod(start, self.block)
            take = min(count, self.block - skip)
            first = skip * self.bits // 8
            lead = skip * self.bits - first * 8  # bits of the id before, in the same byte
            raw = self._at(int(self.offsets[b]) + first, (lead + take * self.bits + 7) // 8)
            if lead:
                bits = np.unpackbits(np.frombuffer(raw, np.uint8))[lead:lead + take * self.bits]
                raw = np.packbits(bits).tobytes()
            out.append(unpack(raw, self.bits, take))
            start, count = start + take, count - take
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document's number, first id's number, ids), some ids at a time."""
        i = 0
        while i < len(self.docs):
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + at_once)))
            every = self.ids(int(self.starts[i]), int(self.counts[i:j].sum()))
            for k in range(i, j):
                a = int(self.starts[k] - self.starts[i])
                yield k, int(self.starts[k]), every[a:a + int(self.counts[k])]
            i = j


# -- byte-level BPE through the tokenizers library -------------------------------

#: Characters of Unicode's White_Space, by which the tokenizer's pattern splits.
_OTHER = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = r"\t-\r " + _OTHER
_WHITE = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
#: A text in which single blanks and line breaks are all the white space, each
#: between two other characters, splits at them alone.
_UNEVEN = re.compile(rf"[{_SPACE}](?:[{_SPACE}]|\Z)|\A[{_SPACE}]|[\t\x0b-\r{_OTHER}]")
_UNITS = re.compile(rf"[{_SPACE}]+(?![^{_SPACE}])| ?[^{_SPACE}]+|[{_SPACE}]")


def units_of(text: str) -> list[str]:
    """Runs of the text between which the tokenizer's pattern always splits:
    a word with the blank before it, or white space before such a run."""
    if not text:
        return []
    if _UNEVEN.search(text):
        return _UNITS.findall(text)
    out: list[str] = []
    for line in text.split("\n"):
        first, *rest = line.split(" ")
        if out:
            out.append("\n")
        out.append(first)
        out += [" " + w for w in rest]
    return out


def even_rows(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts (as UTF-8) have no white space but single blanks and line
    breaks, each between two other characters. Texts with other characters
    that may be white space count as uneven."""
    n = len(raw)
    white = (raw == 0x20) | (raw == 0x0A)
    odd = (raw >= 0x09) & (raw <= 0x0D) & (raw != 0x0A)
    odd[1:] |= white[1:] & white[:-1]
    lead = np.flatnonzero((raw == 0xC2) | (raw >= 0xE1) & (raw <= 0xE3))
    if len(lead):
        second = raw[np.minimum(lead + 1, n - 1)].astype(np.int64)
        third = raw[np.minimum(lead + 2, n - 1)].astype(np.int64)
        point = np.where(raw[lead] == 0xC2, second, (raw[lead].astype(np.int64) & 15) << 12 | (second & 63) << 6 | third & 63)
        odd[lead[np.isin(point, _WHITE)]] = True
    full = np.flatnonzero(off[1:] > off[:-1])
    first, last = off[full], off[full + 1] - 1
    out = np.ones(len(off) - 1, bool)
    out[full] = ~(white[first] | white[last])
    out[np.searchsorted(off, np.flatnonzero(odd), "right") - 1] = False
    return out


_MARK = np.isin(np.arange(256), list(b".,;:!?%&$#*"))
_ASCII_LETTER = np.isin(np.arange(256), [*range(0x41, 0x5B), *range(0x61, 0x7B)])


def _unit_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the units of even texts begin: at a text, a blank, a line break
    and behind it, and at a mark behind a letter, as the pattern ends any
    piece with a letter there. Letters are those of ASCII and U+00C0 to U+023F."""
    cut = (raw == 0x20) | (raw == 0x0A)
    cut[1:] |= raw[:-1] == 0x0A
    cut[off[:-1][off[1:] > off[:-1]]] = True
    marks = np.flatnonzero(_MARK[raw])
    marks = marks[marks >= 2]
    last, lead = raw[marks - 1], raw[marks - 2]
    wide = (lead >= 0xC3) & (lead <= 0xC8) & (last >= 0x80) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    cut[marks[_ASCII_LETTER[last] | wide]] = True
    return np.flatnonzero(cut)


def _plain(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which units (none empty) may be joined by line breaks: those without
    white space but one blank before other characters, and without those
    characters beyond Latin of whose classes two Unicode versions may differ."""
    odd = (raw >= 0x09) & (raw <= 0x0D) | (raw >= 0x1C) & (raw <= 0x20) | (raw >= 0xC9)
    odd[1:] |= (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
    odd[off[:-1][(raw[off[:-1]] == 0x20) & (np.diff(off) > 1)]] = False
    return ~np.logical_or.reduceat(odd, off[:-1])


def _woven(which: np.ndarray, lengths: np.ndarray, those: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Ids of rows in order, from those of the marked rows and of the others."""
    of = np.repeat(which, lengths)
    every = np.empty(len(of), np.int32)
    every[of], every[~of] = those, others
    return every


class ByteBpe:
    """Ids of texts as ``tokenizers`` gives them, each distinct unit encoded once.

    The library gets new units many at a time, a line break behind each: its
    pattern makes that a piece, and so a token, of its own, at which the ids are
    cut again. Units that are not plain go through the library alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"]
        if (steps["type"], steps["add_prefix_space"], steps.get("use_regex", True)) != ("ByteLevel", False, True) \
                or spec["normalizer"]:
            raise ValueError("only plain byte-level tokenizers split at blanks")
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.edge = self._encode("\n")
        self.joins = len(self.edge) == 1 and not any("\n" in a for a in self.added)
        self.units = ColumnUnits(self._new, MOST_UNITS)

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each unit's) of some plain units."""
        ids = np.array(self._encode("\n".join(units) + "\n"), np.int32)
        edge = ids == self.edge[0]
        counts = np.diff(np.flatnonzero(edge), prepend=-1) - 1
        if len(counts) == len(units):
            return ids[~edge], counts
        alone = [self._encode(u) for u in units]
        return np.fromiter(chain.from_iterable(alone), np.int32), np.array([*map(len, alone)], np.int64)

    def _new(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each unit's)."""
        plain = _plain(*text_buffers(units)) if self.joins else np.zeros(len(units), bool)
        lengths = np.empty(len(units), np.int64)
        names = units.filter(pa.array(plain)).to_pylist()
        joined, counts = [], []
        for k in range(0, len(names), MOST_PIECES):
            ids, n = self._joined(names[k:k + MOST_PIECES])
            joined.append(ids)
            counts.append(n)
        alone = [self._encode(u) for u in units.filter(pa.array(~plain)).to_pylist()]
        lengths[plain] = np.concatenate(counts) if counts else 0
        lengths[~plain] = np.fromiter(map(len, alone), np.int64, len(alone))
        return _woven(plain, lengths, np.concatenate(joined) if joined else np.empty(0, np.int32),
                      np.fromiter(chain.from_iterable(alone), np.int32)), lengths

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, bounds of each text's) of a string column. Texts whose
        white space is even are cut into units as bytes, and only new
        units become Python strings."""
        raw, off = text_buffers(texts)
        even = even_rows(raw, off)
        if self.added and any(a.encode() in raw.tobytes() for a in self.added):
            even &= ~np.array([any(a in (t or "") for a in self.added) for t in texts.to_pylist()])
        others = np.flatnonzero(~even)
        if len(others):
            loose, loose_bounds = self.encode([t or "" for t in texts.take(pa.array(others)).to_pylist()])
            raw, off = text_buffers(texts.take(pa.array(np.flatnonzero(even))))
        starts = _unit_starts(raw, off)
        coded = pa.Array.from_buffers(
            pa.large_string(), len(starts),
            [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
        ).dictionary_encode()
        ids, ends = self.units.gather(self.units.number(coded.dictionary)[coded.indices.to_numpy()])
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, off)]
        if not len(others):
            return ids, bounds
        lengths = np.empty(len(texts), np.int64)
        lengths[even], lengths[others] = np.diff(bounds), np.diff(loose_bounds)
        return _woven(even, lengths, ids, loose), np.concatenate([[0], np.cumsum(lengths)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, bounds of each text's)."""
        whole = [bool(self.added) and any(a in t for a in self.added) for t in texts]
        if not any(whole):
            return self.units.encode([units_of(t) for t in texts])
        parts = [np.array(self._encode(t), np.int32) if w else self.units.encode([units_of(t)])[0]
                 for t, w in zip(texts, whole)]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


_LOADED: dict[str, ByteBpe] = {}


def _loaded(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> DataFrame:
    """Writes the ids of all texts, each ended by ``end_id``, to files in
    ``folder``, in ascending doc_id order over files and inside them. Returns
    the manifest: (path, shard, n_docs, n_ids), a row for each file.

    Null texts are empty (the end id alone); null doc_ids come first; rows of
    one doc_id follow by text. An empty table writes no file. A file's name
    is its task's place in the order, and it appears when it is complete, so
    a task that runs again replaces its own file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = (texts.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, coder = TaskContext.get().partitionId(), None, _loaded(tokenizer)
        path = f"{folder}/ids-{shard:07d}.bin"
        for part in gathered(batches, "text", 4 << 20):
            if out is None:
                out = Writer(path, bits_for(max(coder.size, end_id + 1)))
            ids, bounds = coder.encode_column(part.column("text"))
            ids = np.insert(ids, bounds[1:], end_id)
            out.add(part.column("doc_id").to_pylist(), np.diff(bounds) + 1, ids)
        if out is not None:
            n = len(out.docs)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([shard], pa.int64()),
                                              pa.array([n], pa.int64()), pa.array([out.close()], pa.int64())],
                                             names=["path", "shard", "n_docs", "n_ids"])
    return written(ordered.mapInArrow(run, "path string, shard long, n_docs long, n_ids long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files: a
    task reads a file, a million ids at a time. ``start`` is the number of
    ids of all documents before it; the prefix sum runs over a row per file."""
    spark = manifest.sparkSession
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    files = files.withColumn("place", (F.row_number().over(Window.orderBy("shard")) - 1).cast("int"))
    n = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                rows, reader = [], Reader(path)
                for k, start, ids in reader.documents():
                    doc = int(reader.docs[k])
                    rows.append((None if doc == NO_DOC else doc, before + start, len(ids),
                                 crc32(ids.astype("<u4").tobytes())))
                    if len(rows) >= 5000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    def _rows(rows):
        return pa.RecordBatch.from_pylist(
            [dict(zip(("doc_id", "start", "n_tokens", "ids_crc32"), r)) for r in rows],
            schema=pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]))
    return (files.select("path", "before", "place").repartitionById(n, "place").select("path", "before")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """:func:`write` to a fresh shared folder, then :func:`read`."""
    spark: SparkSession = docs.sparkSession
    return read(write(docs, tokenizer, scratch_path(spark, "ids"), end_id))

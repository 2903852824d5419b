"""Word and shingle hashes of Arrow text batches, in numpy.

Words are runs of bytes other than blank and the five ASCII controls from tab
to carriage return, with A-Z lower-cased; the rule looks at ASCII bytes only,
so it works on UTF-8 without decoding. A word's hash is a polynomial over its
bytes modulo 2**64, read off prefix sums, then mixed; no Python runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text is cut between words.
#: Hashing takes some 40 bytes of memory for each, and tables of 16 that stay.
CHUNK_BYTES = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII byte but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LOWER += np.uint64(1)

_BASE = 0x9E3779B97F4A7C55 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_ORDER = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has length 0."""
    if pa.types.is_large_string(column.type) or column.null_count:
        column = column.cast(pa.large_string()).fill_null("")
        width = np.int64
    else:
        width = np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, off - off[0]


def give_back() -> None:
    """Freed memory goes back to the system: a worker lives on after its task,
    and what one operator needed for a while is room for the next one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text (one
    row at least), which bounds what a task works on at once."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffers(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
    give_back()


def gathered(batches: Iterator[pa.RecordBatch], column: str,
             limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut and put together so that each holds about ``limit``
    bytes of text (one row at least)."""
    held, size = [], 0
    for part in slices(batches, column, limit):
        held.append(part)
        size += part.column(column).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _hash_chunk(raw: np.ndarray, edges: np.ndarray,
                gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    power, inverse = _power_tables(n)
    blank = gaps[raw]
    cut = np.zeros(n + 1, bool)
    cut[edges] = True
    cut[0] = cut[n] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = blank[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = blank[1:]
    word = ~blank
    starts = np.flatnonzero(word & (before | cut[:-1]))
    ends = np.flatnonzero(word & (after | cut[1:]))
    sums = np.cumsum(_LOWER[raw] * power[:n])
    first = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    h = (sums[ends] - first) * inverse[starts]
    return mix(h + (ends - starts + 1).astype(np.uint64) * _ORDER[0]), starts


def word_hashes(column: pa.Array, gaps: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each row): row ``i`` holds the words
    ``hashes[before[i]:before[i + 1]]``. ``gaps`` marks the bytes between words."""
    raw, off = text_buffers(column)
    hashes, places, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK_BYTES)
        if end < len(raw):  # never inside a word: back to a blank or a row edge
            edge = off[np.searchsorted(off, end, "right") - 1]
            found = np.flatnonzero(gaps[raw[max(at, edge):end]])
            if len(found):
                end = max(at, int(edge)) + int(found[-1]) + 1
            elif edge > at:
                end = int(edge)
            else:
                rest = np.flatnonzero(gaps[raw[end:]])
                row_end = int(off[np.searchsorted(off, at, "right")])
                end = min(row_end, end + int(rest[0]) + 1 if len(rest) else len(raw))
        inside = off[(off >= at) & (off <= end)] - at
        h, starts = _hash_chunk(raw[at:end], inside, gaps)
        hashes.append(h)
        places.append(starts + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    place = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(place, off)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter text is one shingle, an
    empty one has none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = h * _ORDER[1] + (words[k:k + n] ^ _ORDER[4])
    return mix(h)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    return np.unique(shingle_hashes(words, size))

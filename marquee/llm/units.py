"""Token ids of texts from a growing table of distinct units.

A tokenizer that never merges across a unit's edge (a word with the blank
before it) needs to encode each distinct unit once. ``Units`` keeps the units
seen so far, their ids in one flat array, and turns a text into ids by looking
its units up and gathering, without Python work per id. A full table drops the
units that only one batch asked for, most of all there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct units kept by a worker; beyond it only common ones stay, half as many at most.
MOST_UNITS = 500_000


class _Numbers(dict):
    """Number of a unit; a new one gets the next number."""

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        return n


class Units:
    """``encode_new(units)`` gives the id lists of units not seen before."""

    def __init__(self, encode_new: Callable[[list[str]], Iterable[list[int]]], most: int = MOST_UNITS):
        self.encode_new = encode_new
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.known = 0
        self.flat = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.asked = np.zeros(1 << 14, np.int32)  # batches that asked for a unit
        self.used = 0

    def _thin(self) -> None:
        """Keep the units that two batches or more asked for, the commonest ones."""
        asked = self.asked[:self.known]
        least = 2
        while np.count_nonzero(asked >= least) > self.most // 2:
            least *= 2
        keep = asked >= least
        kept = np.flatnonzero(keep)
        names = list(compress(self.numbers, keep))
        flat, ends = self.gather(kept)
        self.clear()
        self.numbers.update(zip(names, range(len(names))))
        self._room(len(flat), len(names))
        self.flat[:len(flat)] = flat
        self.starts[1:len(names) + 1] = ends
        self.asked[:len(names)] = asked[kept]
        self.used, self.known = len(flat), len(names)

    def _room(self, ids: int, units: int) -> None:
        while ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while units + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.asked = np.concatenate([self.asked, np.zeros_like(self.asked)])

    def _learn(self) -> None:
        """Encode the units that got a number since the last time."""
        if self.known == len(self.numbers):
            return
        names = list(islice(reversed(self.numbers), len(self.numbers) - self.known))[::-1]
        lists = list(self.encode_new(names))
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        total = int(lengths.sum())
        self._room(self.used + total, len(self.numbers))
        if total:
            self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(lists), np.int32, total)
        self.starts[self.known + 1:len(self.numbers) + 1] = self.used + np.cumsum(lengths)
        self.used += total
        self.known = len(self.numbers)

    def number(self, units: Iterable[str], n: int) -> np.ndarray:
        """Numbers of ``n`` units, all of them learned; they hold until the next call."""
        if len(self.numbers) > self.most:
            self._thin()
        which = np.fromiter(map(self.numbers.__getitem__, units), np.int64, n)
        self._learn()
        self.asked[which] += 1
        return which

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of numbered units in a row, how many there are up to each unit's end)."""
        first = self.starts[which]
        lengths = self.starts[which + 1] - first
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(first - (ends - lengths), lengths) + np.arange(total)], ends

    def encode(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids begin and end) of
        texts that are given as their units."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ids, ends = self.gather(self.number(chain.from_iterable(texts), int(sizes.sum())))
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]


class ColumnUnits(Units):
    """:class:`Units` of Arrow columns. The known units are a column too, in the
    order of their numbers, which takes a tenth of a dict's memory, and only new
    units become Python objects: ``encode_new(column)`` gives (all ids, number
    of each unit's)."""

    def clear(self) -> None:
        super().clear()
        self.names = pa.array([], pa.large_string())

    def _add(self, names: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        end = self.known + len(names)
        self._room(self.used + len(ids), end)
        self.flat[self.used:self.used + len(ids)] = ids
        self.starts[self.known + 1:end + 1] = self.used + np.cumsum(lengths)
        self.names = pa.concat_arrays([self.names, names])
        self.used, self.known = self.used + len(ids), end

    def _thin(self) -> None:
        asked = self.asked[:self.known]
        least = 2
        while np.count_nonzero(asked >= least) > self.most // 2:
            least *= 2
        kept = np.flatnonzero(asked >= least)
        names, asked = self.names.take(pa.array(kept)), asked[kept]
        ids, ends = self.gather(kept)
        self.clear()
        self._add(names, ids, np.diff(ends, prepend=0))
        self.asked[:len(kept)] = asked

    def number(self, units: pa.Array) -> np.ndarray:
        """Numbers of distinct units, all of them learned; they hold until the next call."""
        if self.known > self.most:
            self._thin()
        which = pc.index_in(units, value_set=self.names).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(which < 0)
        if len(new):
            names = units.take(pa.array(new))
            which[new] = self.known + np.arange(len(new))
            self._add(names, *self.encode_new(names))
        self.asked[which] += 1
        return which

    def encode(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        coded = pa.array(list(chain.from_iterable(texts)), pa.large_string()).dictionary_encode()
        ids, ends = self.gather(self.number(coded.dictionary)[coded.indices.to_numpy()])
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]

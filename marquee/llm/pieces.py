"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text is split into marked words (runs of the blank mark followed by other
characters): no piece crosses their edges, so each distinct word is encoded
once. The distinct words of a batch are sorted, which is a trie in depth-first
order: a word keeps the forward states of the prefix it shares with the word
before it, and only the rest is worked out.

The forward state of a prefix is the last piece of its best path. In a unigram
model that is the path of the greatest score sum. In a BPE model the path is
the one the merges make; a piece can end it exactly if the merges, applied to
the two last pieces' characters alone, keep the two apart, so one last piece
is right for each prefix and is found from the states before it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import small_batches
from .units import Units
from .words import gathered, text_buffers

MARK = "▁"
MOST_UNITS = 500_000  # distinct marked words that a worker keeps
PAIRS = 400_000  # remembered verdicts on pairs of pieces
_NONE = float("-inf")


class Pieces:
    """A SentencePiece model's vocabulary with our own encoder and decoder."""

    def __init__(self, model_file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bpe = self._is_bpe(model_file)
        self.byte = {int(names[i][1:-1], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_ids = set(self.byte.values())
        self.special = {i for i in range(size) if model.is_control(i)}
        self.unknown = model.unk_id()
        self.names = names
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.ids = {names[i]: i for i in normal}
        self.scores = {names[i]: model.get_score(i) for i in normal}
        self.own = {p: p for p in self.ids}  # one string for each piece that is remembered
        self.longest = max(map(len, self.ids), default=1)
        self.endings = self._endings()
        self.floor = min(self.scores.values(), default=0.0) - 10.0
        self.value = {i: self._bytes(names[i], i) for i in range(size)}
        crossing = [p for p in self.ids if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross word edges, for example {crossing[0]!r}")
        self.lines = all("\n" not in p for p in self.ids)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.flat = self.starts = None  # all pieces' bytes, made when first decoded

    @staticmethod
    def _is_bpe(model_file: str) -> bool:
        """The trainer's model type, from the library's own description."""
        from sentencepiece import sentencepiece_model_pb2 as proto
        spec = proto.ModelProto()
        with open(model_file, "rb") as f:
            spec.ParseFromString(f.read())
        return spec.trainer_spec.model_type == proto.TrainerSpec.BPE

    def _bytes(self, name: str, i: int) -> bytes:
        if i in self.special:
            return b""
        if i == self.unknown:
            return " ⁇ ".encode()
        return bytes([int(name[1:-1], 16)]) if i in self.byte_ids else name.replace(MARK, " ").encode()

    # -- the model's path through one word ------------------------------------

    def merged(self, text: str) -> list[str]:
        """Pieces of ``text`` by the merges alone: the best scored neighbours
        first, then the leftmost."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts):
                score = self.scores.get(parts[i] + parts[j])
                if score is not None:
                    heapq.heappush(heap, (-score, i, j, parts[i], parts[j]))
        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if parts[i] != a or parts[j] != b or right[i] != j:
                continue
            parts[i], parts[j] = a + b, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def _endings(self) -> dict[str, list[int]]:
        """Lengths of the pieces that end with each three characters, longest first."""
        out: dict[str, set[int]] = {}
        for piece in self.scores:
            if len(piece) > 2:
                out.setdefault(piece[-3:], set()).add(len(piece))
        return {k: sorted(v, reverse=True) for k, v in out.items()}

    def _merged_short(self, text: str) -> list[str]:
        """:meth:`merged` by plain scans, which is faster for a few characters."""
        parts, get = list(text), self.scores.get
        scores = [get(parts[i] + parts[i + 1], _NONE) for i in range(len(parts) - 1)]
        while scores:
            best = max(scores)
            if best == _NONE:
                break
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], _NONE)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], _NONE)
        return parts

    def _apart(self, a: str, b: str) -> bool:
        """Whether the merges keep the two pieces apart (b is empty: whether
        they make a whole)."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            own = self.own.get
            known = self.pairs[own(a, a), own(b, b)] = self._merged_short(a + b) == ([a, b] if b else [a])
        return known

    def _extend_merged(self, word: str, last: list) -> None:
        """Adds to ``last`` the last piece of the merges' path through each
        further prefix of ``word``: the longest piece there that the merges
        keep apart from the last one before it."""
        scores, known, ending = self.scores, self.pairs.get, self.endings.get
        for i in range(len(last), len(word) + 1):
            found = word[i - 1:i]
            if i > 1:
                for n in (*ending(word[i - 3:i], ()), 2) if i > 2 else (2,):
                    piece = word[i - n:i] if n <= i else ""
                    if piece in scores:
                        key = (last[i - n], piece) if n < i else (piece, "")
                        apart = known(key)
                        if apart if apart is not None else self._apart(*key):
                            found = piece
                            break
            last.append(found)

    def _last_scored(self, word: str, i: int, best: list) -> tuple[float, str]:
        """(score, last piece) of the best path through ``word[:i]``."""
        out = (best[i - 1][0] + self.scores.get(word[i - 1:i], self.floor), word[i - 1:i])
        for n in range(2, min(self.longest, i) + 1):
            score = self.scores.get(word[i - n:i])
            if score is not None and best[i - n][0] + score > out[0]:
                out = (best[i - n][0] + score, word[i - n:i])
        return out

    def paths(self, words: list[str]) -> dict[str, list[str]]:
        """Pieces of each word; the words are walked in sorted order, so that
        states of common prefixes are worked out once."""
        out: dict[str, list[str]] = {}
        states: list = [None if self.bpe else (0.0, "")]
        before = ""
        for word in sorted(words):
            shared = len(commonprefix((word, before)))
            del states[shared + 1:]
            if self.bpe:
                self._extend_merged(word, states)
            else:
                for i in range(shared + 1, len(word) + 1):
                    states.append(self._last_scored(word, i, states))
            path, i = [], len(word)
            while i:
                piece = states[i] if self.bpe else states[i][1]
                path.append(piece)
                i -= len(piece)
            out[word] = path[::-1]
            before = word
        return out

    # -- texts ------------------------------------------------------------------

    def _to_ids(self, path: list[str]) -> list[int]:
        try:
            return [self.ids[piece] for piece in path]
        except KeyError:  # a character outside the vocabulary
            pass
        out: list[int] = []
        for piece in path:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in piece.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of units: marked or bare words, or runs of marks before one.

        Marks merge among themselves after all else; so a run is the word with
        one mark, and if that mark stands alone, it joins the others. A blank
        in front of a unit is a mark, too.
        """
        units = [MARK + u[1:] if u[:1] == " " else u for u in units]
        plain, runs = [], {}
        for unit in units:
            word = unit.lstrip(MARK)
            if len(unit) - len(word) > 1:
                runs[unit] = (len(unit) - len(word), MARK + word if word else "")
                if word:
                    plain.append(MARK + word)
            else:
                plain.append(unit)
        paths = self.paths(list(set(plain)))
        for unit, (marks, word) in runs.items():
            if not self.bpe:
                paths.update(self.paths([unit]))
            elif not word:
                paths[unit] = self.merged(MARK * marks)
            elif paths[word][0] == MARK:
                paths[unit] = self.merged(MARK * marks) + paths[word][1:]
            else:
                paths[unit] = self.merged(MARK * (marks - 1)) + paths[word]
        return [self._to_ids(paths[u]) for u in units]

    def units(self, text: str) -> list[str]:
        """The text's marked words; one without double blanks is split fast."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or not self.lines:
            return self._units_of_runs(text)
        out: list[str] = []
        mark = MARK
        for line in text.split("\n"):
            if mark:
                out += [MARK + w for w in line.split(" ")]
                mark = ""
            else:
                first, *rest = line.split(" ")
                out.append("\n")
                if first:
                    out.append(first)
                out += [MARK + w for w in rest]
        return out

    def _units_of_runs(self, text: str) -> list[str]:
        import re
        text = MARK + text.replace(" ", MARK)
        split = rf"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if self.lines else rf"{MARK}*[^{MARK}]+|{MARK}+"
        return re.findall(split, text)

    def encode_column(self, texts: pa.Array, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, bounds of each text's) of a string column. Texts without
        double blanks, blanks in front and marks are cut into units as bytes,
        and only their distinct units become Python strings."""
        raw, off = text_buffers(texts)
        even = self._even(raw, off)
        others = np.flatnonzero(~even)
        if len(others):
            loose, loose_bounds = units.encode([self.units(t or "") for t in texts.take(pa.array(others)).to_pylist()])
            raw, off = text_buffers(texts.take(pa.array(np.flatnonzero(even))))
        full = off[1:] > off[:-1]
        marked = np.insert(raw, off[:-1][full], 0x20)  # every text begins with a mark
        cut = (marked == 0x20) | (marked == 0x0A)
        cut[1:] |= marked[:-1] == 0x0A
        starts = np.flatnonzero(cut)
        coded = pa.Array.from_buffers(
            pa.large_string(), len(starts),
            [None, pa.py_buffer(np.append(starts, len(marked)).astype(np.int64)), pa.py_buffer(marked)]).dictionary_encode()
        names = coded.dictionary.to_pylist()
        ids, ends = units.gather(units.number(names, len(names))[coded.indices.to_numpy()])
        bounds = np.concatenate([[0], ends])[np.searchsorted(starts, off + np.concatenate([[0], np.cumsum(full)]))]
        if not len(others):
            return ids, bounds
        lengths = np.empty(len(texts), np.int64)
        lengths[even], lengths[others] = np.diff(bounds), np.diff(loose_bounds)
        edges = np.concatenate([[0], np.cumsum(lengths)])
        every, of = np.empty(int(edges[-1]), np.int32), np.repeat(even, lengths)
        every[of], every[~of] = ids, loose
        return every, edges

    def _even(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Which texts have no double blank, no blank in front and no mark."""
        out = np.full(len(off) - 1, self.lines)
        blank = raw == 0x20
        first = off[:-1][off[1:] > off[:-1]]
        odd = np.zeros(len(raw), bool)
        odd[1:] = blank[1:] & blank[:-1]
        odd[first] = blank[first]
        lead = np.flatnonzero(raw[:-2] == 0xE2)
        odd[lead[(raw[lead + 1] == 0x96) & (raw[lead + 2] == 0x81)]] = True
        out[np.searchsorted(off, np.flatnonzero(odd), "right") - 1] = False
        return out

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each text of a batch, without the mark in front."""
        if self.flat is None:
            values = [self.value[i] for i in range(len(self.names))]
            self.starts = np.concatenate([[0], np.cumsum(list(map(len, values)))])
            self.flat = np.frombuffer(b"".join(values), np.uint8)
        first = self.starts[ids]
        lengths = self.starts[ids + 1] - first
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.flat[np.repeat(first - (ends - lengths), lengths) + np.arange(total)].tobytes()
        edges = np.concatenate([[0], ends])[bounds].tolist()
        return [raw[a + raw.startswith(b" ", a, b):b] for a, b in zip(edges[:-1], edges[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the mark that stands before every text goes."""
        text = b"".join(map(self.value.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[str, tuple[Pieces, Units]] = {}


def loaded(model_file: str) -> tuple[Pieces, Units]:
    """A worker's model and its table of words, kept between tasks."""
    if model_file not in _LOADED:
        pieces = Pieces(model_file)
        _LOADED[model_file] = pieces, Units(pieces.encode_units, MOST_UNITS)
    return _LOADED[model_file]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_crc32, round_trip) of every row of ``docs``.

    ``ids`` equal those of the SentencePiece library, ``round_trip`` tells
    whether decoding them gives the text again (false only where the text
    holds the mark U+2581, which the model reads as a blank). A null text is
    empty and has no ids; repeated rows are encoded each; other columns are
    ignored. ``model_file`` is a path every executor can open.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, units = loaded(model_file)
        for part in gathered(batches, "text", 2 << 20):
            texts = part.column("text")
            ids, bounds = pieces.encode_column(texts, units)
            raw, off = text_buffers(texts)
            raw, off = raw.tobytes(), off.tolist()
            back = [b == raw[c:d] for b, c, d in zip(pieces.decode_all(ids, bounds), off[:-1], off[1:])]
            packed, edges = memoryview(ids.astype("<u4").tobytes()), (4 * bounds).tolist()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(bounds)),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                 pa.array([crc32(packed[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.int64()),
                 pa.array(back, pa.bool_())], names=["doc_id", "n_tokens", "ids", "ids_crc32", "round_trip"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, ids_crc32 long, round_trip boolean"))


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids``; null ids give a null text."""
    small_batches(encoded.sparkSession)

    def run(batches):
        pieces, _ = loaded(model_file)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string")

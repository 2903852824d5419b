"""Language identification by compression.

Every learned language has a zstandard raw-content dictionary made of sample
texts. A text's words in lower case are compressed, in blocks, with each
dictionary; the language of the smallest total is predicted. Blocks are short, so that a long text is
measured against the dictionaries to its end and not against itself. The
margin is the share by which the second smallest total exceeds the smallest;
a prediction with a narrow margin is rejected: a text in a language that was
not learned is about as long with each dictionary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import fold, small_batches
from .words import slices

SAMPLE_TEXTS = 220       # sample texts of a language, at most
SAMPLE_CHARS = 600       # characters in a row that a sample text gives, at most
DRAWN = 8                # texts drawn for each one that is taken, on average
BLOCK_BYTES = 4_096
LEVEL = 11               # from here on a few words, too, find their matches
MARGIN = 0.05            # least margin that is accepted: most texts of a language nobody learned stay below
FOLDS, HELD_OUT = 4, 2   # rows whose crc32 has this remainder are never learned from
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_BLANKS = re.compile(b"  +")
_ASCII = bytes(b if chr(b).isalpha() else 0x20 for b in bytes(range(128)).lower()) + bytes(128)


def sample(docs: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, n, place, text): for each language the passages that its
    dictionary is made of, and its number of rows.

    Rows outside the held-out fold with text and lang count. A language's
    ``texts`` rows with the smallest hashes each give ``chars`` characters
    from a place that their hash chooses (a shorter text gives itself). The
    rows are first drawn by their hashes, at a rate that leaves some times
    ``texts`` of each language whatever the table's size, so no task gets
    more than that of one language; equal rows are drawn once.
    """
    rows = docs.where("lang is not null and text is not null and text <> ''").where(
        F.coalesce(fold(F.col("doc_id"), FOLDS), F.lit(0)) != HELD_OUT).select(
        "lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    often = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))  # a row for each language
    rate = F.lit(DRAWN * texts).cast("double") / F.col("n")
    share = (F.shiftrightunsigned("h", 11)).cast("double") / float(1 << 53)
    drawn = (rows.join(F.broadcast(often), "lang").where(share < rate)
             .select("lang", "n", "h", F.expr(
                 f"substring(text, cast(1 + pmod(xxhash64(h), greatest(char_length(text) - {chars}, 0) + 1) as int), {chars})")
                 .alias("text")).distinct())
    first = Window.partitionBy("lang").orderBy("h", "text")
    return drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= texts)


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Language -> dictionary, the commonest language first, of all passages of
    the :func:`sample`."""
    texts: dict[tuple[int, str], list[str]] = {}
    for row in sample(docs).orderBy("lang", "place").toLocalIterator():
        texts.setdefault((-row["n"], row["lang"]), []).append(row["text"])
    return {lang: dictionary(found) for (_, lang), found in sorted(texts.items())}


def plain(text: str) -> str:
    """The text's words in lower case: capitals, digits and marks tell junk
    apart, not languages."""
    return _OTHER.sub(" ", text.lower())


def plain_bytes(text: str) -> bytes:
    """:func:`plain` in UTF-8; ASCII, which most texts are, by a byte table."""
    if not text.isascii():
        return plain(text).encode()
    raw = text.encode().translate(_ASCII)
    return _BLANKS.sub(b" ", raw) if b"  " in raw else raw


def dictionary(texts: list[str]) -> bytes:
    return plain(" ".join(dict.fromkeys(texts))).encode()


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = list(dictionaries)
        self.coders = [self._coder(d) for d in dictionaries.values()]

    @staticmethod
    def _coder(content: bytes) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, accepted). The score is the margin's
        place between none and twice as much; a text without letters, or
        with nothing learned, is ``und``."""
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """:meth:`predict` of every text. One dictionary after the other
        compresses them all, so that its tables stay in the cache."""
        out = [(UNDETERMINED, 0.0, False)] * len(texts)
        told = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        if len(self.langs) == 1:
            for i in told:
                out[i] = self.langs[0], 1.0, True
            return out
        blocks = []
        for i in told:
            raw = plain_bytes(texts[i])
            blocks.append([raw[a:a + BLOCK_BYTES] for a in range(0, len(raw), BLOCK_BYTES)])
        totals = [[sum(map(len, map(c.compress, b))) for b in blocks] for c in self.coders]
        for i, sizes in zip(told, zip(*totals)):
            (least, best), (second, _) = sorted((n, k) for k, n in enumerate(sizes))[:2]
            out[i] = self.langs[best], 1 - least / (2 * second - least), (second - least) / second >= MARGIN
        return out


_COLUMNS = ["lang_pred", "score", "accepted"]


def _predictions(dictionaries: dict[str, bytes], part: pa.RecordBatch, model: Classifier) -> list[pa.Array]:
    found = model.predict_all(part.column("text").to_pylist())
    return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
            pa.array([f[2] for f in found], pa.bool_())]


def predict(docs: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row of ``docs``.

    Null texts and texts without a letter are ``und``, score 0, not accepted;
    with one learned language every other text is that one; with equal totals
    the commonest language wins and nothing is accepted. A null doc_id is not held
    out. Repeated rows are judged each; only doc_id, text and lang are read,
    and lang for learning alone.
    """
    small_batches(docs.sparkSession)
    known = learn(docs) if dictionaries is None else dictionaries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(known)
        for part in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), *_predictions(known, part, model)],
                names=["doc_id", "held_out", *_COLUMNS])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is accepted."""
    small_batches(docs.sparkSession)
    known = learn(docs) if dictionaries is None else dictionaries

    def run(batches):
        model = Classifier(known)
        for part in slices(batches, "text"):
            yield part.filter(_predictions(known, part, model)[2])
    return docs.mapInArrow(run, docs.schema)

"""SentencePiece, packed ids and fingerprints against the libraries and brute force."""

import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import fingerprint, pieces, tokenfile
from marquee.llm.frames import table

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\r\n", "\t", "a", "the", " the", "ing", "▁", "é", "É", "　", "\xa0", "'s", "12", "!!", "😀",
         "ß", "<s>", "<0x0A>", "\x00", "\x1c", "\x85", " " * 17, "梦", "<|endoftext|>", "x" * 20]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)
EXTRA = "doc_id long, text string, ids string, start int"


@settings(max_examples=300, deadline=None)
@given(TEXTS)
@example(" " * 100)
@example("▁▁a")
def test_pieces_equal_the_library(text):
    ours, units = pieces.loaded(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = units.encode([ours.units(text)])[0].tolist()
    assert ids == library.encode(text)
    assert ours.decode(ids) == library.decode(ids) == text.replace("▁", " ")


def test_shared_prefixes_give_the_same_paths():
    ours, _ = pieces.loaded(PIECES)
    words = ["▁" + w for w in ("inter", "internal", "internet", "interval", "in", "xqz", "international")]
    assert ours.paths(words) == {w: ours.merged(w) for w in words}


def test_unigram_scores_pick_the_best_path():
    model = object.__new__(pieces.Pieces)
    model.bpe, model.longest, model.floor = False, 3, -50.0
    model.scores = {"a": -1.0, "b": -1.0, "c": -1.0, "ab": -1.5, "bc": -0.2, "abc": -3.0}
    assert model.paths(["abc", "ab", "abz"]) == {"abc": ["a", "bc"], "ab": ["ab"], "abz": ["ab", "z"]}


def test_encode_query_over_the_given_table_and_edges(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(r["doc_id"], r["text"], "x", 1) for r in table(spark, SF, "documents").collect()]
    rows += [(-1, None, "", 0), (-2, "", "", 0), (-3, "long word " * 40_000, "", 0), (-3, "again", "", 0), (None, "z", "", 0)]
    out = pieces.encode(spark.createDataFrame(rows, EXTRA), PIECES)
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["ids"], r["n_tokens"], r["ids_crc32"], r["round_trip"])
                  for r in out.collect()), key=str)
    assert got == sorted(((d is None, d, e, len(e), zlib.crc32(np.array(e, "<u4").tobytes()), True)
                          for d, t, *_ in rows for e in [library.encode(t or "")]), key=str)
    back = {(r["doc_id"], r["text"]) for r in pieces.decode(out, PIECES).collect()}
    assert back == {(d, t or "") for d, t, *_ in rows}
    assert pieces.encode(spark.createDataFrame([], EXTRA), PIECES).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_byte_bpe_equals_the_library(texts):
    library = Tokenizer.from_file(BYTES)
    ids, bounds = tokenfile._loaded(BYTES).encode(texts) if texts else ([], [0])
    for t, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert list(ids[a:b]) == library.encode(t, add_special_tokens=False).ids
    column = pa.array([*texts, None, "", "plain words and\nlines", *texts], pa.string())
    ids, bounds = tokenfile._loaded(BYTES).encode_column(column)
    for t, a, b in zip(column.to_pylist(), bounds[:-1], bounds[1:]):
        assert list(ids[a:b]) == library.encode(t or "", add_special_tokens=False).ids
    ids, bounds = tokenfile._loaded(BYTES).encode_column(column.slice(1))
    assert len(bounds) == len(column) and bounds[-1] == len(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(" \t\n\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000ab\u2019\u00e9", max_size=12), max_size=5))
def test_even_texts_are_those_that_split_at_single_blanks(texts):
    from marquee.llm.words import text_buffers
    even = tokenfile.even_rows(*text_buffers(pa.array(texts, pa.string())))
    for t, e in zip(texts, even.tolist()):
        assert not e or not tokenfile._UNEVEN.search(t)
        assert e or not t.isascii() or tokenfile._UNEVEN.search(t)


def test_tables_that_start_anew_change_nothing(monkeypatch):
    monkeypatch.setattr(tokenfile, "MOST_UNITS", 5)
    monkeypatch.setattr(tokenfile, "MOST_PIECES", 3)
    library, coder = Tokenizer.from_file(BYTES), tokenfile.ByteBpe(BYTES)
    for k in range(40):
        texts = [f"word{k % 7} again{k % 5}, number {k} and\nline {k % 3}!" for _ in range(3)]
        ids, bounds = coder.encode_column(pa.array(texts))
        assert [list(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]


def test_marks_make_no_new_units_and_the_library_gets_many_at_once(monkeypatch):
    library, coder, calls = Tokenizer.from_file(BYTES), tokenfile.ByteBpe(BYTES), []
    inner = coder._encode
    monkeypatch.setattr(coder, "_encode", lambda text: calls.append(text) or inner(text))
    words = [f"{a}{b}né" for a in "abcdefghijklmnopqrst" for b in "uvwxyz"]
    texts = [f"say {w}{m} then" for w in words for m in ",.;:!?"]
    ids, bounds = coder.encode_column(pa.array(texts))
    assert [list(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]
    assert coder.units.known == len(words) + 8
    assert 0 < len(calls) <= 1 + coder.units.known // 50


def test_units_cut_at_marks_and_joined_equal_the_library():
    library, coder = Tokenizer.from_file(BYTES), tokenfile.ByteBpe(BYTES)
    odd = ["", "it's.", "'s,x", "'S", "é.", "×.", "÷,", "ß;!", "ŉ*", "ɏ.", "ɐ.", "ʼn.", "e\u0301.", "a.b.c", "1.5", "x1.", "..",
           "…", "\x00.", "\x1ca", "a\x1c", "a\x1f", "a\x85", "\xa0", "a\xa0.", "\u2003a", "ا.", "字。", "😀.", "¿a", "º.", "ª,", "\u200b"]
    texts = [*odd, *(f"{a} {b}" for a in odd for b in odd), *(f"{a}\n{b}" for a in odd for b in odd), " ".join(odd), "\n".join(odd)]
    for column in (pa.array(texts), pa.array(texts, pa.large_string())):
        ids, bounds = coder.encode_column(column)
        assert [list(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("bits", [1, 7, 8, 11, 16, 17, 32])
def test_packed_files_give_any_range(tmp_path, bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 150_000).astype(np.uint32)
    writer = tokenfile.Writer(f"{tmp_path}/x.bin", bits)
    writer.add([1, None], np.array([70_000, 0]), ids[:70_000])
    writer.add([3], np.array([80_000]), ids[70_000:])
    assert writer.close() == 150_000
    reader = tokenfile.Reader(f"file://{tmp_path}/x.bin")
    for a, n in ((0, 150_000), (65_530, 20), (1, 1), (149_999, 1), (70_001, 66_000), (5, 0)):
        assert (reader.ids(a, n) == ids[a:a + n]).all()
    assert [(k, s, len(i)) for k, s, i in reader.documents(1000)] == [(0, 0, 70_000), (1, 70_000, 0), (2, 70_000, 80_000)]
    assert tokenfile.bits_for(2**bits) == bits


def test_incomplete_file_is_refused(tmp_path):
    (tmp_path / "x.bin").write_bytes(b"IDPACK1\n" + b"\0" * 60)
    with pytest.raises(ValueError):
        tokenfile.Reader(f"{tmp_path}/x.bin")


def test_token_files_round_trip(spark):
    library = Tokenizer.from_file(BYTES)
    rows = [(r["doc_id"], r["text"], "x", 1) for r in table(spark, SF, "documents").collect()]
    rows += [(-5, None, "", 0), (-4, "", "", 0), (7, "zz again", "", 0), (None, "no id", "", 0)]
    got = [tuple(r) for r in tokenfile.round_trip(spark.createDataFrame(rows, EXTRA), BYTES).collect()]
    at, expected = 0, []
    for doc, text in sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    assert tokenfile.round_trip(spark.createDataFrame([], EXTRA), BYTES).count() == 0


# -- fingerprints ---------------------------------------------------------------


def plain_edit(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        out.append((doc, text, text[:len(text) - len(text) // 2] + after[:len(text) // 2], after))
    return out


def test_edited_texts_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "é😀" * 9), (50, "same id"), (None, "no id"), (None, "none")]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows], "doc_id long, text string, fingerprint string, block int")
    got = {(r["doc_id"], r["edited_sha256"]): r for r in fingerprint.edit_likeness(docs).collect()}
    prints = {}
    for doc, text, edited, after in plain_edit(rows):
        r = got.pop((doc, sha256(edited.encode()).hexdigest()))
        assert r["n_chars"] == len(text)
        a, b, c = (fingerprint.sketches(pa.array([t]))[0] for t in (text, edited, after))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint.to_text(a), fingerprint.to_text(b))
        assert (r["near_edited"], r["near_next"]) == (fingerprint.resemblance(a, b), fingerprint.resemblance(a, c))
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert not got
    for few in ([], [(3, "only one here, once")]):
        docs = spark.createDataFrame(few, "doc_id long, text string")
        assert [r["near_next"] for r in fingerprint.edit_likeness(docs).collect()] == [1.0] * len(few)


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(2)
    both = rng.permutation(np.unique(rng.integers(0, 2**48, 6000, dtype=np.uint64)))
    a, b = both[:4000], both[2000:]
    sa, sb = fingerprint.bottom(a, 1024), fingerprint.bottom(b, 1024)
    assert abs(fingerprint.resemblance(sa, sb, 1024) - 2000 / len(both)) < 0.06
    assert abs(fingerprint.containment(sa, sb, 1024) - 0.5) < 0.07
    assert abs(fingerprint.distinct(sa, 1024) / 4000 - 1) < 0.12
    assert (fingerprint.merge(sa, sb, 1024) == fingerprint.bottom(both, 1024)).all()
    assert (fingerprint.from_text(fingerprint.to_text(sa)) == sa).all()
    small = np.arange(5, dtype=np.uint64)
    assert fingerprint.resemblance(small, small[:3]) == 0.6 and fingerprint.distinct(small) == 5
    assert fingerprint.resemblance(small[:0], small[:0]) == 1.0 and fingerprint.resemblance(small, small[:0]) == 0.0


def test_parts_merge_to_the_whole(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "source")
    parts = fingerprint.fingerprints(docs).join(docs.select("doc_id", "source"), "doc_id")
    got = {r["source"]: r["fingerprint"] for r in fingerprint.merged(parts, "source").collect()}
    whole = {}
    for r in docs.collect():
        s = fingerprint.sketches(pa.array([r["text"]]))[0]
        whole[r["source"]] = fingerprint.merge(whole.get(r["source"], s[:0]), s)
    assert got == {k: fingerprint.to_text(s) for k, s in whole.items()}


def test_a_full_table_keeps_its_common_units():
    from marquee.llm.units import Units
    learned = []

    def new(names):
        learned.extend(names)
        return [[ord(c) for c in n] for n in names]
    units = Units(new, 20)
    for k in range(60):
        texts = [["the", f"rare{k}", "of"], [f"odd{k}", "the"], []]
        ids, bounds = units.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [
            [ord(c) for u in t for c in u] for t in texts]
        assert len(units.numbers) <= 24
    assert learned.count("the") == learned.count("of") == 1 and len(learned) == 122


def test_a_worker_keeps_few_strings_for_a_texts_words(tmp_path):
    """Keys of the table of words are plain ASCII where the words are, and the
    pieces in remembered pairs are the vocabulary's own strings."""
    ours = pieces.Pieces(PIECES)
    table = pieces.Units(ours.encode_units, pieces.MOST_UNITS)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["some plain words\nhere", "and  marked ▁ words", "", "plain again"]
    ids, bounds = ours.encode_column(pa.array(texts), table)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library.encode(t) for t in texts]
    assert " plain" in table.numbers and "▁plain" not in table.numbers
    assert ours.pairs and all(ours.own.get(p, p) is p for pair in ours.pairs for p in pair)

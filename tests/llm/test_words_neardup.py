"""Word hashes and near duplicates against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from marquee.llm import neardup, words
from marquee.llm.frames import release, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_shingles int, component_id string"


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def plain_set(text, size):
    w = plain_words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_components(rows, size):
    sets = [plain_set(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                    up[root(i)] = root(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), lowest[root(i)], doc == lowest[root(i)]) for i, (doc, _) in enumerate(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZé \t\n\x0b\xa0ß.", max_size=30)), max_size=6))
def test_equal_words_have_equal_hashes_and_others_differ(texts):
    hashes, before = words.word_hashes(pa.array(texts, pa.string()))
    seen = {}
    for i, text in enumerate(texts):
        own = hashes[before[i]:before[i + 1]]
        expected = plain_words(text)
        assert len(own) == len(expected)
        for h, w in zip(own.tolist(), expected):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_chunks_never_cut_a_word(monkeypatch):
    texts = pa.array(["alpha beta  gamma", None, "x" * 50, "", "delta epsilon " * 9, "y z"])
    whole = words.word_hashes(texts)
    for size in (1, 2, 7, 16, 64):
        monkeypatch.setattr(words, "CHUNK_BYTES", size)
        cut = words.word_hashes(texts)
        assert (cut[0] == whole[0]).all() and (cut[1] == whole[1]).all()


def test_slices_keep_every_row_in_order():
    batch = pa.record_batch({"text": ["a" * n for n in (5, 0, 9, 1, 1, 30)], "n": list(range(6))})
    for limit in (1, 6, 100):
        parts = list(words.slices(iter([batch]), "text", limit))
        assert pa.Table.from_batches(parts).column("n").to_pylist() == list(range(6))


@pytest.mark.parametrize("shared", [0.3, 0.6, 0.8, 0.95])
def test_likelihood_estimates_resemblance(shared):
    rng = np.random.default_rng(3)
    both = rng.integers(0, 2**63, int(2000 * shared), dtype=np.uint64)
    a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, 1000 - len(both) // 2, dtype=np.uint64)]))
            for _ in range(2))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    m = 1024
    r = neardup.sketch([a, b], m)
    plus, minus = np.array([(r[0] > r[1]).sum()]), np.array([(r[0] < r[1]).sum()])
    got = neardup.estimate(plus, minus, m, np.array([float(len(a))]), np.array([float(len(b))]))[0]
    assert abs(got - true) < 0.06
    for level in (got - 0.05, got + 0.05):
        if 0 < level < 1:
            assert neardup.reaches(level, plus, minus, m, float(len(a)), np.array([float(len(b))]))[0] == (got >= level)


def test_sketches_merge_by_maximum():
    rng = np.random.default_rng(5)
    a, b = (np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64)) for _ in range(2))
    r = neardup.sketch([a, b, np.union1d(a, b)], 64)
    assert (np.maximum(r[0], r[1]) == r[2]).all()


def run(spark, docs, size):
    rows = neardup.near_duplicates(docs, neardup.NearDup(shingle=size)).collect()
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows)


def test_given_table_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert run(spark, docs, 4) == plain_components(rows, 4)
    release(spark)


def test_chains_copies_nulls_and_short_texts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)  # every frequent band and family is dealt out in blocks
    monkeypatch.setattr(neardup, "FAMILY_BLOCK", 4)
    rng = np.random.default_rng(7)
    base = [f"w{k}" for k in rng.integers(0, 10**6, 120)]
    rows, text = [], list(base)
    for k in range(30):  # a chain: each differs from the one before by one word
        text = list(text)
        text[(7 * k) % 120] = f"n{k}"
        rows.append((100 + k, " ".join(text)))
    rows += [(200 + k, " ".join(base)) for k in range(20)]               # exact copies
    rows += [(5, " ".join(base).upper()), (6, "  ".join(base) + "\n")]   # the same words
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (7, "One  two"), (8, "one two three"), (9, "one")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert run(spark, docs, 4) == plain_components(rows, 4)
    release(spark)


def test_repeated_rows_and_ids(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    docs = spark.createDataFrame([(1, a, 0, ""), (1, a, 0, ""), (1, b, 0, ""), (None, a, 0, ""), (2, b, 0, ""),
                                  (None, None, 0, "")], SCHEMA)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == 6
    assert {r["component_id"] for r in rows if r["doc_id"] is not None} == {1}
    assert [r["kept"] for r in rows if r["doc_id"] is None and r["n_shingles"]] == [False]
    assert [r["kept"] for r in rows if r["doc_id"] is None and not r["n_shingles"]] == [True]


def test_empty_table(spark):
    assert run(spark, spark.createDataFrame([], SCHEMA), 4) == []


def test_texts_without_id_are_linked_by_their_texts(spark):
    words = [f"w{k}" for k in range(100)]
    a, b = " ".join(words), " ".join([*words[:99], "other"])
    docs = spark.createDataFrame([(None, a, 0, ""), (None, a, 0, ""), (7, b, 0, ""), (7, "x y z u v w", 0, ""),
                                  (3, "x y z u v w", 0, "")], SCHEMA)
    rows = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert rows == {(None, 96): 7, (7, 96): 7, (7, 2): 3, (3, 2): 3}


def test_one_row_of_each_component_stays(spark):
    words = [f"w{k}" for k in range(100)]
    a, b, c = " ".join(words), " ".join([*words[:99], "other"]), "a text of its own and of nobody else"
    rows = [(4, b), (4, c), (2, a), (2, a), (None, a), (None, c), (9, "p q r s t u"), (None, "p q r s t u v w x y z"),
            (None, "one of a kind is this"), (5, None), (5, None), (None, " "), (6, "")]
    docs = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, k1 int, words string")
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(2, a), (4, c), (9, "p q r s t u"), (None, "p q r s t u v w x y z"),
                          (None, "one of a kind is this"), (5, None), (5, None), (None, " "), (6, "")], key=str)
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_no_text_meets_by_its_familys_key(spark):
    """Texts are looked up by row and dealt out by block pair; nothing wide is
    shuffled by a family's root or a band."""
    docs = table(spark, SF, "documents")
    plan = neardup._one_text_each(
        docs.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.lit(1).cast("long").alias("k2")),
        docs.select(F.lit(b"n").alias("node"), F.lit(b"r").alias("root"), F.lit(1).alias("blocks"), "doc_id",
                    F.lit(1).cast("long").alias("k1"), F.lit(1).cast("long").alias("k2")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(root" not in text and "hashpartitioning(node" not in text


def test_texts_are_fetched_by_a_shuffle_at_any_size(spark):
    """A few chosen rows are no reason to broadcast: what small inputs cost
    then says nothing about large ones."""
    key = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")]
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(None, "x"), (3, "text 3")],
                                 "doc_id long, text string").select("doc_id", "text", *key)
    chosen = rows.where("doc_id < 5 or doc_id is null").select("doc_id", "k1", "k2", F.lit(1).alias("n")).distinct()
    found = neardup._rows_of(rows, chosen)
    assert sorted((r["text"], r["n"]) for r in found.collect()) == sorted([*((f"text {i}", 1) for i in range(5)), ("x", 1)])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text

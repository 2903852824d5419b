"""Language, toxicity, decontamination and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from marquee.llm import decontaminate, langid, toxicity
from marquee.llm.frames import table
from marquee.llm.queries import op6_language, op10_decontaminate

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, toxic int"


def crc(doc):
    return zlib.crc32(str(doc).encode())


def extra(rows):
    return [(d, t, lang, "s", len(t or ""), 0.5, 1) for d, t, lang in rows]


# -- language -------------------------------------------------------------------


def test_held_out_documents_get_their_language(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, MID, "documents").collect()}
    rows = op6_language(spark, MID).collect()
    assert len(rows) == len(lang) and all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) for r in rows)
    tried = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in tried]) >= 0.97
    assert np.mean([r["accepted"] for r in tried]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_a_language_that_was_not_learned_is_rejected(spark):
    docs = table(spark, MID, "documents")
    for lang in ("en", "de", "fr", "es"):
        known = langid.learn(docs.where(f"lang <> '{lang}'"))
        assert len(known) == 3 and lang not in known
        unknown = [r["accepted"] for r in langid.predict(docs.where(f"lang = '{lang}'"), known).collect()]
        assert len(unknown) >= 100 and np.mean(unknown) <= 0.05
        kept = langid.accepted(docs.where(f"lang <> '{lang}'"), known)
        assert kept.count() >= 0.97 * docs.where(f"lang <> '{lang}'").count()


def test_language_edges(spark):
    en, de = "the cat sat on the mat and looked at the dog " * 9, "der hund und die katze sitzen auf dem teppich " * 9
    rows = [(d, (en, de)[d % 2], ("en", "de")[d % 2]) for d in range(40)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 34 !!", "de"), (103, en.upper(), None), (104, de * 2000, None),
             (None, en, "xx"), (105, en, None), (105, en, None)]
    docs = spark.createDataFrame(extra(rows), DOCS)
    got = {}
    for r in langid.predict(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [r["lang_pred"] for d in (100, 101, 102) for r in got[d]] == ["und"] * 3
    assert [r["accepted"] for d in (100, 101, 102) for r in got[d]] == [False] * 3
    assert got[104][0]["lang_pred"] == "de" and got[103][0]["lang_pred"] in ("en", "xx") and len(got[105]) == 2
    held = spark.createDataFrame(extra([(d, en, "zz") for d in range(200) if crc(d) % 4 == 2]), DOCS)
    assert {r["lang_pred"] for r in langid.predict(held).collect()} == {"und"}  # nothing to learn from
    one = spark.createDataFrame(extra([(0, en, "en"), (1, de, None)]), DOCS)
    assert {r["lang_pred"] for r in langid.predict(one).collect()} <= {"en", "und"}
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and {100, 101, 102}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert langid.predict(spark.createDataFrame([], DOCS)).count() == 0


def test_learning_texts_are_drawn_from_all_of_the_text(spark):
    """A boilerplate opening is no language: passages come from anywhere."""
    opening = "cookie policy accept all privacy settings manage preferences close " * 12
    en, de = "the cat sat on the mat and looked at the dog ", "der hund und die katze sitzen auf dem teppich "
    rows = [(d, opening + (en, de)[d % 2] * 60, ("en", "de")[d % 2]) for d in range(120)]
    docs = spark.createDataFrame(extra(rows), DOCS)
    known = langid.learn(docs)
    assert "dog" in known["en"].decode() and "teppich" in known["de"].decode()
    assert all(r["lang_pred"] == ("en", "de")[r["doc_id"] % 2] for r in langid.predict(docs).collect())
    taken = langid.sample(docs, texts=5, chars=70).collect()
    assert sorted((r["lang"], r["place"]) for r in taken) == [(c, k) for c in ("de", "en") for k in range(1, 6)]
    assert all(len(r["text"]) == 70 for r in taken)
    first = {r["lang"]: r["text"] for r in taken}
    every = [r["text"] for r in langid.sample(docs).where("lang = 'en'").orderBy("place").collect()]
    assert known["en"] == langid.dictionary(every) and len(known["en"]) > 20_000  # nothing is cut afterwards
    copies = spark.createDataFrame(extra([(7, en * 40, "en")] * 3000 + rows), DOCS)  # equal rows are drawn once
    assert langid.sample(copies, texts=40).where("lang = 'en'").count() <= 40 and first


# -- toxicity -------------------------------------------------------------------


@pytest.fixture(scope="module")
def insulted(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for d in range(900):
        text = rng.choices(words, k=rng.randint(30, 90))
        if d % 6 == 0:
            for _ in range(4):
                at = rng.randrange(len(text))
                text[at:at] = ["you", rng.choice(["dumbo", "dumboish,", "DUMBOS!!", "fool.", "Fool"])]
        rows.append((d, " ".join(text), "en"))
        if d % 3 != 1:
            labels.append((d, int(d % 6 == 0)))
    rows += [(5000, None, None), (5001, "", "en"), (None, "fool dumbo", None), (5002, "calm words " * 30_000, None)]
    docs = spark.createDataFrame(extra(rows), DOCS)
    return docs, spark.createDataFrame(labels + [(7, None), (8, 5), (None, 1)], "doc_id long, toxic int")


def test_held_out_toxicity_is_found(spark, insulted):
    docs, labels = insulted
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 904
    for r in rows:
        if r["doc_id"] is not None:
            assert r["held_out"] == (crc(r["doc_id"]) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    tried = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 900 and (r["held_out"] or r["doc_id"] % 3 == 1)]
    hit = [r["predicted"] for r in tried if r["doc_id"] % 6 == 0]
    clean = [r["predicted"] for r in tried if r["doc_id"] % 6]
    assert np.mean(hit) >= 0.95 and np.mean(clean) <= 0.01
    assert {r["predicted"] for r in rows if r["doc_id"] in (5000, 5001, 5002)} == {0}
    stay = toxicity.without_toxic(docs.withColumnRenamed("score", "tox__score"), labels)
    assert stay.columns[5] == "tox__score" and stay.count() == sum(not r["predicted"] for r in rows)


def test_insults_of_a_small_language_are_found(spark):
    """Eight toxic texts in a hundred are Spanish, and each of their insults is in fewer than two in a hundred."""
    rng = random.Random(21)
    vocabulary = {k: ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(200)] for k in ("en", "es")}
    insults = {"en": ["dumbo", "fooly", "jerkish"], "es": ["zorrut", "quezna", "xurrut", "zyvalt", "wuzzon", "yokelz", "vuzqui", "tzarrt", "ruzpol", "sixtun"]}
    rows = []
    for d in range(4000):
        lang = "es" if d % 16 == 0 else "en"
        text = rng.choices(vocabulary[lang], k=rng.randint(15, 30))
        if d % 5 == 1 if lang == "en" else d % 64 == 0:
            for k in (d // 64, d // 64 + 1):
                text.insert(rng.randrange(len(text)), insults[lang][k % len(insults[lang])])
        rows.append((d, " ".join(text), lang))
    toxic = {d for d, t, lang in rows if any(w in t.split() for w in insults[lang])}
    docs = spark.createDataFrame(extra(rows), DOCS)
    labels = spark.createDataFrame([(d, int(d in toxic)) for d, *_ in rows], "doc_id long, toxic int")
    by_id, recall, alarms = {d: lang for d, _, lang in rows}, {"en": [], "es": []}, []
    for r in toxicity.toxicity(docs, labels).where("held_out").collect():
        (recall[by_id[r["doc_id"]]] if r["doc_id"] in toxic else alarms).append(r["predicted"])
    assert len(recall["es"]) >= 8
    assert np.mean(recall["en"]) >= 0.95 and np.mean(recall["es"]) >= 0.9 and np.mean(alarms) <= 0.01


def test_toxicity_without_both_classes(spark, insulted):
    docs, labels = insulted
    assert {r["score"] for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r["score"] for r in toxicity.toxicity(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert toxicity.toxicity(spark.createDataFrame([], DOCS), labels).count() == 0


def test_features_see_obfuscation_and_closeness():
    f = toxicity.Features({"idiot": 3.0, "idio-": 2.0})
    rows = f.rows(["you are an idiot", "an idiot sat far away from all of those nice calm people there you know",
                   "id1ot an 1d10t id.iot", "IDIOTIC!!", "", None])
    at = {n: k for k, n in enumerate(f.NAMES)}
    assert rows[0][at["close"]] == 1 and rows[1][at["close"]] == 0
    assert rows[2][at["hidden_hits"]] > 0 and rows[3][at["capitals"]] == 1 and rows[3][at["strongest"]] == 2
    assert not rows[4].any() and not rows[5].any()


# -- decontamination ------------------------------------------------------------


@pytest.fixture(scope="module")
def leaky():
    rng = random.Random(11)
    rare = ["".join(rng.choices("bcdfghklmnprstvaeiou", k=7)) for _ in range(3000)]
    common = ["the", "of", "and", "to", "in", "a", "is"]
    draw = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]
    items = {k: draw(rng.randint(20, 50)) for k in range(30)}
    clean = [" ".join(draw(rng.randint(5, 300))) for _ in range(150)]
    rows, leaks = [(k, t) for k, t in enumerate(clean)], {}
    for k in range(60):
        item, words = k % 30, list(items[k % 30])
        if k % 3 == 1:      # every eighth word differs
            words = [("edited" if i % 8 == 7 else w) for i, w in enumerate(words)]
        elif k % 3 == 2:    # words dropped and added, capitals, punctuation
            words = [w.upper() + "!!" for i, w in enumerate(words) if i % 9 != 8]
            words[10:10] = ["extra", "words"]
        rows.append((1000 + k, " ".join(draw(rng.randint(0, 200)) + words + draw(rng.randint(0, 40)))))
        leaks[1000 + k] = item
    return items, rows, leaks


def test_verbatim_and_edited_leaks_are_found_and_no_others(spark, leaky):
    items, rows, leaks = leaky
    docs = spark.createDataFrame(extra([(d, t, "en") for d, t in rows] + [(1, None, "en"), (2, "", "en")]), DOCS)
    bench = spark.createDataFrame([(k, " ".join(w), 0) for k, w in items.items()] + [(77, None, 0), (78, "", 0), (3, " ".join(items[3]), 9)],
                                  "item_id long, text string, score int")
    found = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(leaks.items())
    by_id = dict(rows)
    for r in found:
        words = re.findall(r"[^\W_]+", by_id[r["doc_id"]].lower())[r["first_word"]:r["first_word"] + r["n_words"]]
        assert sum(w in items[r["item_id"]] for w in words) >= 0.6 * len(words)
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([d for d, _ in rows if d not in leaks] + [1, 2])


def test_benchmark_in_blocks_gives_the_same(spark, leaky, monkeypatch):
    items, rows, leaks = leaky
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()) == sorted(leaks.items())
    assert decontaminate.without_leaks(docs, bench).count() == len(rows) - len(leaks)


def test_edited_leaks_are_found_in_a_benchmark_of_any_size(spark):
    """The same items, and copies of them with changed words, inside 40 and inside 20,000 items."""
    rng = np.random.default_rng(5)
    share = 1 / np.arange(1, 30_001)
    drawn = rng.choice(30_000, (20_000, 38), p=share / share.sum())
    items = [" ".join(f"w{w}" for w in row) for row in drawn.tolist()]
    noise = rng.choice(30_000, (160, 60), p=share / share.sum()).tolist()
    rows, leaks = [], set()
    for k in range(120):
        words = items[k % 40].split()
        for at in rng.permutation(38)[:4 if k < 40 else 6 if k < 80 else 9]:
            words[at] = "changed"
        rows.append((k, " ".join([f"w{w}" for w in noise[k][:30]] + words + [f"w{w}" for w in noise[k][30:]])))
        leaks.add((k, k % 40))
    rows += [(k, " ".join(f"w{w}" for w in noise[k])) for k in range(120, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for size in (40, 20_000):
        bench = spark.createDataFrame(list(enumerate(items[:size])), "item_id long, text string")
        found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
        assert found <= leaks
        for a, least in ((0, 1), (40, 1), (80, 0.9)):
            assert sum((k, k % 40) in found for k in range(a, a + 40)) >= least * 40, (size, a)


def test_scores_do_not_depend_on_the_blocks(spark, leaky, monkeypatch):
    items, rows, _ = leaky
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    score = lambda: {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(docs, bench).collect()}
    whole = score()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    assert score() == whole


def test_leak_in_a_very_long_text_and_empty_tables(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, "filler words go on " * 60_000 + item + " more" * 9), (2, "filler")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [(r["doc_id"], r["first_word"], r["n_words"]) for r in decontaminate.contaminated(docs, bench).collect()] == [(1, 240_000, 10)]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == 2


def plain_alignment(item, weight, words):
    h = np.zeros((len(item) + 1, len(words) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            step = weight[i - 1] if a == b else -decontaminate.SWAP
            h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] - decontaminate.GAP, h[i, j - 1] - decontaminate.GAP)
    return h.max()


def test_query_equals_all_pairs_aligned(spark):
    """Every document against every item of the given tables, without seeds or
    windows: Smith-Waterman over the whole text, a document's word at a time
    over all items' words at once."""
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL, "documents").collect()}
    items = {r["item_id"]: r["text"] or "" for r in table(spark, SMALL, "benchmark").collect()}
    # words are what lies between ASCII marks, blanks and controls
    words = lambda t: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t.lower())
    listed = {k: words(t) for k, t in items.items() if words(t)}
    holders = Counter(w for ws in listed.values() for w in set(ws))
    rarity = {w: min(1.0, max(0.1, math.log(len(listed) / n) / math.log(1000))) for w, n in holders.items()}
    weight = {k: np.array([rarity[w] for w in ws]) / np.mean([rarity[w] for w in ws]) for k, ws in listed.items()}
    number = {w: i for i, w in enumerate(holders)}
    width = max(map(len, listed.values()))
    ids, heavy = np.full((len(listed), width), -2), np.zeros((len(listed), width))
    for row, k in enumerate(listed):
        ids[row, :len(listed[k])] = [number[w] for w in listed[k]]
        heavy[row, :len(listed[k])] = weight[k]
    slope = 0.5 * np.arange(1, width + 1)
    expected = set()
    for doc, text in docs.items():
        above, best = np.zeros((len(listed), width + 1)), np.zeros(len(listed))
        for w in words(text):
            here = np.maximum(above[:, 1:] - 0.5, above[:, :-1] + np.where(ids == number.get(w, -1), heavy, -0.5))
            here = np.maximum(here, 0)
            here = np.maximum.accumulate(here + slope, axis=1) - slope
            above[:, 1:] = here
            best = np.maximum(best, here.max(axis=1))
        score = best / heavy.sum(axis=1)
        expected |= {(doc, k, round(float(s), 6)) for k, s in zip(listed, score) if s >= 0.5}
    found = {(r["doc_id"], r["item_id"], round(r["score"], 6)) for r in op10_decontaminate(spark, SMALL).collect()}
    assert expected and found == expected


def test_alignment_equals_the_textbook_table():
    rng = np.random.default_rng(1)
    for _ in range(40):
        item, words = (rng.integers(1, 6, rng.integers(1, 12)).astype(np.uint64) for _ in range(2))
        weight = rng.uniform(0.1, 1, len(item))
        assert np.isclose(decontaminate.align(item, weight, words[None, :])[0][0], plain_alignment(item, weight, words))


# -- pipeline -------------------------------------------------------------------


def test_stages_take_effect_and_keep_the_columns(spark, tmp_path):
    rng = random.Random(3)
    draw = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    clean = [(k, draw(60), "en") for k in range(60)]
    item = draw(30)
    rows = clean + [(1000, "12 34 !!", "en"), (1001, clean[0][1], "en"), (1002, clean[1][1] + " more", "en"),
                    (1003, draw(20) + " " + item + " " + draw(20), "en"), (1003, draw(9), "en"), (None, draw(40), "en")]
    toxic = [(2000 + k, draw(20) + " fool you fool " + draw(10), "en") for k in range(40)]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t)) for d, t, lang in rows + toxic],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, int(k >= 2000)) for k in [*range(60), *range(2000, 2040)]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    ids = {}
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        if name != "sentencepiece":
            assert now.columns == docs.columns
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = sorted((r["doc_id"] for r in now.select("doc_id").collect()), key=str)
    every = [d for d, *_ in rows + toxic]
    drop = lambda gone: sorted((d for d in every if d not in gone), key=str)
    assert ids["language"] == drop({1000})
    gone = {1000, *range(2000, 2040)}
    assert ids["toxicity"] == drop(gone)
    gone |= {1001, 1002}
    left = drop(gone)
    assert ids["near_duplicates"] == left
    assert set(ids["decontamination"]) | {1003} == set(left)
    assert ids["sentencepiece"] == ids["decontamination"]
    assert sorted((r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str) == ids["sentencepiece"]


def test_pipeline_over_the_given_tables_equals_its_stages_by_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    known = langid.learn(docs)
    model = langid.Classifier(known)
    rows = [r for r in docs.collect() if model.predict(r["text"])[2]]
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, SMALL).collect()) == sorted(r["doc_id"] for r in rows)
    from tests.llm.test_words_neardup import plain_components
    alone = {d for d, _, _, kept in plain_components([(r["doc_id"], r["text"]) for r in docs.collect()], 5) if kept}
    assert {r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, SMALL).collect()} == alone
    bench = {r["item_id"]: decontaminate._words(pa.array([r["text"]]))[0] for r in table(spark, SMALL, "benchmark").collect()}
    whole = {r["doc_id"]: decontaminate._words(pa.array([r["text"]]))[0].tobytes() for r in docs.collect()}
    verbatim = {d for d, t in whole.items() for w in bench.values() if t.find(w.tobytes()) % 8 == 0 and w.tobytes() in t}
    stay = {r["doc_id"] for r in corpus_pipeline.decontaminated(spark, docs, SMALL).collect()}
    assert stay.isdisjoint(verbatim) and len(stay) >= 0.95 * (len(whole) - len(verbatim))


def test_one_dictionary_after_the_other_compresses_all_texts():
    en, de = b"the quick brown fox and the lazy dog " * 9, b"der schnelle braune fuchs und der faule hund " * 9
    model = langid.Classifier({"en": en, "de": de})
    texts = ["the brown dog and the fox " * 300, None, "der faule fuchs und der hund", "", "12 !", "the lazy fox"]
    assert model.predict_all(texts) == [model.predict(t) for t in texts]
    assert [p[0] for p in model.predict_all(texts)] == ["en", "und", "de", "und", "und", "en"]
    order, coders = [], model.coders

    class Noted:
        def __init__(self, k):
            self.k = k

        def compress(self, raw):
            order.append(self.k)
            return coders[self.k].compress(raw)
    model.coders = [Noted(0), Noted(1)]
    model.predict_all(texts)
    assert order == sorted(order) and set(order) == {0, 1}


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=127), st.sampled_from("é É ß\u0130٣_  ")), max_size=20))
def test_plain_words_are_the_same_by_the_byte_table(text):
    assert langid.plain_bytes(text) == langid.plain(text).encode()


def test_a_few_words_tell_their_language(spark):
    """Held-out texts give four words each."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.Classifier(langid.learn(docs))
    held = docs.where("text is not null and lang is not null and crc32(cast(doc_id as string)) % 4 = 2").collect()
    few = [" ".join(r["text"].split()[5:9]) for r in held]
    right = [p[0] == r["lang"] for p, r in zip(model.predict_all(few), held)]
    assert len(held) > 100 and sum(right) >= 0.9 * len(held)

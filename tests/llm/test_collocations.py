"""Phrase collocations against a count in plain Python."""

import random
import re
from collections import Counter

import pytest

from marquee.llm import collocations as c

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=10, subsumed=50, top=2000):
    out = []
    for lang in {lang or "und" for lang, _ in rows}:
        f, n = Counter(), 0
        for _, text in (r for r in rows if (r[0] or "und") == lang):
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
                words = re.findall("[^ \t]+", piece)
                n += len(words)
                f.update(tuple(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + 2] for p, a in frequent.items() if len(p) == 3 for i in (0, 1)
                if 100 * a >= subsumed * f[p[i:i + 2]]}
        found = []
        for p, a in frequent.items():
            if p not in gone:
                score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def run(spark, rows, **how):
    docs = spark.createDataFrame([(lang, text, 7, None) for lang, text in rows],
                                 "lang string, text string, n long, score string")
    found = c.collocations(docs, c.Collocations(**how))
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def corpus(seed, size=300, vocabulary=40):
    r = random.Random(seed)
    words = [f"W{i}é" if i % 3 else f"w{i}" for i in range(vocabulary)]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", ", ", ".\n", "  "])
                           for _ in range(r.randrange(60)))
    return [(r.choice(["en", "de", None]), text()) for _ in range(size)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    rows = corpus(3) + [("en", "new york city hall " * 30), ("en", None), ("en", ""), ("fr", " .,; ")]
    rows += [("en", "San Francisco")] * 25 + [("de", "a a a a a")] * 9
    if small:  # parts of a few words, merged a few entries at a time
        for batches in (rows[:100], rows):
            texts = [(t or "").encode() for _, t in batches]
            whole = {}
            for limit in (50, 1 << 20):
                found = Counter()
                for raw in c._pieces(texts, limit):
                    stripes = c._stripes(raw, {})
                    if stripes:
                        first, shard, entries, counts = stripes
                        for w, e, n in zip(first.to_pylist(), entries.to_pylist(), counts.to_pylist()):
                            for entry, k in zip(e.split(b"\n")[:-1], memoryview(n).cast("I")):
                                found[w, entry] += k
                whole[limit] = found
            assert whole[50] == whole[1 << 20]
    assert run(spark, rows, least=5 if small else 10) == brute(rows, least=5 if small else 10)


def test_merging_in_small_steps_changes_nothing(monkeypatch):
    import pyarrow as pa
    rows = corpus(5, 60, 8)
    batch = pa.RecordBatch.from_pydict({"lang": ["x"] * len(rows), "text": [t for _, t in rows]})
    hot = {"x": {b"w1\xc3\xa9": 3, b"w2\xc3\xa9": 2, b"w0": 5}}
    stripes = pa.Table.from_batches(list(c._count(hot)([batch, batch, batch]))).combine_chunks()
    assert set(stripes.column("part").to_pylist()) == set(range(5))
    order = stripes.sort_by([("first", "ascending"), ("part", "ascending")])
    thrice = pa.concat_tables([order] * 3).sort_by([("first", "ascending"), ("part", "ascending")])

    def merged(step):
        monkeypatch.setattr(c, "CHUNK_ENTRIES", step)
        found = Counter()
        for out in c._merge(1, hot)(iter(thrice.to_batches(max_chunksize=7))):
            for row in out.to_pylist():
                key = (row["first"], row["next"], row["after"])
                assert row["next"] is None or key not in found
                found[key] += row["n"]
        return found
    whole = merged(1 << 20)
    assert merged(3) == whole
    hot = {}
    stripes = pa.Table.from_batches(list(c._count(hot)([batch, batch, batch]))).combine_chunks()
    order = stripes.sort_by([("first", "ascending"), ("part", "ascending")])
    thrice = pa.concat_tables([order] * 3).sort_by([("first", "ascending"), ("part", "ascending")])
    assert merged(1 << 20) == whole  # parts of frequent words add up to the same


def test_ties_limits_and_empty_tables(spark):
    rows = [("en", "b a. d c. f e.")] * 12
    assert [r[2] for r in run(spark, rows, top=2)] == ["b a", "d c"] == [r[2] for r in brute(rows, top=2)]
    assert run(spark, rows, top=2) == brute(rows, top=2)
    assert run(spark, []) == [] == run(spark, [("en", None), (None, "")])


def test_a_hot_phrase_and_a_very_long_text(spark):
    rows = [("en", "x y " * 40_000), (None, "x y z")] + corpus(9, 60)
    assert run(spark, rows) == brute(rows)


def test_exact_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, left, right = 999_999_999_999, 1_000_000_000_000, 1_000_000_000_001
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(c._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)

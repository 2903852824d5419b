"""Repeated strings against a count of all strings in plain Python."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import suffixes as s

SMALL = s.Repeats(length=40, window=20)


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()),
                    sha256(kept).hexdigest(), kept))
    return out


def check(spark, texts, how=SMALL, ids=None):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in zip(ids, texts)],
                                 "doc_id long, text string, spans string, k1 int").repartition(3)
    found = s.without_repeats(docs, how, keep_text=True)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    rows = sorted(((r[0], *r[1:5], bytes(r[5])) for r in found.collect()), key=str)
    assert rows == sorted(((i, *b) for i, b in zip(ids, brute(texts, how.length))), key=str)
    return rows


def passages(seed, n=40, alphabet="abé "):
    """Texts that share passages of about the length in question, cut and
    edited in many ways."""
    r = random.Random(seed)
    word = lambda k: "".join(r.choice(alphabet + "cdefgh") for _ in range(k))
    shared = [word(r.randrange(30, 160)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(1, 5)):
            p = r.choice(shared)
            a, b = sorted((r.randrange(len(p) + 1), r.randrange(len(p) + 1)))
            p = r.choice([p, p, p[a:b], p[:a] + r.choice("xyz") + p[a:]])
            parts.append(word(r.choice([0, 1, 1, 60])) + p + word(r.choice([0, 1, 50])))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    assert any(0 < r[2] < r[1] for r in check(spark, passages(seed)))


def test_hot_cores_are_counted_by_string(spark, monkeypatch):
    monkeypatch.setattr(s, "HOT", 2)
    check(spark, passages(3))


def test_many_buckets_small_chunks_and_flushes(spark, monkeypatch):
    texts = passages(4) + ["q" * 5 + passages(5)[0] * 4]
    runs = {}
    for size in (1 << 20, 64):  # texts are cut into overlapping parts
        monkeypatch.setattr(s, "CHUNK_BYTES", size)
        starts = Counter()
        for which, lo, a, hi, core, digest in s.runs_of([t.encode() for t in texts], SMALL):
            for row in zip(which.tolist(), lo.tolist(), a.tolist(), hi.tolist(), core.tolist()):
                starts.update((row[0], p, row[2], row[4]) for p in range(row[1], row[3] + 1))
        runs[size] = starts
    assert runs[64] == runs[1 << 20] and max(runs[64].values()) == 1
    monkeypatch.setattr(s, "BUCKET_BYTES", 500)
    monkeypatch.setattr(s, "CHUNK_BYTES", 64)
    monkeypatch.setattr(s, "HELD_BYTES", 300)
    check(spark, texts)


def test_periodic_repeated_null_and_long_texts(spark):
    texts = ["a" * 300, "ab" * 100, "aab" * 50, None, "", "short", "x" * 39, "y" * 40, "y" * 40, "z" * 40]
    texts += ["same text that is long enough to count, twice"] * 2 + ["é" * 30_000]
    check(spark, texts, ids=[5, 5, None, None, 1, 2, 3, 4, 4, 6, 7, 7, 8])


def test_empty_tables_and_production_settings(spark):
    check(spark, [])
    check(spark, [None, ""])
    r = random.Random(7)
    prose = lambda k: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(k))
    shared = prose(150)
    check(spark, [prose(200) + shared + prose(50), shared[:399], shared[:400], prose(10) + shared[100:], prose(300)],
          s.Repeats())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=12), max_size=8), min_size=1, max_size=9))
def test_loser_tree_merges_and_knows_common_prefixes(lists):
    runs = []
    for strings in map(sorted, lists):
        same, more, rest = s.front_coded(strings)
        assert s.decoded(same, more, rest) == strings
        runs.append((strings, same.tolist()))
    order, same = s.merged(runs)
    merged = [runs[r][0][i] for r, i in order]
    assert merged == sorted(b for strings in lists for b in strings)
    expected = [0] + [len(a) if a == b else next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                      for a, b in zip(merged, merged[1:])]
    assert same.tolist() == expected[:len(merged)]


def test_known_prefixes_are_not_compared_again(monkeypatch):
    asked = []
    inner = s.shared
    strings = [[b"p" * 1000 + bytes([k, j]) for j in range(50)] for k in range(8)]
    runs = [(x, s.front_coded(x)[0].tolist()) for x in strings]
    monkeypatch.setattr(s, "shared", lambda a, b, h: asked.append(inner(a, b, h) - h) or inner(a, b, h))
    s.merged(runs)
    assert sum(asked) < 10 * 1000  # 8 first strings meet from the start, the other 392 from byte 1000 on

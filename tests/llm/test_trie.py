"""The conversation prefix trie against a trie in plain Python."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from marquee.llm import trie as t

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def own_turns(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def swapped(convs):
    out = {}
    for c, turns in convs.items():
        h = crc32(str(c).encode()) % 6
        rest = abs(c) % 100 * (1 if c > 0 else -1)
        out[c] = convs.get(c - rest, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for path, inside in members.items():
        below = [p for p in members if p[:len(path)] == path]
        parents = {p[:-1] for p in members if p}
        ends = sorted(c for c in inside if len(convs[c]) == len(path))
        out.append((min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside),
                    sum(len(p) == len(path) + 1 for p in below), sum(p not in parents for p in below),
                    sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                    sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows],
                                 "conv_id long, turn long, role string, text string, depth string, x1 int")


def run(df, operator):
    found = operator(df)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=str)


def talk(seed, convs=60, kinds=3, most=30):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-40, 400), convs):
        for i in range(r.randrange(1, most)):
            rows.append((c, r.choice([i, i, i, None, i // 2]) if r.random() < 0.1 else i,
                         r.choice(["user", "user", None]), r.choice(["é" * k for k in range(kinds)] + [None])))
    return rows


@pytest.mark.parametrize("block,chunk", [(8, 64), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(t, "CHUNK", chunk)
    monkeypatch.setattr(t, "IDS", 3)
    rows = talk(1) + [(500, i, "u", "same") for i in range(40)] + [(501, i, "u", "same") for i in range(40)]
    rows += [(502, i, "u", "same") for i in range(21)] + [(None, 1, "u", "lost")]
    rows += [(600 + k, 0, "u", "hi") for k in range(12)]  # a conversation many times
    df = frame(spark, rows)
    convs = own_turns(rows)
    turns = t.placed(df)
    plain = t.trie(turns, turns.select("conv").distinct(), block)
    assert sorted(map(tuple, plain.collect()), key=str) == brute(convs)
    assert run(df, t.rebuilt_trie) == brute(swapped(convs))


def test_repeated_rows_and_ties(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, None, "u", "a"), (2, 0, "u", "a"), (3, 0, "u", "b"),
            (3, 0, "u", "a"), (4, 0, None, "a"), (4, 1, "", None)]
    assert run(frame(spark, rows), t.prefix_trie) == brute(own_turns(rows))


def test_empty_and_turnless(spark):
    assert run(frame(spark, []), t.prefix_trie) == [] == run(frame(spark, [(None, 1, "u", "x")]), t.rebuilt_trie)
    rows = [(c, 0, "u", "x") for c in range(101, 140)]  # nobody lends, most have no turn left
    convs = swapped(own_turns(rows))
    assert any(not v for v in convs.values())
    assert run(frame(spark, rows), t.rebuilt_trie) == brute(convs)


def test_a_text_may_be_long_and_boundaries_of_roles_count(spark):
    rows = [(1, 0, "ab", "c" * 200_000), (2, 0, "a", "b" + "c" * 200_000), (3, 0, "ab", "c" * 200_000)]
    assert run(frame(spark, rows), t.prefix_trie) == brute(own_turns(rows))

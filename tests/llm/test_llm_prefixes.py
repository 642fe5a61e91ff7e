"""The trie of conversations against one made of dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratepanel.llm import prefixes
from ratepanel.llm.frames import ship

TURNS = "conv_id long, turn long, role string, text string, path string, words int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def made(seed=1, hot=60):
    """Shared beginnings, one conversation many times, a long one, nulls."""
    rnd = random.Random(seed)
    rows = []
    for i in range(150):
        for t in range(rnd.choice([1, 1, 2, 3, 6])):
            rows.append((i * 3, t, rnd.choice(["user", "assistant"]), rnd.choice(["hi", "hi there", "", "a b c"])))
    for i in range(hot):
        rows += [(1000 + i, 0, "user", "same again"), (1000 + i, 1, "assistant", "yes it is"), (1000 + i, 2, "user", "ok")]
    rows += [(2000, t, "user", f"long {t % 3}") for t in range(700)] + [(2001, t, "user", f"long {t % 3}") for t in range(699)]
    rows += [(3000, 5, None, None), (3000, None, "user", "first"), (3000, 2, "", "é\x0b日本 x"), (None, 1, "user", "nobody's")]
    rows += [(3001, 1, "user", "twice"), (3001, 1, "user", "twice"), (-5, 0, "user", "hi"), (10**15, 0, "user", "hi")]
    rnd.shuffle(rows)
    return rows


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def lists_of(rows):
    found = defaultdict(list)
    for own, turn, role, text in rows:
        if own is not None:
            role, text = role or "", text or ""
            found[own].append((turn is not None, turn or 0, digest(role, text), role, text))
    return {own: [(role, text) for *_, role, text in sorted(turns)] for own, turns in found.items()}


def brute(lists):
    members = defaultdict(list)
    for own, turns in lists.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(own)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^ \t-\r]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + (len(members[node]) - 1) * words
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(lists[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        sums = (len(own), len(children[node]), leaves[node], saved[node])
        out.append((min(own), len(node), above, *sums, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1) for r in rows], TURNS)


def found(df):
    assert df.columns == prefixes.COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ways", [1, 3, 40])
def test_equals_brute_force(spark, ways, monkeypatch):
    monkeypatch.setattr(prefixes, "IDS", 7)
    rows = made()
    lists = prefixes.turn_lists(frame(spark, rows))
    assert found(prefixes.trie(prefixes.paths(lists), ways)) == brute(lists_of(rows))


def test_splitters_deeper_than_their_bound(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "DEPTH", 2)
    rows = made(2, 200)
    lists = prefixes.turn_lists(frame(spark, rows))
    assert found(prefixes.trie(prefixes.paths(lists), 30)) == brute(lists_of(rows))


def test_heads_of_the_base(spark):
    rows = made(3)
    lists, want = lists_of(rows), {}
    for own in lists:
        h = zlib.crc32(str(own).encode()) % 4
        want[own] = lists.get(own - own % 20, [])[:h] + lists[own][h:]
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    rebuilt = prefixes.with_heads(prefixes.turn_lists(frame(spark, rows), near=20), 3, shared)
    assert any(not turns for turns in want.values())
    assert found(prefixes.trie(prefixes.paths(rebuilt), 8)) == brute(want)


def test_equal_conversations_fall_to_several_shards(spark):
    path = b"0123456789abcdef" * 3
    sample = [(path, i) for i in range(90)] + [(b"z" * 16, 100 + i) for i in range(10)]
    splitters = prefixes.choose_splitters(sample, 10)
    assert len([s for s in splitters if s[0] == path]) >= 8
    skeleton = prefixes.Skeleton(splitters)
    assert len(skeleton.parents) <= 1 + 3 + 1


def test_skeleton_numbers_subtrees_as_ranges():
    a, b, c = (x * 16 for x in (b"a", b"b", b"c"))
    skeleton = prefixes.Skeleton([(a + b, 1), (a + c, 1), (b, 1), (b + a + c, 1)])
    assert skeleton.rows() == [(0, None, 6, 2), (1, 0, 3, 2), (2, 1, 2, 0), (3, 1, 3, 0), (4, 0, 6, 1), (5, 4, 6, 1), (6, 5, 6, 0)]


def test_no_conversations(spark):
    lists = prefixes.turn_lists(frame(spark, []))
    assert prefixes.trie(prefixes.paths(lists)).count() == 0
    nobody = prefixes.turn_lists(frame(spark, [(None, 1, "user", "hi")]))
    assert prefixes.trie(prefixes.paths(nobody)).count() == 0

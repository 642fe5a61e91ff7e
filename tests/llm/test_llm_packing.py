"""Packing: the plan for a histogram, and the ids of every piece against the tokenizer."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path as vocabulary
from tokenizers import Tokenizer

from ratepanel.llm import packing
from ratepanel.llm.frames import ship

WORDS = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def filled(counts, window):
    """The sequences that a layout makes, as their parts."""
    layout, found = packing.Layout(counts, window), defaultdict(list)
    lengths = np.repeat(np.arange(window + 1), counts)
    ranks = np.concatenate([np.arange(c) for c in counts]) if counts.sum() else np.zeros(0, np.int64)
    pieces = defaultdict(list)
    for row, begin, size, sequence, offset in layout.places(lengths, ranks):
        pieces[row].append((begin, size))
        found[sequence].append((offset, size))
    assert len(pieces) == len(lengths)
    for row, own in pieces.items():
        own.sort()
        assert own[0][0] == 0 and sum(s for _, s in own) == lengths[row]
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
    for own in found.values():
        own.sort()
        assert own[0][0] == 0
        assert all(a[0] + a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
    return layout, [sum(s for _, s in own) for own in found.values()], sum(map(len, pieces.values()))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("most", [1, 3, 400])
def test_every_piece_has_one_place_and_nothing_is_padded(seed, most):
    rnd = np.random.default_rng(seed)
    counts = rnd.integers(0, most + 1, 65)
    counts[0] = 0
    if seed == 5:
        counts[:] = 0
        counts[37] = most
    layout, sizes, parts = filled(counts, 64)
    assert sum(sizes) == int((counts * np.arange(65)).sum())
    assert all(s <= 64 and s & (s - 1) == 0 for s in sizes)
    assert sorted(sizes)[-1:] != [64] or sum(s < 64 for s in sizes) <= 6
    # A window's end cuts at most one piece.
    assert parts <= counts.sum() + len(sizes)


def test_least_squares_finds_the_counts_that_made_a_histogram():
    made = {(0, 24, 40): 900, (10, 20, 34): 500, (5, 5, 54): 300, (0, 0, 64): 77}
    counts = np.zeros(65, np.int64)
    for own, times in made.items():
        for n in own:
            counts[n] += times if n else 0
    combos = packing.combinations(np.flatnonzero(counts), 64)
    assert all(sum(c) == 64 for c in combos.tolist())
    used = packing.solve(counts, combos)
    assert used.min() >= 0
    assert {tuple(c): round(u) for c, u in zip(combos.tolist(), used, strict=True) if round(u)} == made
    layout, sizes, parts = filled(counts, 64)
    assert layout.solved == counts.sum() == parts
    assert set(sizes) == {64}


def texts():
    rnd = random.Random(4)
    words = ["The", "the", "naïve", "ΟΔΥΣΣΕΥΣ", "é", "日本語", "it's", "IT'S", "3.14", "a b", "x y", "<|endoftext|>", "<|ENDOFTEXT|>", "--", "\x1c", "İ"]
    out = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 40, 900]))) for _ in range(40)]
    return out + ["\t\x0b \n a \r\n\x0cb", "w" * 5000, "y " * 30000]


def test_ids_are_those_of_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 1000)
    whole = Tokenizer.from_file(WORDS)
    words = packing.WordTokenizer(open(WORDS).read())
    for text in texts():
        assert np.frombuffer(words.encode(text.encode()), words.kind).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_pieces_of_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 5)
    rows = [*enumerate(texts()), (900, None), (901, ""), (901, ""), (None, "no id"), *[(1000 + i, "one two three") for i in range(40)]]
    docs = spark.createDataFrame([(i, t, 5, "x", 2) for i, t in rows], "doc_id long, text string, start int, ids string, length int")
    whole = Tokenizer.from_file(WORDS)
    packed = packing.pack(docs, WORDS, window=256)
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    found, sequences = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        ids = np.frombuffer(bytes(r.ids), "<u2").tolist()
        assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        found[r.doc_id].append((r.start, r.doc_tokens, ids))
        sequences[r.sequence_id].append((r.offset, ids))
    assert sorted(found.pop(901)) == [(0, 1, [1])] * 2
    want = {i: whole.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows if i != 901}
    assert {i: [n for p in sorted(own) for n in p[2]] for i, own in found.items()} == want
    assert all(p[1] == len(want[i]) for i, own in found.items() for p in own)
    for own in sequences.values():
        own.sort()
        ends = np.cumsum([len(ids) for _, ids in own]).tolist()
        assert [o for o, _ in own] == [0, *ends[:-1]]
        assert ends[-1] == 256 or ends[-1] & (ends[-1] - 1) == 0
    whole_rows = packing.sequences(packed, 256).collect()
    assert {r.sequence_id: np.frombuffer(bytes(r.ids), "<u2").tolist() for r in whole_rows} == {s: [n for _, ids in own for n in ids] for s, own in sequences.items()}
    assert all(r.n_padded == r.n_tokens for r in whole_rows)


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    packed = packing.pack(none, WORDS)
    assert packed.count() == 0 and packing.sequences(packed).count() == 0

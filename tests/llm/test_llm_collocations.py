"""Collocations against brute force, also with fingerprints so short that most collide."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratepanel.llm import collocations
from ratepanel.llm.frames import ship

DOCS = "doc_id long, text string, lang string, n string, words int, chunk string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def corpus():
    rnd = random.Random(2)
    words = ["the", "The", "of", "a", "naïve", "日本", "x-y", "\x00z", "b\x1fc", "New", "york", "city", "'tis"]
    glue = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; ", "!\r\n", "\x0b"]
    rows = []
    for i in range(120):
        said = []
        for _ in range(rnd.choice([0, 1, 2, 30, 90])):
            said += ["new", " ", "YORK", " \t", "city"] if rnd.random() < 0.1 else [rnd.choice(words)]
            said.append(rnd.choice(glue))
        rows.append(("".join(said), rnd.choice(["en", "en", "en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", "de"), (" \n.,", "es"), ("a a a a a a a a", "fr"), ("the of " * 4000, "en")]


def brute(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    often = {k: a for k, a in counts.items() if a >= least}
    found = {}
    for (lang, p), a in often.items():
        inside = any(
            q_lang == lang and len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for (q_lang, q), b in often.items()
        )
        if len(p) < 2 or inside:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = often[lang, p[:k]], often[lang, p[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    out = []
    for lang, own in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out), often


def frame(spark, rows):
    return spark.createDataFrame([(1, t, g, "x", 3, "y") for t, g in rows], DOCS)


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    want, _ = brute(rows, 4, 5, 30)
    got = collocations.collocations(frame(spark, rows).repartition(3), least=4, top=30)
    assert got.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == want
    assert {r[0] for r in want} == {"en", "fr", "und"}


@pytest.mark.parametrize("fan", [5, 1000])
@pytest.mark.parametrize("bits", [9, 12, 48])
def test_colliding_fingerprints_are_told_apart_by_their_text(spark, monkeypatch, bits, fan):
    monkeypatch.setattr(collocations, "RANGE", 500)
    monkeypatch.setattr(collocations, "FAN", fan)
    rows = corpus()
    _, often = brute(rows, 7, 4, 1)
    chunked = collocations.chunks(frame(spark, rows).repartition(4))
    got = collocations.frequent(chunked, 7, 4, bits)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in got.collect()} == often
    assert all(len(r.phrase.split(" ")) == r.words for r in got.collect())


def test_long_texts_are_cut_between_pieces_only(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 50)
    text = collocations.normal("One two three. " * 40 + "word " * 30 + ". end")
    parts = list(collocations._parts(text))
    assert b"\n".join(parts) == text
    assert all(len(p) <= 50 or b"\n" not in p[:51] for p in parts)
    assert max(map(len, parts)) >= 150


def test_spans_and_fingerprints():
    text = collocations.normal("a b  A\tB. b a\n\na b c")
    spans = collocations.Spans(text)
    assert [spans.phrase(i, 1) for i in range(len(spans.begin))] == [b"a", b"b", b"a", b"b", b"b", b"a", b"a", b"b", b"c"]
    grams = {n: (at.tolist(), marks.tolist()) for n, at, marks in spans.grams("en", 5, 48)}
    assert [spans.phrase(i, 2) for i in grams[2][0]] == [b"a b", b"b a", b"a b", b"b a", b"a b", b"b c"]
    assert [len(set(grams[n][1])) for n in (1, 2, 3)] == [3, 3, 3]
    assert grams[5] == ([], [])
    assert not set(grams[2][1]) & {m for _, _, marks in spans.grams("de", 5, 48) for m in marks.tolist()}


@pytest.mark.parametrize("a, left, right, n", [(10**12, 10**12, 10**13, 10**17), (100, 101, 3 * 10**9, 10**15), (7, 7, 7, 7), (2**40, 2**41, 2**42 - 1, 2**55 + 3)])
def test_scores_beyond_64_bits_are_exact(spark, a, left, right, n):
    row = spark.createDataFrame([(a, left, right, n)], "a long, l long, r long, n long")
    assert row.select(collocations.score(F.col("a"), F.col("l"), F.col("r"), F.col("n"))).first()[0] == 1000 * a * n // (left * right)


def test_no_documents(spark):
    assert collocations.collocations(frame(spark, []), least=1).count() == 0
    assert collocations.collocations(frame(spark, [(None, None)]), least=1).count() == 0

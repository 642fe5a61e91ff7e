"""Benchmark decontamination with Aho-Corasick automata over words.

Texts are normalised to words: letters A-Z lowered, words made of digits,
letters and everything beyond ASCII. All windows of ten consecutive words of the
items (a shorter item is one window) go into one automaton whose alphabet is the
items' words, so it grows with the number of windows and not with their letters.
A text's words are numbered and scanned once; hits are word positions, which
`hit_spans` maps to offsets of the original text.

The automaton is broadcast. Its size is checked first: beyond MAX_WINDOWS
windows these are dealt by hash into as many automata as needed, each scan adds
its hits, and the hits of a document are united.

Defined cases: null or blank texts have no words and hit nothing; an item without
words has no window; items with the same text hit together; repeated item ids
count once, and an item without id marks words but isn't counted. Rows are
scanned one by one, so repeated documents give repeated rows and null ids are
kept; empty tables give an empty result or no hits. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratepanel.llm.frames import cut, fresh
from ratepanel.llm.words import made, texts

WIDTH = 10
#: Windows of one automaton. A window takes about 2 KB in a Python worker.
MAX_WINDOWS = 100_000
_LOWER = bytes(range(256)).lower()
#: Bytes below 128 that are no letter or digit, after lowering.
_GAPS = bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A))
_TO_WORDS = bytes(0x20 if b in _GAPS else b for b in _LOWER)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def normal_words(text: bytes) -> list[bytes]:
    """Lowered words; the bytes of characters beyond ASCII belong to words."""
    return text.translate(_TO_WORDS).split()


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """`window array<string>, items array<string>`: each window once, with the ids of its items."""

    @F.arrow_udf("array<array<string>>")
    def cut(column: pa.Array) -> pa.Array:
        rows = []
        for t in texts(column):
            words = normal_words(t)
            rows.append([words[i : i + width] for i in range(max(1, len(words) - width + 1))] if words else [])
        return pa.array(rows, pa.list_(pa.list_(pa.binary()))).cast(pa.list_(pa.list_(pa.string())))

    cuts = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.explode(cut(F.col(f"`{text}`").cast("string"))).alias("window"))
    return cuts.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Finder:
    """One automaton over windows of words."""

    def __init__(self, rows: list[tuple[list[str], list[str]]]):
        self.numbers: dict[bytes, int] = {}
        self.items = [items for _, items in rows]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for at, (window, _) in enumerate(rows):
            key = tuple(self.numbers.setdefault(w.encode(), len(self.numbers) + 1) for w in window)
            self.automaton.add_word(key, (at, len(key)))
        if rows:
            self.automaton.make_automaton()

    def hits(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(first word, word after the last, row of the window) of every occurrence."""
        if not self.items:
            return []
        number = self.numbers.get
        found = self.automaton.iter(tuple([number(w, 0) for w in words]))
        return [(end + 1 - length, end + 1, at) for end, (at, length) in found]


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def hit_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original text of spans of words."""
    if not spans:
        return []
    where = [m.span() for m in _WORD.finditer(text)]
    return [(where[begin][0], where[end - 1][1]) for begin, end in spans]


_FOUND = "n_words long, spans array<struct<first:long,after:long>>, items array<string>"
_SPAN = pa.struct([("first", pa.int64()), ("after", pa.int64())])
_TYPE = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])

def _scan(shared) -> Column:
    @F.arrow_udf(_FOUND)
    def scan(column: pa.Array) -> pa.Array:
        finder, rows = made(shared.value, Finder), []
        for text in texts(column):
            words = normal_words(text)
            hits = finder.hits(words)
            items = sorted({i for _, _, at in hits for i in finder.items[at]})
            rows.append({"n_words": len(words), "spans": [{"first": a, "after": b} for a, b in covered([h[:2] for h in hits])], "items": items})
        return pa.array(rows, _TYPE)

    return scan.asNondeterministic()


def _slices(benchmark: DataFrame, item: str, text: str, width: int, most: int) -> list:
    """Broadcast windows, at most about `most` in each."""
    spark = benchmark.sparkSession
    found = windows(benchmark, item, text, width)
    total = found.count()
    parts = max(1, -(-total // most))
    if parts > 1:
        found = cut(found)
    out = []
    for part in range(parts):
        mine = found if parts == 1 else found.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        rows = [(list(r.window), list(r["items"])) for r in mine.collect()]
        out.append(spark.sparkContext.broadcast(rows))
    return out


def _unite(parts: list[Column]) -> Column:
    """One struct of what several automata found in a text."""
    if len(parts) == 1:
        return parts[0]
    spans = F.array_sort(F.flatten(F.array(*[p["spans"] for p in parts])))
    last = lambda acc: F.element_at(acc, -1)
    empty = F.array().cast("array<struct<first:long,after:long>>")
    joined = F.aggregate(
        spans,
        empty,
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["first"] <= F.try_element_at(acc, F.lit(-1))["after"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(last(acc)["first"].alias("first"), F.greatest(last(acc)["after"], s["after"]).alias("after"))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[p["items"] for p in parts]))))
    return F.struct(parts[0]["n_words"].alias("n_words"), joined.alias("spans"), items.alias("items"))


def _found(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, width: int, most: int, name: str) -> DataFrame:
    """The documents with a struct column of what was found."""
    names, plain = [], F.col(f"`{text}`").cast("string")
    out = docs
    for shared in _slices(benchmark, item, item_text, width, most):
        names.append(fresh(out, f"{name}{len(names)}"))
        out = out.withColumn(names[-1], _scan(shared)(plain))
    return out.withColumn(name, _unite([F.col(n) for n in names])).drop(*names)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    most: int = MAX_WINDOWS,
) -> DataFrame:
    """Id, number of words, spans of hit words (`first`, `after`) and sorted ids of the items that occur."""
    narrow = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = _found(narrow, benchmark, "text", item, item_text, width, most, "found")
    return found.select(F.col("id").alias(id_column), "found.*")


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and a digest of the item ids for each document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return found.select(
        f"`{id_column}`",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", most: int = MAX_WINDOWS) -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    name = fresh(docs, "found")
    found = _found(docs, benchmark, text, "item_id", "text", WIDTH, most, name)
    return found.where(F.size(F.col(f"`{name}`.spans")) == 0).drop(name)


def items_digest(items: list[str]) -> str:
    """The digest of `digest` in plain Python, for tests and for callers with lists."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()

"""Phrase collocations by Rabin-Karp fingerprints of all n-grams.

Texts are normalised and put together in chunks of one language, which are
written once. Prefix polynomials in numpy give every n-gram of a chunk its
fingerprint in a few passes; repeats within the chunk are counted there. What
crosses the network is packed: for each range of fingerprints the sorted
differences and counts, with the chunk as pointer to the occurrences. The owner
of a range adds up the counts and tells each chunk which of its fingerprints are
frequent. The chunk's text then decides: occurrences are compared with each other
byte by byte, and only these phrases are written out, go to the owner of the
range again and are counted by their text, so two phrases of one fingerprint are
never mixed, however short it is. When there are more ranges than a chunk can be
cut into, they are dealt in two steps.

A fingerprint, phrase or language may hold any share of the words: it crosses
once for each chunk. Null texts are empty, null languages `und`; ids aren't
read, so repeated rows count as often as they stand there; other columns are
ignored; a table without rows gives none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratepanel.llm.frames import written
from ratepanel.llm.words import mix

#: Phrases of up to so many words are counted.
LONGEST = 5
#: Bytes of text in a chunk, and in all chunks that a task fills at once; memory bounds, without effect on rows.
CHUNK, OPEN = 4_000_000, 32_000_000
#: n-grams that one range of fingerprints holds, about, and ranges that a chunk is dealt to at once.
RANGE, FAN = 1 << 22, 1 << 14
#: Bits of a fingerprint.
BITS = 48
_BASE = 0x9E3779B97F4A7C17
_UNKNOWN = "und"
_SPACE, _BREAK = 0x20, 0x0A
_LOWER = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + b"\t.,;:!?\x0b\x0c\r",
    bytes(range(0x61, 0x7B)) + b" " + b"\n" * 9,
)
_SPACES = re.compile(rb" {2,}")

CHUNKS = "chunk long, lang string, n_words long, text binary"
PARTIALS = "range int, chunks binary, n int, width int, steps binary, counts binary, owners binary"
WANTED = "chunk long, wanted binary"
TOLD = "range int, lang string, phrases binary, counts binary"
PHRASES = "lang string, phrase string, words int, n long"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _schema(ddl)
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# Chunks.


def normal(text: str) -> bytes:
    """A-Z lowered, single spaces between words, a line for each piece."""
    plain = text.encode().translate(_LOWER)
    return _SPACES.sub(b" ", plain) if b"  " in plain else plain


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece ends."""
    begin = 0
    while len(text) - begin > CHUNK:
        end = text.rfind(b"\n", begin, begin + CHUNK)
        if end < 0:
            end = text.find(b"\n", begin + CHUNK)
        if end < 0:
            break
        yield text[begin:end]
        begin = end + 1
    yield text[begin:]


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    packer = zstandard.ZstdCompressor(level=1)
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    made = 0

    def close(lang: str) -> pa.RecordBatch:
        nonlocal made
        text = b"\n".join(held.pop(lang))
        del sizes[lang]
        made += 1
        return _batch([(first + made - 1, lang, len(Spans(text).begin), packer.compress(text))], CHUNKS)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for part in _parts(normal(text)) if text else ():
                if sizes.get(lang, 0) + len(part) > CHUNK and lang in held:
                    yield close(lang)
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
            if sum(sizes.values()) > OPEN:
                yield close(max(sizes, key=sizes.__getitem__))
    for lang in [*held]:
        yield close(lang)


# Fingerprints.


#: Powers of the base and of its inverse modulo 2 to the 64th, as many as this worker has needed.
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _first_powers(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            every = np.full(size, base, np.uint64)
            every[0] = 1
            _powers[i] = np.cumprod(every, out=every)
    return _powers


def _prefixes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomials of the values, and what divides a difference of two by the power it begins with."""
    up, down = _first_powers(1 << max(16, len(values).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


class Spans:
    """The words of a normal text: where they begin and end, and the piece each is in."""

    def __init__(self, text: bytes):
        self.text = np.frombuffer(b"\n" + text + b"\n", np.uint8)
        word = (self.text != _SPACE) & (self.text != _BREAK)
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        self.begin, self.end = edges[0::2], edges[1::2]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix polynomials over hashes of the words, which come from prefix polynomials over bytes."""
        sums, down = _prefixes(self.text.astype(np.uint64) + np.uint64(1))
        words = (sums[self.end] - sums[self.begin]) * down[self.begin]
        return _prefixes(mix(words + (self.end - self.begin).astype(np.uint64)))

    def grams(self, lang: str, longest: int, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of words: first words, and fingerprints, of all n-grams inside pieces."""
        pieces = np.cumsum(self.text == _BREAK)[self.begin]
        sums, down = self.hashes()
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        total = len(pieces)
        for n in range(1, longest + 1):
            at = np.flatnonzero(pieces[: total - n + 1] == pieces[n - 1 :]) if total >= n else np.zeros(0, np.int64)
            marks = (sums[at + n] - sums[at]) * down[at]
            marks ^= np.uint64((seed + n * _BASE) & (1 << 64) - 1)
            yield n, at, mix(marks) >> np.uint64(64 - bits)

    def same(self, one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
        """Whether n words from each first word of one have the bytes of those from two."""
        begins, others = self.begin[one], self.begin[two]
        sizes = self.end[one + n - 1] - begins
        equal = sizes == self.end[two + n - 1] - others
        rows, at = np.flatnonzero(equal), 0
        while len(rows):
            equal[rows] &= self.text[begins[rows] + at] == self.text[others[rows] + at]
            at += 1
            rows = rows[equal[rows] & (sizes[rows] > at)]
        return equal

    def phrase(self, first: int, n: int) -> bytes:
        return self.text[self.begin[first] : self.end[first + n - 1]].tobytes()


# Counting: from chunks to the owners of fingerprints, and back.


def _borders(ranges: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // ranges for i in range(ranges + 1)], np.uint64)


def _partials(ranges: int, longest: int, bits: int):
    """Fingerprints of each chunk with their counts, dealt by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, reader = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        borders = _borders(ranges, bits)
        for batch in batches:
            for chunk, lang, text in zip(*[batch.column(n).to_pylist() for n in ("chunk", "lang", "text")], strict=True):
                marks = np.concatenate([m for _, _, m in Spans(reader.decompress(text)).grams(lang, longest, bits)])
                marks, counts = np.unique(marks, return_counts=True)
                yield _rows(marks, counts, None, np.array([chunk], np.int64), borders, 0, packer)

    return run


def _rows(marks, counts, owners, chunks: np.ndarray, borders: np.ndarray, first: int, packer) -> pa.RecordBatch:
    """Sorted fingerprints, packed for each range; owners are places among the chunks, None where there is one."""
    cuts, rows = np.searchsorted(marks, borders), []
    for at in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[at], cuts[at + 1])
        told = b"" if owners is None else packer.compress(owners[own].astype("<i4").tobytes())
        rows.append((first + at, chunks.tobytes(), *_pack(marks[own], counts[own], borders[at], packer), told))
    return _batch(rows, PARTIALS)


def _finer(ranges: int, coarse: int, bits: int):
    """Rows of coarse ranges, which come in order, gathered from many chunks and dealt to the fine ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, reader = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        every, outer = _borders(ranges, bits), _borders(coarse, bits)
        held, size, at = [], 0, -1

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            marks, counts, owners = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(marks, kind="stable")
            chunks, owners = np.unique(owners[order], return_inverse=True)
            # The fine ranges that meet this coarse one; both are cut at the same multiples.
            low = int(np.searchsorted(every, outer[at], "right")) - 1
            high = int(np.searchsorted(every, outer[at + 1], "left"))
            held, size = [], 0
            return _rows(marks[order], counts[order], owners, chunks, every[low : high + 1], low, packer)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["range"] != at or size >= RANGE):
                    yield flush()
                at = row["range"]
                held.append(_unpack(row, int(outer[at]), reader))
                size += len(held[-1][0])
        if held:
            yield flush()

    return run


def _pack(marks: np.ndarray, counts: np.ndarray, border: np.uint64, packer) -> tuple[int, int, bytes, bytes]:
    """Sorted fingerprints as differences, byte by byte of all; counts as bytes, large ones behind them."""
    steps = np.diff(marks, prepend=border)
    width = 4 if steps.max() < 1 << 32 else 8
    planes = steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    large = counts >= 255
    told = np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<i8").tobytes()
    return len(marks), width, packer.compress(planes.tobytes()), packer.compress(told)


def _unpack(row: dict, border: int, reader) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, counts and chunks of a packed row."""
    n, width = row["n"], row["width"]
    planes = np.frombuffer(reader.decompress(row["steps"]), np.uint8).reshape(width, n).T
    marks = np.cumsum(np.ascontiguousarray(planes).view(f"<u{width}").ravel().astype(np.uint64)) + np.uint64(border)
    told = reader.decompress(row["counts"])
    found = np.frombuffer(told, np.uint8, n).astype(np.int64)
    found[found == 255] = np.frombuffer(told, "<i8", offset=n)
    chunks = np.frombuffer(row["chunks"], np.int64)
    owners = chunks[np.frombuffer(reader.decompress(row["owners"]), "<i4")] if row["owners"] else np.repeat(chunks, n)
    return marks, found, owners


def _met(ranges: int, least: int, bits: int):
    """Frequent fingerprints of a range, for each chunk that has them."""

    def run(table: pa.Table) -> pa.Table:
        reader, rows = zstandard.ZstdDecompressor(), []
        border = (table["range"][0].as_py() << bits) // ranges
        marks, counts, owners = (np.concatenate(c) for c in zip(*[_unpack(r, border, reader) for r in table.to_pylist()], strict=True))
        order = np.argsort(marks, kind="stable")
        marks = marks[order]
        heads = np.flatnonzero(np.diff(marks, prepend=marks[0] + np.uint64(1)))
        often = np.add.reduceat(counts[order], heads) >= least
        often = np.repeat(often, np.diff(np.append(heads, len(marks))))
        marks, owners = marks[often], owners[order[often]]
        order = np.argsort(owners, kind="stable")
        marks, owners = marks[order], owners[order]
        heads = np.flatnonzero(np.diff(owners, prepend=owners[:1] - 1))
        for begin, end in zip(heads, [*heads[1:], len(owners)], strict=False):
            rows.append((int(owners[begin]), marks[begin:end].tobytes()))
        return pa.Table.from_batches([_batch(rows, WANTED)])

    return run


def _told(ranges: int, longest: int, bits: int):
    """The phrases of a chunk whose fingerprints are frequent, with their counts there, packed by range."""

    def run(chunks: pa.Table, wanted: pa.Table) -> pa.Table:
        packer, reader, borders, rows = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor(), _borders(ranges, bits), []
        marked = np.unique(np.frombuffer(b"".join(wanted["wanted"].to_pylist()), np.uint64))
        home = np.searchsorted(borders, marked, "right") - 1
        for lang, text in zip(chunks["lang"].to_pylist(), chunks["text"].to_pylist(), strict=True):
            spans = Spans(reader.decompress(text))
            found: dict[int, list[tuple[bytes, int]]] = {}
            for n, at, marks in spans.grams(lang, longest, bits) if len(marked) else ():
                place = np.minimum(np.searchsorted(marked, marks), len(marked) - 1)
                hit = np.flatnonzero(marked[place] == marks)
                order = hit[np.argsort(place[hit], kind="stable")]
                at, place = at[order], place[order]
                # Occurrences unlike the first of their fingerprint go another round.
                while len(at):
                    heads = np.flatnonzero(np.diff(place, prepend=-1))
                    sizes = np.diff(np.append(heads, len(at)))
                    equal = spans.same(at, np.repeat(at[heads], sizes), n)
                    counts = np.add.reduceat(equal.astype(np.int64), heads)
                    for own, first, count in zip(home[place[heads]].tolist(), at[heads].tolist(), counts.tolist(), strict=True):
                        found.setdefault(own, []).append((spans.phrase(first, n), count))
                    at, place = at[~equal], place[~equal]
            for own, said in found.items():
                phrases, counts = zip(*said, strict=True)
                rows.append((own, lang, packer.compress(b"\n".join(phrases)), packer.compress(np.array(counts, "<i8").tobytes())))
        return pa.Table.from_batches([_batch(rows, TOLD)])

    return run


def _summed(least: int):
    """Phrases of a range that are frequent, by their text."""

    def run(table: pa.Table) -> pa.Table:
        reader, sums = zstandard.ZstdDecompressor(), {}
        for row in table.to_pylist():
            counts = np.frombuffer(reader.decompress(row["counts"]), "<i8").tolist()
            for phrase, count in zip(reader.decompress(row["phrases"]).split(b"\n"), counts, strict=True):
                key = (row["lang"], phrase)
                sums[key] = sums.get(key, 0) + count
        rows = [(lang, phrase.decode(), phrase.count(b" ") + 1, n) for (lang, phrase), n in sums.items() if n >= least]
        return pa.Table.from_batches([_batch(rows, PHRASES)])

    return run


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """`chunk, lang, n_words, text`: normal texts of a language, put together, compressed, and written."""
    told = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(_UNKNOWN)).alias("lang")
    return written(docs.select(told, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(_chunked, CHUNKS), "chunks")


def frequent(chunked: DataFrame, least: int, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """`lang, phrase, words, n`: all phrases of one to `longest` words that occur `least` times or more."""
    total = chunked.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, math.ceil(total * longest / RANGE))
    coarse = min(ranges, FAN)
    partials = chunked.mapInArrow(_partials(coarse, longest, bits), PARTIALS)
    if coarse < ranges:
        # A multiple, so that every fine range lies in one coarse range.
        ranges = math.ceil(ranges / coarse) * coarse
        partials = partials.repartition("range").sortWithinPartitions("range").mapInArrow(_finer(ranges, coarse, bits), PARTIALS)
    wanted = partials.groupBy("range").applyInArrow(_met(ranges, least, bits), WANTED)
    own = chunked.select("chunk", "lang", "text").groupBy("chunk")
    told = own.cogroup(wanted.groupBy("chunk")).applyInArrow(_told(ranges, longest, bits), TOLD)
    return told.groupBy("range").applyInArrow(_summed(least), PHRASES)


# Scores.


def score(a: Column, left: Column, right: Column, n: Column) -> Column:
    """floor(1000 a n / (l r)), exact: up to 38 digits, an error beyond."""

    def wide(count: Column, digits: int) -> Column:
        return count.cast(f"decimal({digits},0)")

    return F.call_function("div", wide(F.lit(1000), 4) * wide(a, 15) * wide(n, 18), wide(left, 18) * wide(right, 18))


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words or more with the lowest score of their cuts.

    Left out are phrases inside a longer one that is as frequent. It is enough
    to look one word further: what lies between the two is then as frequent.
    """
    known = phrases.select(F.col("lang").alias("in"), F.col("phrase").alias("part"), F.col("n").alias("often"))
    several = phrases.where(F.col("words") >= 2).withColumnRenamed("n", "a")
    within = [F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring(phrase, locate(' ', phrase) + 1)")]
    longer = several.where(F.col("words") >= 3).select(F.col("lang").alias("in"), "a", F.explode(F.array(*within)).alias("part"))
    longer = longer.groupBy("in", "part").agg(F.max("a").alias("most"))
    own = several.join(longer, (several.lang == longer["in"]) & (several.phrase == longer.part), "left")
    own = own.where(F.col("most").isNull() | (F.col("most") < F.col("a"))).select("lang", "phrase", "words", "a")
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    heads = known.select(F.col("in").alias("h_in"), F.col("part").alias("h_part"), F.col("often").alias("l"))
    tails = known.select(F.col("in").alias("t_in"), F.col("part").alias("t_part"), F.col("often").alias("r"))
    cuts = cuts.join(heads, (F.col("lang") == F.col("h_in")) & (F.col("head") == F.col("h_part")))
    cuts = cuts.join(tails, (F.col("lang") == F.col("t_in")) & (F.col("tail") == F.col("t_part")))
    sums = totals.select(F.col("lang").alias("n_in"), "n")
    cuts = cuts.join(sums, F.col("lang") == F.col("n_in"))
    best = F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r"), F.col("n")).alias("score"), "k", "l", "r", "n"))
    return cuts.groupBy("lang", "phrase", "words", "a").agg(best.alias("b")).select("lang", "phrase", "words", "a", "b.*")


def collocations(docs: DataFrame, least: int = 100, longest: int = LONGEST, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """The first phrases of each language by score: `lang, rank, phrase, a, l, r, n, score`, and the words and the cut."""
    chunked = chunks(docs, text, lang)
    phrases = written(frequent(chunked, least, longest), "phrases")
    rows = scored(phrases, chunked.groupBy("lang").agg(F.sum("n_words").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "words", "k")

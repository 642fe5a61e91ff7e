"""Packing of token sequences by non-negative least squares over the histogram of lengths.

Every text becomes ids, with an end id behind them, cut into pieces of a full
window and a rest. The histogram of the lengths has at most a window's number of
bins, whatever the corpus. Combinations of up to three lengths that fill a
window are enumerated, the number of times each is used is solved for by
non-negative least squares, rounded to what is there, and what is left is packed
greedily: longest first while lengths fit exactly, then end to end, cut where a
window ends. The last, unfilled window is split into powers of two, which need
no padding. So nothing is padded.

Pieces never meet on the driver: each gets its rank among the pieces of its
length (long groups are dealt out by a hash and their sizes added up), and its
place follows from the rank. Rows with null or empty texts are one end id. Rows
that repeat are packed each for itself; a null id is kept. Tables without rows
give none. Other columns of the table aren't read.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratepanel.llm.frames import written
from ratepanel.llm.words import Remember

WINDOW = 2048
END = 1
#: Bytes of a text that are cut into words at once; a memory bound, without effect on results.
BLOCK = 1 << 20
#: Words whose ids a Python worker remembers; a memory bound, without effect on results.
KNOWN = 1 << 20
#: Pieces of one length that one group ranks.
RUN = 1024
#: Rounds of the solver, and combinations looked at in each.
ROUNDS, PICKED = 400, 2048
#: Rank and length share a 64-bit key.
_RANKS = 1 << 48
_BLANK = re.compile(rb"[ \t-\r]")

TOKENS = "doc_id {id}, start long, length int, doc_tokens long, ids_crc32 long, ids binary"
PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


#: How a vocabulary file says that words are lower-cased runs of letters, digits apart, and runs of other signs.
_NORMALIZERS = {"NFC", "Replace", "Lowercase"}
_PATTERN = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
_SPLITS = [
    {"type": "Split", "pattern": _PATTERN, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Small letters that no normalizer of these changes, then signs but for the apostrophe.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")


def _letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next free one."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in visible]
    return {b: b for b in visible} | {b: 0x100 + i for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of texts by a vocabulary whose pre-tokenizer drops white space.

    No unit of such a vocabulary spans ASCII white space, so words are encoded
    one by one and frequent ones remembered. Where the file splits words as
    stated above, plain small letters go straight to its model.
    """

    def __init__(self, description: str):
        told = json.loads(description)
        self.tokenizer = Tokenizer.from_str(description)
        normalizer = told.get("normalizer") or {}
        steps = {s.get("type") for s in normalizer.get("normalizers", [normalizer])}
        # Words that differ in case only share their ids, but for special tokens, which are sought before.
        self.folds = "Lowercase" in steps
        self.special = [t["content"].encode().lower() for t in told.get("added_tokens", [])]
        self.plain = self.folds and steps <= _NORMALIZERS and (told.get("pre_tokenizer") or {}).get("pretokenizers") == _SPLITS
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.code = self.kind.char
        self.letters = _letters()
        self.known = Remember(self._word, KNOWN)
        self.signs = Remember(self._encode)

    def _encode(self, word: bytes) -> bytes:
        return array(self.code, self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()

    def _model(self, letters: str) -> bytes:
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if not self.plain:
            return self._encode(word)
        if word.isalpha() and word.islower():
            return self._model(word.decode())
        found = _PLAIN.fullmatch(word)
        if found is None:
            return self._encode(word)
        letters, signs = found.groups()
        if signs:
            return self.known[letters] + self.signs[signs]
        return self._model(letters.decode("latin-1").translate(self.letters))

    def encode(self, text: bytes) -> bytes:
        """The ids of a text, in the narrowest integers that hold the vocabulary."""
        known, out = self.known.__getitem__, []
        for block in _blocks(text):
            if self.folds:
                low = block.lower()
                if not any(s in low for s in self.special):
                    block = low
            out.append(b"".join(map(known, block.split())))
        return b"".join(out)


def _blocks(text: bytes) -> Iterator[bytes]:
    """The text in parts that end before white space."""
    begin = 0
    while len(text) - begin > BLOCK:
        found = _BLANK.search(text, begin + BLOCK)
        if found is None:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


#: The tokenizer of this Python worker by the digest of its file.
_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(digest: str, shared) -> WordTokenizer:
    if digest not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[digest] = WordTokenizer(shared.value)
    return _tokenizers[digest]


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every text with the end id, cut into full windows and a rest.

    `start` counts the document's ids before the piece; `ids` are little-endian
    integers of two bytes, four where the vocabulary is larger.
    """
    description = Path(vocabulary).read_text()
    digest = hashlib.sha256(description.encode()).hexdigest()
    # A vocabulary file is of fixed size: it doesn't grow with the data.
    shared = docs.sparkSession.sparkContext.broadcast(description)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(digest, shared)
        last = np.array([end], tokenizer.kind).tobytes()
        for batch in batches:
            rows = []
            for at, told in enumerate(batch.column(1).to_pylist()):
                ids = tokenizer.encode((told or "").encode()) + last
                width = len(last)
                for begin in range(0, len(ids), window * width):
                    own = ids[begin : begin + window * width]
                    rows.append((at, begin // width, len(own) // width, len(ids) // width, _crc(own, tokenizer.kind), own))
            if rows:
                at, *columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"]
                arrays = [batch.column(0).take(pa.array(at)), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    told = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return told.mapInArrow(run, TOKENS.format(id=told.schema["doc_id"].dataType.simpleString()))


def _crc(ids: bytes, kind: np.dtype) -> int:
    return zlib.crc32(np.frombuffer(ids, kind).astype("<u4").tobytes())


# The plan: from a histogram of lengths to places.


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths, ascending, that fill the window; unused places are 0."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    found = [np.array([[0, 0, window]])] if there[window] else []
    pairs = lengths[(2 * lengths <= window) & there[window - lengths]]
    found.append(np.column_stack([np.zeros_like(pairs), pairs, window - pairs]))
    for a in lengths[3 * lengths <= window]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[there[window - a - b]]
        found.append(np.column_stack([np.full_like(b, a), b, window - a - b]))
    return np.concatenate(found).astype(np.int64)


def solve(counts: np.ndarray, combos: np.ndarray) -> np.ndarray:
    """How often each combination is used: least squares against the counts, none negative.

    Descent by coordinates: each round takes the steps that lower the squared
    error most, among combinations without a common length, so that each is exact.
    """
    used = np.zeros(len(combos))
    if not len(combos):
        return used
    left = counts.astype(float)
    left[0] = 0
    a, b, c = combos.T
    # The squared norm of a column: a length that a combination holds twice counts four.
    weight = (a > 0) * 1.0 + (b > 0) + (c > 0) + 2.0 * ((a == b) & (a > 0)) + 2.0 * (b == c) + 2.0 * ((a == c) & (a > 0))
    for _ in range(ROUNDS):
        pull = left[a] + left[b] + left[c]
        step = np.maximum(pull / weight, -used)
        gain = step * (2 * pull - step * weight)
        most = min(PICKED, len(gain))
        best = np.argpartition(gain, -most)[-most:]
        best = best[gain[best] > 0.25]
        if not len(best):
            break
        best = best[np.argsort(-gain[best], kind="stable")]
        taken: set[int] = set()
        for at, own in zip(best.tolist(), combos[best].tolist(), strict=True):
            if taken.isdisjoint(n for n in own if n):
                taken.update(n for n in own if n)
                used[at] += step[at]
                for n in own:
                    left[n] -= step[at] if n else 0
    return used


class Layout:
    """Where the pieces of each length go, by their rank among them."""

    def __init__(self, counts: np.ndarray, window: int):
        """`counts[n]` pieces have length n, for n up to the window."""
        self.window = window
        left = counts.astype(np.int64).copy()
        lengths = np.flatnonzero(left)
        self._from = np.zeros(window + 1, np.int64)
        self._slots: list[tuple[int, int, int, int]] = []
        self.sequences = 0
        combos = combinations(lengths, window)
        used = np.rint(solve(left, combos)).astype(np.int64)
        for at in np.lexsort((np.arange(len(used)), -used))[: np.count_nonzero(used)].tolist():
            self._use([n for n in combos[at].tolist() if n], int(used[at]), left)
        self.solved = int(counts.sum() - left.sum())
        self._fill(left)
        self.fitted = self._from.copy()
        # What fits nowhere lies end to end on a line of windows, longest first.
        sizes = left * np.arange(window + 1)
        self.line = np.concatenate([np.cumsum(sizes[::-1])[::-1][1:], [0]])
        total = int(sizes.sum())
        self.full = total // window
        tail, edge = total % window, self.full * window
        self.edges = [edge]
        for power in (1 << k for k in range(window.bit_length(), -1, -1)):
            if tail & power:
                edge += power
                self.edges.append(edge)
        slots = np.array(sorted(self._slots), np.int64).reshape(-1, 4)
        self.keys = slots[:, 0] * _RANKS + slots[:, 1]
        self.begins, self.first, self.offsets = slots[:, 1], slots[:, 2], slots[:, 3]
        del self._slots, self._from

    def _use(self, own: list[int], times: int, left: np.ndarray) -> int:
        """Fill windows with a combination, as often as its pieces allow."""
        each = {n: own.count(n) for n in own}
        times = min([times, *[int(left[n]) // k for n, k in each.items()]])
        if times > 0:
            offset = 0
            for n in own:
                self._slots.append((n, int(self._from[n]), self.sequences, offset))
                self._from[n] += times
                left[n] -= times
                offset += n
            self.sequences += times
        return times

    def _fill(self, left: np.ndarray) -> None:
        """Longest first, then the longest that still fits, for as long as windows come out full."""
        for longest in range(self.window, 0, -1):
            while left[longest]:
                own, gap, spare = [longest], self.window - longest, left.copy()
                spare[longest] -= 1
                while gap:
                    fits = np.flatnonzero(spare[1 : gap + 1])
                    if not len(fits):
                        break
                    n = int(fits[-1]) + 1
                    own.append(n)
                    spare[n] -= 1
                    gap -= n
                if gap or not self._use(own, int(left[longest]), left):
                    break

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """Row, begin within the piece, length, sequence and offset of each part of the pieces."""
        rows = np.flatnonzero(ranks < self.fitted[lengths])
        at = np.searchsorted(self.keys, lengths[rows] * _RANKS + ranks[rows], "right") - 1
        sequences = self.first[at] + ranks[rows] - self.begins[at]
        yield from zip(rows.tolist(), [0] * len(rows), lengths[rows].tolist(), sequences.tolist(), self.offsets[at].tolist(), strict=True)
        for row in np.flatnonzero(ranks >= self.fitted[lengths]).tolist():
            length = int(lengths[row])
            begin = int(self.line[length] + (ranks[row] - self.fitted[length]) * length)
            end, done = begin + length, 0
            while begin < end:
                edge, home, origin = self._cell(begin)
                stop = min(end, edge)
                yield row, done, stop - begin, self.sequences + home, begin - origin
                done += stop - begin
                begin = stop

    def _cell(self, at: int) -> tuple[int, int, int]:
        """End, number and begin of the window, or last part of one, around a place on the line."""
        if at < self.edges[0]:
            home = at // self.window
            return (home + 1) * self.window, home, home * self.window
        for k, edge in enumerate(self.edges[1:]):
            if at < edge:
                return edge, self.full + k, self.edges[k]
        raise ValueError("beyond the line")


def _ranked(rows: DataFrame, histogram: DataFrame) -> DataFrame:
    """The pieces with their `rank`, from 0, among those of their length; any order does, if it stays."""
    # One row for each length: the window bounds their number.
    dealt = histogram.select("length", F.ceil(F.col("count") / RUN).cast("long").alias("ways"))
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("ways")).cast("int").alias("salt")
    salted = rows.join(F.broadcast(dealt), "length").select(*rows.columns, salt)
    groups = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("own"))
    before = F.sum("own").over(Window.partitionBy("length").orderBy("salt")) - F.col("own")
    begins = groups.select(F.col("length").alias("of_length"), F.col("salt").alias("of_salt"), before.alias("begin"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    numbered = salted.withColumn("within", F.row_number().over(order) - 1)
    same = (numbered.length == begins.of_length) & (numbered.salt == begins.of_salt)
    return numbered.join(begins, same).select(*rows.columns, (F.col("begin") + F.col("within")).alias("rank"))


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end: int = END, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence, their offset in it and their ids."""
    spark = docs.sparkSession
    rows = written(pieces(docs, vocabulary, window, end, id_column, text), "pieces")
    found = rows.groupBy("length").count().collect()
    counts = np.zeros(window + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["count"]
    histogram = spark.createDataFrame([(n, int(c)) for n, c in enumerate(counts) if c], "length int, count long")
    # Places are given by combinations of lengths, whose number the window bounds.
    shared = spark.sparkContext.broadcast(Layout(counts, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value
        for batch in batches:
            start, length, tokens, crc, ids, rank = batch.columns[1:]
            lengths, starts = length.to_numpy().astype(np.int64), start.to_numpy()
            every, crcs = ids.to_pylist(), crc.to_pylist()
            out = []
            for row, begin, size, sequence, offset in layout.places(lengths, rank.to_numpy()):
                own, check = every[row], crcs[row]
                if size < lengths[row]:
                    width = len(own) // int(lengths[row])
                    own = own[begin * width : (begin + size) * width]
                    check = _crc(own, np.dtype(f"<u{width}"))
                out.append((row, int(starts[row]) + begin, size, check, sequence, offset, own))
            if out:
                at, begins, sizes, checks, sequences, offsets, parts = zip(*out, strict=True)
                at = pa.array(at)
                long = [pa.array(c, pa.int64()) for c in (begins, sizes, checks, sequences, offsets)]
                arrays = [batch.column(0).take(at), *long[:3], tokens.take(at), *long[3:], pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=_names())

    return _ranked(rows, histogram).mapInArrow(run, PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _names() -> list[str]:
    return ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def sequences(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """`sequence_id, n_tokens, n_padded, ids`: the sequences, whole; padding is counted, not written.

    A sequence whose length is a power of two stays as it is, another is filled to the window.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    n = F.col("n_tokens")
    padded = F.when(n.bitwiseAND(n - 1) == 0, n).otherwise(F.lit(window).cast("long"))
    ids = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return joined.select("sequence_id", "n_tokens", padded.alias("n_padded"), ids.alias("ids"))

"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string exactly one token can end its encoding. The
table of these last tokens is filled from left to right: a token may end a
prefix when it is in the vocabulary and may follow the last token of the prefix
before it. Reading the table backwards gives the ids. As an entry depends only on
the bytes before it, bytes can be appended without touching what is there, and
an edit re-encodes only from the piece it falls in.

Two tokens may stand side by side when no merge across their border would have
come before the merges that build them. Over time the left token grows along its
right edge and the right token along its left edge, so it is enough to follow
these two edges in the order of ranks.

Defined cases: a null text is an empty one, which has no tokens; texts are never
cut; blanks of any length are encoded like other text. Rows are encoded one by
one, so repeated rows and null ids are kept as they are, and an empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratepanel.llm.words import Remember, made

#: Distinct pieces whose ids a Python worker remembers; a memory bound, without effect on results.
PIECES = 1 << 18
#: The same for words with what stands around them, and for pairs of tokens.
WORDS, PAIRS = 1 << 17, 1 << 17
#: The pattern of the given vocabularies, a fixed value; for it the codec's short way is known to hold.
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of texts whose words are encoded together; a memory bound, without effect on results.
AT_ONCE = 1 << 20
#: Bytes of the pieces whose tables are filled together, and slots for hashes of tokens and for pairs.
LONGEST, SLOTS = 32, 1 << 20
_NEVER = 1 << 62
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PrefixEncoder:
    """Encodes pieces with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], orderly: bool | None = None):
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._edges: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self._beside: dict[int, bool] = {}
        #: Whether merges make every token, so that only one can end a prefix.
        self.orderly = all(len(t) < 2 or self._halves(t) for t in ranks) if orderly is None else orderly

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """What the last merge of a token joined; None for a byte."""
        below = self.ranks[token]
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The tokens at one end of a token while it is built, each with the rank that ends it."""
        known = self._edges.get((token, right))
        if known is None:
            halves = self._halves(token)
            known = []
            if halves is not None:
                known = [*self._edge(halves[right], right)]
                known[-1] = (known[-1][0], self.ranks[token])
            known.append((token, _NEVER))
            self._edges[token, right] = known
        return known

    def beside(self, left: int, right: int) -> bool:
        """May the second token follow the first?"""
        lefts, rights = self._edge(self.token_bytes[left], True), self._edge(self.token_bytes[right], False)
        i = j = 0
        good = True
        while True:
            (a, a_ends), (b, b_ends) = lefts[i], rights[j]
            joined = self.ranks.get(a + b, _NEVER)
            if joined < a_ends and joined <= b_ends and joined < _NEVER:
                good = False
                break
            if a_ends == b_ends == _NEVER:
                break
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1
        if len(self._beside) >= PAIRS:
            self._beside.clear()
        self._beside[left << 32 | right] = good
        return good

    def extend(self, last: list[int], piece: bytes) -> list[int]:
        """Fill the table for the prefixes of a piece that it does not hold yet."""
        get, known, beside, longest = self.ranks.get, self._beside.get, self.beside, self.longest
        start = len(last) - len(self.token_bytes[last[-1]]) if last else 0
        for end in range(len(last) + 1, len(piece) + 1):
            token = get(piece[:end]) if end <= longest else None
            if token is not None:
                start = 0
                last.append(token)
                continue
            if start and self.orderly:
                # Where one token alone can end a prefix, the likeliest is tried first: the last one and a byte more.
                token = get(piece[start:end])
                if token is not None:
                    good = known(last[start - 1] << 32 | token)
                    if good is None:
                        good = beside(last[start - 1], token)
                    if good:
                        last.append(token)
                        continue
            places = range(end - longest if end > longest else 1, end)
            for begin in reversed(places) if self.orderly else places:
                token = get(piece[begin:end])
                if token is not None:
                    good = known(last[begin - 1] << 32 | token)
                    if good is None:
                        good = beside(last[begin - 1], token)
                    if good:
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
            start = begin
            last.append(token)
        return last

    def table(self, piece: bytes) -> list[int]:
        """The last tokens of all prefixes."""
        return self.extend([], piece)

    def read_back(self, last: list[int]) -> list[int]:
        """The ids that a table stands for."""
        ids, end, sizes = [], len(last), self.sizes
        while end:
            token = last[end - 1]
            ids.append(token)
            end -= sizes[token]
        ids.reverse()
        return ids

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token stands for itself."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.read_back(self.table(piece))


class PieceTables:
    """The tables of many pieces at once, prefix length by prefix length.

    Pieces lie in the order of their bytes, so what two of them begin with is filled
    once. A token is found by a hash of its bytes; the ids are held against the pieces
    at the end, and pieces with a wrong one (or long ones) take the encoder's plain way.
    """

    def __init__(self, encoder: PrefixEncoder):
        self.encoder = encoder
        count = max(encoder.token_bytes, default=-1) + 1
        tokens = [encoder.token_bytes.get(i, b"") for i in range(count)]
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.powers = _BASE ** np.arange(LONGEST + 1, dtype=np.uint64)
        ids = np.flatnonzero((self.sizes > 0) & (self.sizes <= LONGEST))
        hashes = self._prefixes([tokens[i] for i in ids])[self.sizes[ids], np.arange(len(ids))]
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        #: Which slots have a token, and what is known of pairs of tokens; later pairs push out earlier ones.
        self.seen = np.zeros(SLOTS, bool)
        self.seen[_slot(hashes)] = True
        self.pairs, self.good = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    @staticmethod
    def _letters(pieces: list[bytes]) -> np.ndarray:
        longest = max(map(len, pieces), default=1)
        return np.array(pieces, f"S{longest}").view(np.uint8).reshape(len(pieces), longest)

    def _prefixes(self, pieces: list[bytes]) -> np.ndarray:
        """Hashes by length of prefix and piece."""
        letters = self._letters(pieces)
        out = np.zeros((letters.shape[1] + 1, len(pieces)), np.uint64)
        for i in range(letters.shape[1]):
            out[i + 1] = out[i] * _BASE + letters[:, i] + np.uint64(1)
        return out

    def _tokens(self, hashes: np.ndarray) -> np.ndarray:
        """The token of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        likely = np.flatnonzero(self.seen[_slot(hashes)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
        out[likely] = np.where(self.hashes[at] == hashes[likely], self.ids[at], -1)
        return out

    def _beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """May the second tokens follow the first?"""
        pairs = left << 32 | right
        slots = _slot(pairs.view(np.uint64))
        good, new = self.good[slots], np.flatnonzero(self.pairs[slots] != pairs)
        if len(new):
            unknown, places = np.unique(pairs[new], return_inverse=True)
            known = self.encoder._beside.get
            verdicts = [(p, known(p)) for p in unknown.tolist()]
            told = np.array([self.encoder.beside(p >> 32, p & 0xFFFFFFFF) if v is None else v for p, v in verdicts], bool)
            good[new] = told[places]
            slots = _slot(unknown.view(np.uint64))
            self.pairs[slots], self.good[slots] = unknown, told
            # Of two pairs for one slot the last one is there.
            self.good[slots] = np.where(self.pairs[slots] == unknown, told, self.good[slots])
        return good

    def _fill(self, rows: np.ndarray, end: int, last: np.ndarray, hashes: np.ndarray) -> None:
        """The last tokens of these pieces' prefixes of one length."""

        def try_from(begin) -> None:
            nonlocal rows
            ends = hashes[end, rows] - hashes[begin, rows] * self.powers[end - begin]
            tokens = self._tokens(ends)
            found = np.flatnonzero((tokens >= 0) & (begin > 0))
            fits = (tokens >= 0) & (begin == 0)
            before = last[begin if np.isscalar(begin) else begin[found], rows[found]]
            fits[found] = self._beside(before, tokens[found])
            last[end, rows[fits]] = tokens[fits]
            rows = rows[~fits]

        try_from(0)
        if self.encoder.orderly and end > 1:
            # Where one token alone can end a prefix, the likeliest is tried first: the last one and a byte more.
            try_from(end - 1 - self.sizes[last[end - 1, rows]])
        for begin in range(1, end):
            if not len(rows):
                return
            try_from(begin)
        if len(rows):
            raise ValueError("the vocabulary lacks a byte")

    def _last(self, pieces: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """Last tokens by length of prefix and piece; the pieces are in order."""
        hashes, letters = self._prefixes(pieces), self._letters(pieces)
        differ = letters[1:] != letters[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), 0)
        same = np.concatenate([[0], np.minimum(common, np.minimum(lengths[1:], lengths[:-1]))])
        last = np.zeros(hashes.shape, np.int64)
        for end in range(1, len(last)):
            new = (same < end) & (lengths >= end)
            self._fill(np.flatnonzero(new), end, last, hashes)
            last[end] = last[end, np.maximum.accumulate(np.where(new, np.arange(len(pieces)), 0))]
        return last

    def _read_back(self, last: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each has."""
        steps, ends, rows = [], lengths.copy(), np.arange(len(lengths))
        counts = np.zeros(len(lengths), np.int64)
        while len(rows):
            tokens = last[ends[rows], rows]
            steps.append((rows, tokens))
            counts[rows] += 1
            ends[rows] -= self.sizes[tokens]
            rows = rows[ends[rows] > 0]
        after, ids = np.cumsum(counts), np.zeros(counts.sum(), np.int64)
        for i, (rows, tokens) in enumerate(steps, 1):
            ids[after[rows] - i] = tokens
        return ids, counts

    def _spelt(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        return self.bytes[np.repeat(self.begins[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())].tobytes()

    def packed(self, pieces: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each piece with its ids as little-endian unsigned 32-bit integers."""
        short, ranks = [], self.encoder.ranks
        for piece in pieces:
            if piece not in ranks and 0 < len(piece) <= LONGEST:
                short.append(piece)
            else:
                yield piece, array("I", self.encoder.encode(piece)).tobytes()
        if not short:
            return
        short.sort()
        lengths = np.array([len(p) for p in short], np.int64)
        ids, counts = self._read_back(self._last(short, lengths), lengths)
        if self._spelt(ids) != b"".join(short):
            for piece in short:
                yield piece, array("I", self.encoder.encode(piece)).tobytes()
            return
        row, after = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        for piece, begin, end in zip(short, [0, *after], after, strict=False):
            yield piece, row[begin:end]


class EncodedText:
    """The ids of a text that can be appended to and edited."""

    #: A match looks at most so many characters beyond its beginning, or two beyond its end.
    LOOK = 3

    def __init__(self, encoder: PrefixEncoder, pattern: str, text: str = ""):
        self.encoder, self.pattern, self.text = encoder, regex.compile(pattern), ""
        self.starts: list[int] = []
        self.tables: list[list[int]] = []
        self.append(text)

    def ids(self) -> list[int]:
        out = []
        for begin, end, table in zip(self.starts, self._ends(), self.tables, strict=True):
            whole = self.encoder.ranks.get(self.text[begin:end].encode())
            out += [whole] if whole is not None else self.encoder.read_back(table)
        return out

    def _ends(self) -> list[int]:
        return [*self.starts[1:], len(self.text)] if self.starts else []

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, begin: int, end: int, text: str) -> int:
        """Put a text in place of [begin, end); returns how many pieces were matched anew."""
        ends = self._ends()
        keep = len(self.starts)
        while keep and max(ends[keep - 1] + 2, self.starts[keep - 1] + self.LOOK) > begin:
            keep -= 1
        shift = len(text) - (end - begin)
        old_text, old_starts, old_tables = self.text, self.starts, self.tables
        self.text = old_text[:begin] + text + old_text[end:]
        starts, tables = old_starts[:keep], old_tables[:keep]
        at = old_starts[keep] if keep < len(old_starts) else len(old_text)
        anew, resume = 0, len(old_starts)
        for found in self.pattern.finditer(self.text, min(at, begin)):
            was = found.start() - shift
            if was >= end:
                same = bisect_left(old_starts, was)
                if same < len(old_starts) and old_starts[same] == was:
                    resume = same
                    break
            piece = found.group().encode()
            table: list[int] = []
            if anew == 0 and keep < len(old_starts):
                # The piece an append lengthens keeps the table of the bytes it had.
                had = old_text[old_starts[keep] : ends[keep]].encode()
                if found.start() == old_starts[keep] and piece.startswith(had):
                    table = old_tables[keep]
            starts.append(found.start())
            tables.append(self.encoder.extend(table, piece))
            anew += 1
        self.starts = starts + [s + shift for s in old_starts[resume:]]
        self.tables = tables + old_tables[resume:]
        return anew


#: Blanks that \\s stands for in patterns, fixed values; a border is sought only between other characters.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_BESIDE_SPACE = [" " + c for c in _BLANKS] + [c + " " for c in _BLANKS if c != " "]
_BESIDE_SPACE_ASCII = [pair for pair in _BESIDE_SPACE if pair.isascii()]
#: Below it all versions of Unicode have the same letters.
_NEWER = "\u0180"
_BORDER = re.compile(r"(?<=\S) (?=\S)")


def _segments(text: str) -> list[bytes]:
    """The text cut at each single space between two characters that aren't blank."""
    pairs = _BESIDE_SPACE_ASCII if text.isascii() else _BESIDE_SPACE
    if text[:1].isspace() or text[-1:].isspace() or any(pair in text for pair in pairs):
        return [segment.encode() for segment in _BORDER.split(text)]
    return text.encode().split(b" ")


def _runs(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Texts in runs of bounded length."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


class TextCodec:
    """Whole texts to packed ids and back, remembering frequent pieces.

    With `spaced`, every match of the pattern holds a space only as its first
    character or among blanks, so a single space between two other characters
    begins a match, and what follows it is matched alike wherever it stands.
    Then the ids of a word with its space are looked up as one. The words of a run
    of texts are encoded together, so that those that begin alike share a table.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool, orderly: bool | None = None):
        self.encoder, self.spaced = PrefixEncoder(ranks, orderly), spaced
        self.tables = PieceTables(self.encoder)
        self.words = Remember(self._word, WORDS)
        self.find = regex.compile(pattern).findall
        self.pieces = Remember(lambda piece: self._pack(self.encoder.encode(piece.encode())), PIECES)
        self.tokens = [self.encoder.token_bytes.get(i, b"") for i in range(max(self.encoder.token_bytes, default=-1) + 1)]

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _encode(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def _split(self, word: bytes) -> list[bytes]:
        """The pieces of a word with its space."""
        # Letters alone are one match, and marks after them another.
        letters = word.rstrip(b".,;:!?&%*#")
        text = letters.decode()
        if text.isalpha() and (text.isascii() or max(text) < _NEWER):
            return [b" " + letters, word[len(letters) :]] if len(letters) < len(word) else [b" " + word]
        return [piece.encode() for piece in self.find(" " + word.decode())]

    def _word(self, word: bytes) -> bytes:
        return self._encode(" " + word.decode())

    def _words(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of each word with its space."""
        out = self.words.recall(words)
        split = {word: self._split(word) for word in words if word not in out}
        pieces = dict(self.tables.packed(set().union(*split.values())))
        new = {w: pieces[own[0]] if len(own) == 1 else b"".join([pieces[p] for p in own]) for w, own in split.items()}
        self.words.keep(new)
        return out | new

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str], at_once: int = AT_ONCE) -> Iterator[bytes]:
        """The ids of each text, in turn."""
        if not self.spaced:
            yield from map(self._encode, texts)
            return
        for run in _runs(texts, at_once):
            cut = [_segments(text) for text in run]
            firsts = [segments.pop(0).decode() for segments in cut]
            known = self._words(set().union(*cut))
            for first, rest in zip(firsts, cut, strict=True):
                yield self._encode(first) + b"".join(map(known.__getitem__, rest))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(packed).cast("I")))


def _codec(shared) -> TextCodec:
    """The worker's codec for a broadcast vocabulary."""
    return made(shared.value, lambda value: TextCodec(*value))


def _share(spark: SparkSession, path: str, pattern: str):
    # A vocabulary file is of fixed size: it doesn't grow with the data.
    ranks = read_ranks(path)
    return spark.sparkContext.broadcast((ranks, pattern, pattern == SPACED_PATTERN, PrefixEncoder(ranks).orderly))


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and `ids array<int>` of every text."""
    shared = _share(docs.sparkSession, path, pattern)

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        codec = _codec(shared)
        texts = (t or "" for t in column.to_pylist())
        return pa.array([memoryview(packed).cast("I").tolist() for packed in codec.encode_all(texts)], pa.list_(pa.int32()))

    return docs.select(f"`{id_column}`", ids(F.col(f"`{text}`").cast("string")).alias("ids"))


def decode(encoded: DataFrame, path: str, pattern: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Id and `bytes binary` of every row of ids; null ids decode to nothing."""
    shared = _share(encoded.sparkSession, path, pattern)

    @F.arrow_udf("binary")
    def plain(column: pa.Array) -> pa.Array:
        codec = _codec(shared)
        return pa.array([codec.decode(array("I", row or []).tobytes()) for row in column.to_pylist()], pa.binary())

    return encoded.select(f"`{id_column}`", plain(F.col(f"`{ids}`")).alias("bytes"))


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
_TYPE = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_bytes", pa.int64())])


def digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text", at_once: int = AT_ONCE) -> DataFrame:
    """Id, number of tokens, and digests of the ids and of what they decode to.

    Encodes and decodes in one pass, so that no ids are moved. Words of texts of
    `at_once` characters are encoded together: more take less time and more memory.
    """
    shared = _share(docs.sparkSession, path, pattern)

    @F.arrow_udf(DIGESTS)
    def both(column: pa.Array) -> pa.Array:
        codec, rows = _codec(shared), []
        for packed in codec.encode_all((t or "" for t in column.to_pylist()), at_once):
            plain = codec.decode(packed)
            rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(plain).hexdigest(), len(plain)))
        columns = zip(*rows, strict=True) if rows else [[]] * len(_TYPE)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPE, strict=True)], fields=list(_TYPE))

    coded = docs.select(f"`{id_column}`", both(F.col(f"`{text}`").cast("string")).alias("coded"))
    return coded.select(f"`{id_column}`", "coded.*")

"""Quality rules: word and line counts, and compression bands.

A text is compressed whole and in fixed chunks. Text that repeats itself
compresses too well for its length, noise too badly; both limits depend on the
length, as a longer text gives the compressor more to refer to.

Defined cases: a null text is an empty one; a text without words has zero
counts, fails the base rules and has no ratio. Words are separated by the ASCII
blanks only. Rows are judged one by one, so repeated rows, ties and null ids get
the verdict of their text; an empty table gives an empty result. Extra columns
are ignored by `quality_table` and kept by `quality_filter`.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratepanel.llm.frames import keep_where
from ratepanel.llm.words import texts

LEVEL = 3
#: From so many bytes on: least and greatest ratio of plain to compressed bytes.
BANDS = (
    (0, 0.60, 2.40),
    (256, 1.00, 2.20),
    (512, 1.10, 2.20),
    (1024, 1.20, 2.25),
    (2048, 1.30, 2.35),
    (4096, 1.40, 2.45),
    (8192, 1.50, 2.60),
    (16384, 1.60, 2.80),
    (32768, 1.70, 3.20),
    (131072, 1.80, 4.00),
)
CHUNK = 1024
#: A text goes when more than this share of its chunks is out of the chunk's band.
BAD_CHUNKS = 0.25
MIN_WORDS = 50
MAX_REPEATED = 0.50
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
_CONTINUED = re.compile(rb"[\x80-\xbf]+")


def band(n_bytes: int) -> tuple[float, float]:
    """The limits for a text of that length."""
    _, low, high = BANDS[bisect_right(BANDS, n_bytes, key=lambda b: b[0]) - 1]
    return low, high


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, reach = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def judge(text: bytes, squeeze: zstandard.ZstdCompressor) -> tuple:
    """Counts and verdict of one text, in the order of SCHEMA."""
    words = text.split()
    letters = text.translate(None, _BLANKS)
    lines = Counter(line for line in text.split(b"\n") if line.strip(_BLANKS))
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or repeated > MAX_REPEATED * len(words)
    ratio, chunks, bad = None, 0, 0
    if text:
        ratio = len(text) / len(squeeze.compress(text))
        # The last chunk takes what is left, so that all of a text is judged, by the limits of its length.
        chunks = max(1, len(text) // CHUNK)
        for n in range(chunks):
            part = text[n * CHUNK : (n + 1) * CHUNK if n < chunks - 1 else None]
            low, high = band(len(part))
            bad += not low <= len(part) / len(squeeze.compress(part)) <= high
    low, high = band(len(text))
    kept = not failed and low <= ratio <= high and bad <= BAD_CHUNKS * chunks
    return (
        len(words),
        len(letters) - sum(map(len, _CONTINUED.findall(letters))),
        len(letters) - len(letters.translate(None, _SYMBOLS)),
        sum(lines.values()) - len(lines),
        repeated,
        failed,
        kept,
        ratio,
        chunks,
        bad,
    )


_TYPE = pa.struct(
    [(n, {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[t]) for n, t in (f.split() for f in SCHEMA.split(", "))]
)


def _judge_all(column: pa.Array) -> pa.Array:
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    rows = [judge(t, squeeze) for t in texts(column)]
    return pa.StructArray.from_arrays(
        [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), _TYPE, strict=True)] if rows else [pa.array([], f.type) for f in _TYPE],
        fields=list(_TYPE),
    )


def quality(text: str = "text"):
    """A struct column with the counts and the verdict of a text column."""

    @F.arrow_udf(SCHEMA)
    def verdict(column: pa.Array) -> pa.Array:
        return _judge_all(column)

    return verdict.asNondeterministic()(F.col(f"`{text}`").cast("string"))


def quality_table(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id and the columns of SCHEMA."""
    return docs.select(F.col(f"`{id_column}`"), quality(text).alias("q")).select(f"`{id_column}`", "q.*")


def quality_filter(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns."""
    return keep_where(docs, quality(text), "kept")

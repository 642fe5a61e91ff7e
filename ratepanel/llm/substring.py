"""Substring dedup with difference-cover anchors.

A window is LENGTH consecutive words of one document; a word goes when a window
over it also starts earlier, in a document of smaller id or earlier in the same
one. Hashing every window would move every word's worth of hashes. Instead short
anchors of LENGTH - PERIOD + 1 words are hashed at the positions whose remainder
modulo PERIOD lies in COVER. Any two remainders can be shifted into the cover
together, so two equal windows share an anchor at the same distance from their
starts. Where an anchor repeats, the windows around it are extended to full
length and hashed; the earliest place of each keeps its words.

Both rounds work alike. A task sorts the hashes of its batch, settles what repeats
inside the batch, and sends one place of each hash to the part that owns the hash;
there the places of all batches meet, and what was found goes back, packed, to the
part that gathers it by document. A
passage that a third of all documents share so costs one place per batch, not one
per document. The number of parts follows the size of the input.

Defined cases: words are separated by the ASCII blanks and compared unchanged; a
null, blank or short text has no window. Rows equal in id and text are one
document and give equal rows. Rows that share an id but not the text follow each
other in the order of a hash of their text; rows without id come last. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratepanel.llm.frames import text_bytes
from ratepanel.llm.words import inside, texts, window_hashes, word_hashes

LENGTH = 20
#: A perfect difference set: every remainder but 0 is a difference of two members in one way.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = LENGTH - PERIOD + 1
#: Bytes of text for each part of the exchanges.
PART_BYTES = 8 << 20
#: Bytes of text whose words are held at a time, and places collected before they are sent;
#: memory bounds, without effect on results.
AT_ONCE, PLACES = 2 << 20, 1 << 20
_ODD_2 = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.iinfo(np.int64).max

_PLACES = "part int, hashes binary, more binary, ids binary, keys binary, starts binary"
_BACK = "home int, keys binary, counts binary, starts binary"
_FOUND = "key long, starts binary"
_SEND = pa.schema([("part", pa.int32()), *[(n, pa.binary()) for n in ("hashes", "more", "ids", "keys", "starts")]])
_RETURN = pa.schema([("home", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("starts", pa.binary())])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], slice]]:
    """Texts of a batch, some at a time, with their rows."""
    every = batch.column("text")
    sizes = pc.fill_null(pc.binary_length(every), 0).to_numpy(zero_copy_only=False)
    begin, size = 0, 0
    for at, n in enumerate(sizes):
        size += n
        if size >= AT_ONCE or at == len(sizes) - 1:
            yield texts(every.slice(begin, at + 1 - begin)), slice(begin, at + 1)
            begin, size = at + 1, 0


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Where each run of equal rows begins, columns sorted together."""
    fresh = np.ones(len(columns[0]), bool)
    if len(fresh):
        fresh[1:] = False
        for c in columns:
            fresh[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(fresh)


def _by_key(keys: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The starts of each document, in order."""
    order = np.lexsort((starts, keys))
    keys, starts = keys[order], starts[order]
    cuts = _groups(keys)
    for begin, end in zip(cuts, [*cuts[1:], len(keys)], strict=False):
        yield int(keys[begin]), starts[begin:end]


def _sent(parts: int, hashes, more, ids, keys, starts) -> Iterator[pa.RecordBatch]:
    """Places dealt to the parts that own their hashes, in the order they stand in the texts."""
    part = (hashes % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    cuts = _groups(part[order])
    rows = []
    for begin, end in zip(cuts, [*cuts[1:], len(part)], strict=False):
        own = order[begin:end]
        rows.append((int(part[own[0]]), *[c[own].tobytes() for c in (hashes, more, ids, keys, starts)]))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEND, strict=True)], schema=_SEND)


def _settled(parts: int, keys: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a batch has found by itself; it takes the same way, without hashes."""
    rows = [(key % parts, None, None, None, np.int64(key).tobytes(), own.tobytes()) for key, own in _by_key(keys, starts)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEND, strict=True)], schema=_SEND)


def _returned(parts: int, keys: np.ndarray, starts: np.ndarray) -> pa.Table:
    """Places on their way to the documents: packed in one row for each part that owns some of the keys."""
    homes = keys % parts
    order = np.lexsort((starts, keys, homes))
    homes, keys, starts = homes[order], keys[order], starts[order]
    rows = []
    cuts = _groups(homes)
    for begin, end in zip(cuts, [*cuts[1:], len(homes)], strict=False):
        heads = _groups(keys[begin:end])
        counts = np.diff(np.append(heads, end - begin)).astype(np.int32)
        rows.append((int(homes[begin]), keys[begin:end][heads].tobytes(), counts.tobytes(), starts[begin:end].tobytes()))
    columns = zip(*rows, strict=True) if rows else [[]] * len(_RETURN)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _RETURN, strict=True)], schema=_RETURN)


def _arrived(table: pa.Table) -> pa.Table:
    """One row for each document with its starts."""
    keys = np.repeat(_joined(table["keys"], np.int64), _joined(table["counts"], np.int32))
    found = list(_by_key(keys, _joined(table["starts"], np.int32)))
    return pa.table({"key": pa.array([k for k, _ in found], pa.int64()), "starts": pa.array([s.tobytes() for _, s in found], pa.binary())})


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _flush(parts: int, held: list[tuple], settle) -> Iterator[pa.RecordBatch]:
    """Settle and send what has been collected."""
    if held:
        hashes, more, ids, keys, starts = (np.concatenate(c) for c in zip(*held, strict=True))
        own, alone, marked = settle(hashes, more, ids, keys, starts)
        yield from _settled(parts, keys[own], starts[own])
        yield from _sent(parts, hashes[alone], marked, ids[alone], keys[alone], starts[alone])


def _settle_anchors(hashes, more, ids, keys, starts):
    """Places whose anchor repeats in the batch; one place of every anchor, marked 1 when settled."""
    order = np.argsort(hashes, kind="stable")
    cuts = _groups(hashes[order])
    sizes = np.diff(np.append(cuts, len(order)))
    several = np.repeat(sizes > 1, sizes)
    own = order[several]
    alone = order[cuts]
    # The same place twice (a repeated row) is no repetition, but a harmless candidate.
    marked = (sizes > 1).astype(np.uint32)
    back = np.argsort(alone, kind="stable")
    return own, alone[back], marked[back]


def _first_of(hashes, more, ids, keys, starts):
    """Sorted order, and for each row in it whether it is the earliest place of its window."""
    order = np.lexsort((starts, keys, ids, more, hashes))
    h, m, i, k, s = (c[order] for c in (hashes, more, ids, keys, starts))
    cuts = _groups(h, m)
    sizes = np.diff(np.append(cuts, len(order)))
    head = np.repeat(cuts, sizes)
    return order, (i == i[head]) & (k == k[head]) & (s == s[head]), cuts


def _settle_windows(hashes, more, ids, keys, starts):
    """Later places of windows in the batch; the earliest place of every window."""
    order, first, cuts = _first_of(hashes, more, ids, keys, starts)
    alone = np.sort(order[cuts])
    return order[~first], alone, more[alone]


def _anchors(parts: int):
    cover = np.isin(np.arange(PERIOD), COVER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            every = _numbers(batch, "key")
            for run_texts, rows in _runs(batch):
                hashes, begins = word_hashes([t.split() for t in run_texts])
                anchors = window_hashes(hashes, ANCHOR)
                sizes = np.diff(begins)
                place = np.arange(len(anchors), dtype=np.int64) - np.repeat(begins[:-1], sizes)[: len(anchors)]
                at = np.flatnonzero(inside(begins, ANCHOR) & cover[place % PERIOD])
                keys = np.repeat(every[rows], sizes)[at]
                nothing = np.zeros(len(at), np.uint32)
                held.append((anchors[at], nothing, np.zeros(len(at), np.int64), keys, place[at].astype(np.int32)))
                count += len(at)
                if count >= PLACES:
                    yield from _flush(parts, held, _settle_anchors)
                    held, count = [], 0
        yield from _flush(parts, held, _settle_anchors)

    return run


def _meet(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Places that were sent, and what batches had settled."""
    settled = table.filter(pc.is_null(table["hashes"]))
    sent = table.filter(pc.is_valid(table["hashes"]))
    own = settled["starts"].to_pylist()
    keys = np.repeat(_joined(settled["keys"], np.int64), [len(s) // 4 for s in own])
    starts = np.frombuffer(b"".join(own), np.int32)
    kinds = (("hashes", np.uint64), ("more", np.uint32), ("ids", np.int64), ("keys", np.int64), ("starts", np.int32))
    return keys, starts, *[_joined(sent[n], kind) for n, kind in kinds]


def _meet_anchors(parts: int):
    def meet(table: pa.Table) -> pa.Table:
        keys, starts, hashes, marked, _, sent_keys, sent_starts = _meet(table)
        order = np.argsort(hashes, kind="stable")
        cuts = _groups(hashes[order])
        sizes = np.diff(np.append(cuts, len(order)))
        found = order[np.repeat(sizes > 1, sizes)]
        found = found[marked[found] == 0]
        return _returned(parts, np.concatenate([keys, sent_keys[found]]), np.concatenate([starts, sent_starts[found]]))

    return meet


def _meet_windows(parts: int):
    def meet(table: pa.Table) -> pa.Table:
        keys, starts, hashes, more, ids, sent_keys, sent_starts = _meet(table)
        order, first, _ = _first_of(hashes, more, ids, sent_keys, sent_starts)
        later = order[~first]
        return _returned(parts, np.concatenate([keys, sent_keys[later]]), np.concatenate([starts, sent_starts[later]]))

    return meet


def _windows(parts: int):
    """Full windows around the repeated anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            every_key, every_id = _numbers(batch, "key"), _numbers(batch, "id")
            for run_texts, rows in _runs(batch):
                hashes, begins = word_hashes([t.split() for t in run_texts])
                one, two = window_hashes(hashes, LENGTH), window_hashes(hashes, LENGTH, _ODD_2)
                near = np.zeros(len(one) + PERIOD, np.int32)
                for begin, found in zip(begins, batch.column("found").slice(rows.start, rows.stop - rows.start).to_pylist(), strict=False):
                    anchors = np.frombuffer(found, np.int32).astype(np.int64)
                    # An anchor may stand up to PERIOD - 1 words after the start.
                    np.add.at(near, begin + np.maximum(anchors - PERIOD + 1, 0), 1)
                    np.add.at(near, np.minimum(begin + anchors + 1, len(near) - 1), -1)
                sizes = np.diff(begins)
                at = np.flatnonzero((np.cumsum(near)[: len(one)] > 0) & inside(begins, LENGTH))
                document = np.repeat(np.arange(len(sizes)), sizes)[at]
                starts = (at - begins[document]).astype(np.int32)
                more = (two[at] >> np.uint64(32)).astype(np.uint32)
                held.append((one[at], more, every_id[rows][document], every_key[rows][document], starts))
                count += len(at)
                if count >= PLACES:
                    yield from _flush(parts, held, _settle_windows)
                    held, count = [], 0
        yield from _flush(parts, held, _settle_windows)

    return run


def _without(text: bytes, removed: bytes | None) -> tuple[list[bytes], list[bytes]]:
    """Words, and the words that stay."""
    words = text.split()
    if not removed:
        return words, words
    edge = np.zeros(len(words) + 1, np.int32)
    starts = np.frombuffer(removed, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + LENGTH, -1)
    gone = np.cumsum(edge)[: len(words)] > 0
    return words, [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _cleaned(column: pa.Array, removed: pa.Array) -> pa.Array:
    rows = [_without(t, r) for t, r in zip(texts(column), removed.to_pylist(), strict=True)]
    return pa.array([b" ".join(kept).decode() for _, kept in rows], pa.string())


def _digested(column: pa.Array, removed: pa.Array) -> pa.Array:
    totals, gone, digests = [], [], []
    for text, starts in zip(texts(column), removed.to_pylist(), strict=True):
        words, kept = _without(text, starts)
        totals.append(len(words))
        gone.append(len(words) - len(kept))
        digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())], ["n_words", "n_removed", "kept_sha256"]
    )


def _found(sent: DataFrame, meet, name: str) -> DataFrame:
    """`at, name`: what the parts found, by document."""
    back = sent.groupBy("part").applyInArrow(meet, _BACK)
    return back.groupBy("home").applyInArrow(_arrived, _FOUND).select(F.col("key").alias("at"), F.col("starts").alias(name))


def repeated_windows(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, text, removed binary`: starts (32-bit) of the windows that also start earlier."""
    plain = F.col(f"`{text}`").cast("string")
    number = F.col(f"`{id_column}`").cast("long")
    rows = docs.select(number.alias("id"), plain.alias("text"), F.xxhash64(number, plain).alias("key"))
    parts = max(1, text_bytes(rows) // PART_BYTES)
    anchors = rows.select("key", "text").mapInArrow(_anchors(parts), _PLACES)
    found = _found(anchors, _meet_anchors(parts), "found")
    around = rows.join(found, rows.key == found["at"]).select("id", "key", "text", "found").mapInArrow(_windows(parts), _PLACES)
    removed = _found(around, _meet_windows(parts), "removed")
    return rows.join(removed, rows.key == removed["at"], "left").select("id", "text", "removed")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and the text of the words that stay, joined by one space."""
    cleaned = F.arrow_udf(_cleaned, "string")
    return repeated_windows(docs, id_column, text).select(F.col("id").alias(id_column), cleaned("text", "removed").alias("text"))


def digest(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, number of words, of removed words, and a digest of the words that stay."""
    told = F.arrow_udf(_digested, "n_words long, n_removed long, kept_sha256 string")
    rows = repeated_windows(docs, id_column, text).select(F.col("id").alias(id_column), told("text", "removed").alias("d"))
    return rows.select(f"`{id_column}`", "d.*")

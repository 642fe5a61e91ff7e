"""Words of byte texts and hashes of their windows, for many texts at once."""

from __future__ import annotations

import gc
import weakref
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

#: Distinct words whose hash a Python worker remembers; a memory bound, without effect on results.
REMEMBERED = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Remember(dict):
    """Values of a function by argument, of which those not asked for of late are forgotten.

    When the young half is full it becomes the old half; what is asked for again
    moves back. So frequent arguments stay and memory is bounded. Tables that
    nothing was added to since another table last turned are emptied then, so a
    worker that goes on to the next stage doesn't hold what the one before has left.
    The same holds where a stage begins whose words are too few to turn a table.
    """

    _tables: weakref.WeakSet = weakref.WeakSet()
    _stage: int | None = None
    __hash__ = object.__hash__

    def __init__(self, compute, most: int = REMEMBERED, longest: int = 64):
        super().__init__()
        self.compute, self.most, self.longest = compute, most // 2, longest
        self.old: dict = {}
        self.busy = False
        self._tables.add(self)

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self._turn()
            self[key] = value
            self.busy = True
        return value

    def recall(self, keys) -> dict:
        """What is remembered of these keys."""
        return {k: v for k in keys if (v := self.get(k)) is not None or (v := self.old.get(k)) is not None}

    def keep(self, values: dict) -> None:
        """Remember values that were computed elsewhere."""
        if len(self) + len(values) > self.most:
            self._turn()
        self.update((k, v) for k, v in values.items() if len(k) <= self.longest)
        self.busy = True

    def _turn(self) -> None:
        self.old = dict(self)
        self.clear()
        self._rest(self)

    @classmethod
    def _rest(cls, but: Remember | None = None) -> None:
        for table in [t for t in cls._tables if t is not but]:
            if not table.busy:
                table.clear()
                table.old = {}
            table.busy = False

    @classmethod
    def begin(cls, stage: int | None) -> None:
        """Empty what the stage before didn't ask for, if this is another one."""
        if stage != cls._stage:
            cls._stage = stage
            cls._rest()


#: Broadcast values of the stage that this Python worker works for, which are thereby kept and told apart, with what was made from them.
_made: list[tuple] = []


def begin(stage: int | None = None) -> None:
    """Called by tasks for each batch: what another stage made is let go."""
    context = TaskContext.get()
    if context is not None:
        stage = context.stageId()
    if _made and stage != Remember._stage:
        _made.clear()
        # What was made may refer to itself.
        gc.collect()
        pa.default_memory_pool().release_unused()
    Remember.begin(stage)


def made(value, make: Callable):
    """What `make` makes of a broadcast value, once for each stage that a worker takes part in."""
    begin()
    for known, thing in _made:
        if known is value:
            return thing
    _made.append((value, make(value)))
    return _made[-1][1]


_hashes = Remember(xxhash.xxh3_64_intdigest)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    begin()
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def word_hashes(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in a row, and where each document begins (and the last ends)."""
    starts = np.zeros(len(documents) + 1, np.int64)
    np.cumsum([len(d) for d in documents], out=starts[1:])
    known = _hashes.__getitem__
    hashes = np.fromiter((known(w) for d in documents for w in d), np.uint64, starts[-1])
    return hashes, starts


def window_hashes(hashes: np.ndarray, width: int, odd: np.uint64 = _ODD) -> np.ndarray:
    """A hash for each run of `width` hashes, document borders ignored."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, width):
        out *= odd
        out += hashes[i : n + i]
    return mix(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits, in place."""
    h ^= h >> np.uint64(31)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def inside(starts: np.ndarray, width: int) -> np.ndarray:
    """True at each window start (of word_hashes' order) whose window stays in its document."""
    total = starts[-1]
    good = np.ones(max(0, total - width + 1), bool)
    for border in starts[1:-1]:
        good[max(0, border - width + 1) : border] = False
    return good

"""Sharding by a keyed permutation of global row numbers.

Rows are numbered from 0 in the order of their key. A Feistel network over a
rectangle of a x b cells, just large enough for the row count, permutes the
numbers; a number that lands outside the count walks on along its cycle until it
is inside. Position p of the shuffle belongs to shard p mod n, slot p div n, so
the shards' counts differ by at most one, slots have no gaps, and both follow from
the row number by arithmetic alone; `row_at` inverts them.

Numbering sorts by range: each part of the sorted rows counts itself, and only
one count per part meets the others. The sorted keys are checkpointed, as a
range sort cut anew could fall into other parts.

Defined cases: rows are ordered by (id, size, checksum), null ids first; rows
equal in all three are interchangeable and get neighbouring numbers, so each row
has its own slot. A null text has size 16 and checksum 0. An empty table gives
an empty result. Extra columns are ignored by `shards`. Everything is built of
native functions.
"""

from __future__ import annotations

import struct
from math import isqrt

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratepanel.llm.frames import cut

ROUNDS = 4
#: A walk ends within a steps: there are fewer than a cells outside. With more
#: than 64 columns it is past 64 steps with a chance below 64^-64 (then an error).
WALK = 64
OVERHEAD = 16


def rectangle(count: int) -> tuple[int, int]:
    """Sides a >= b of the smallest near-square that holds so many cells."""
    a = max(1, isqrt(count))
    if a * a < count:
        a += 1
    return a, max(1, -(-count // a))


def constants(seed: int) -> list[int]:
    """A number for each round."""
    return [seed * 1_000_003 + i for i in range(ROUNDS)]


def permute(number: int, count: int, seed: int) -> int:
    """Where a row number goes, as `position` computes it."""
    a, b = rectangle(count)
    while True:
        left, right = number % a, number // a
        for i, salt in enumerate(constants(seed)):
            if i % 2:
                right = (right + _stir(left, salt) % b) % b
            else:
                left = (left + _stir(right, salt) % a) % a
        number = right * a + left
        if number < count:
            return number


def row_at(position: int, count: int, seed: int) -> int:
    """The row number that `permute` sends to a position."""
    a, b = rectangle(count)
    while True:
        left, right = position % a, position // a
        for i, salt in reversed(list(enumerate(constants(seed)))):
            if i % 2:
                right = (right - _stir(left, salt) % b) % b
            else:
                left = (left - _stir(right, salt) % a) % a
        position = right * a + left
        if position < count:
            return position


def _stir(value: int, salt: int) -> int:
    """Spark's xxhash64 of two longs."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
    both = xxhash.xxh64_intdigest(struct.pack("<q", salt), first)
    return both - (1 << 64) if both >> 63 else both


def _div(value: Column, by: int) -> Column:
    """Whole quotient of longs."""
    return F.call_function("div", value, F.lit(by))


def _network(number: Column, a: int, b: int, seed: int) -> Column:
    left, right = number % a, _div(number, a)
    for i, salt in enumerate(constants(seed)):
        if i % 2:
            right = (right + F.pmod(F.xxhash64(left, F.lit(salt).cast("long")), F.lit(b))) % b
        else:
            left = (left + F.pmod(F.xxhash64(right, F.lit(salt).cast("long")), F.lit(a))) % a
    return right * a + left


def position(number: Column, count: int, seed: int) -> Column:
    """The place of a row number in the shuffle."""
    if count <= 1:
        return number
    a, b = rectangle(count)
    first = _network(number, a, b, seed)
    if a * b == count:
        return first
    steps = F.sequence(F.lit(1), F.lit(WALK))
    walked = F.aggregate(steps, first, lambda at, _: F.when(at < count, at).otherwise(_network(at, a, b, seed)))
    return F.when(walked < count, walked).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))


def numbered(rows: DataFrame, order: list[str], parts: int | None = None) -> tuple[DataFrame, int, str]:
    """The rows with a gapless `number` in sorted order, and their count; rows are checkpointed once."""
    parts = parts or max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The id holds the part in its upper 31 bits and the row in the lower 33.
    kept = cut(ordered.withColumn("place", F.monotonically_increasing_id())).withColumn("part", F.shiftright("place", 33))
    # One row per part of the sort, so few that one task adds them up and all tasks get them.
    counts = kept.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    begins = counts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("begin"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = kept.join(F.broadcast(begins), "part").withColumn("number", (F.col("begin") + within).cast("long"))
    return placed.drop("place", "part", "begin"), kept.count()


def shards(docs: DataFrame, n_shards: int, seed: int = 1, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size, checksum, global row number, position in the shuffle, shard and slot of each row."""
    plain = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        (F.coalesce(F.octet_length(plain), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(plain, F.lit("")).cast("binary")).alias("checksum"),
    )
    rows, count = numbered(rows, ["id", "size", "checksum"])
    placed = rows.withColumn("position", position(F.col("number"), count, seed))
    return placed.select(
        F.col("id").alias(id_column),
        "size",
        F.col("checksum").alias("text_crc32"),
        "number",
        "position",
        (F.col("position") % n_shards).cast("int").alias("shard"),
        _div(F.col("position"), n_shards).alias("slot"),
    )


def write_shards(placed: DataFrame, docs: DataFrame, path: str, id_column: str = "doc_id") -> None:
    """Write the documents as one folder per shard, each file in slot order; ids must be unique."""
    keys = placed.select(F.col(f"`{id_column}`").alias("_id"), "shard", "slot")
    rows = docs.join(keys, docs[id_column].eqNullSafe(keys["_id"])).drop("_id")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)

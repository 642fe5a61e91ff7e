"""The trie of conversations' turns, by splitters and a skeleton.

A conversation is a path: sixteen bytes of a digest for each turn, so paths in
byte order are conversations in the order of the trie. Splitters, taken from a
sample, cut that order into shards; a splitter has the conversation's id as well,
so that any number of equal conversations is cut, too. A node whose
conversations lie in two shards begins the path of a splitter between them. The
trie of the splitters' paths, the skeleton, is therefore all that shards share:
it is broadcast, each shard finishes every other node in one pass over its
sorted paths, and sends partial sums for the skeleton's nodes, which are added
up. Sums over subtrees of the skeleton are differences of running sums in the
order of its nodes.

Turns are sorted by their number, null first, those of one number by digest.
Null roles and texts are empty. Rows without a conversation's id belong to none
and are left out. Rows that repeat are turns of their own. A table without rows
has no node, not even a root. Other columns aren't read. A conversation's turns
are held together as digests and counts, about 20 bytes each; a shard holds the
rows of nodes whose parent isn't finished.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratepanel.llm.frames import written

#: Bytes of a turn's digest.
DIGEST = 16
#: Turns of a shard, about, and conversations of the sample for each splitter.
SHARD, SAMPLE = 1 << 21, 24
#: Turns of a splitter's path at most; longer ones are cut, so the skeleton's size is bounded.
DEPTH = 1024
#: Ids of a skeleton's node that travel in one row.
IDS = 4096
_FIRST_ID = -(1 << 63)

NODE, PART, IDENTIFIERS = 0, 1, 2
_FOUND = [
    ("kind", "int"),
    ("node", "int"),
    ("shard", "int"),
    ("place", "long"),
    ("conv_id", "long"),
    ("depth", "long"),
    ("parent_conv_id", "long"),
    ("parent", "int"),
    ("n_convs", "long"),
    ("n_children", "long"),
    ("n_leaves", "long"),
    ("saved_tokens", "long"),
    ("words", "long"),
    ("ends", "string"),
]
FOUND = ", ".join(f"{n} {k}" for n, k in _FOUND)
_ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[k]) for n, k in _FOUND])
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NONE = hashlib.sha256(b"").hexdigest()


# Paths.


def _digest(role: Column, text: Column) -> Column:
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(told, 256), 1, 2 * DIGEST))


def turn_lists(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", near: int = 1) -> DataFrame:
    """`base, conv_id, turns`: digests and words of each conversation's turns, in order.

    Conversations with the same `base`, the multiple of `near` up to their id, stay together.
    """
    own = F.col(f"`{conversation}`").cast("long")
    plain = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    told = turns.where(own.isNotNull()).select(
        (own - F.pmod(own, F.lit(near))).alias("base"),
        own.alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            _digest(*plain).alias("digest"),
            F.regexp_count(plain[1], F.lit(r"[^\x20\x09-\x0D]+")).alias("words"),
        ).alias("turn"),
    )
    gathered = told.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return gathered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))))


def with_heads(lists: DataFrame, most: int, length: Column) -> DataFrame:
    """Each conversation with its first turns, `length` of them and `most` at most, replaced by those of its base."""
    heads = lists.where(F.col("conv_id") == F.col("base")).select(F.col("base").alias("of"), F.slice("turns", 1, most).alias("head"))
    rows = lists.withColumn("shared", length).join(heads, F.col("base") == F.col("of"), "left")
    first = F.expr("slice(coalesce(head, slice(turns, 1, 0)), 1, shared)")
    rest = F.expr("slice(turns, shared + 1, greatest(size(turns) - shared, 0))")
    return rows.select("base", "conv_id", F.concat(first, rest).alias("turns"))


def paths(lists: DataFrame) -> DataFrame:
    """`conv_id, path binary, words array<int>`."""
    hexes = F.transform("turns", lambda t: F.hex(t["digest"]))
    words = F.transform("turns", lambda t: t["words"])
    return lists.select("conv_id", F.unhex(F.array_join(hexes, "")).alias("path"), words.alias("words"))


# The skeleton.


def _common(one: bytes, two: bytes) -> int:
    """Turns that two paths begin with alike."""
    most = min(len(one), len(two))
    if one[:most] == two[:most]:
        return most // DIGEST
    low, high = 0, most // DIGEST
    while high - low > 1:
        middle = (low + high) // 2
        if one[: middle * DIGEST] == two[: middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


def choose_splitters(sample: list[tuple[bytes, int]], ways: int) -> list[tuple[bytes, int]]:
    """Keys that cut the sample into shards alike in size; a path is no longer than it takes to tell it from its neighbours."""
    sample = sorted((path, own) if len(path) <= DEPTH * DIGEST else (path[: DEPTH * DIGEST], _FIRST_ID) for path, own in sample)
    chosen = sorted({sample[i * len(sample) // ways] for i in range(1, ways)}) if sample else []
    out = []
    for at, (path, own) in enumerate(chosen):
        near = [chosen[i][0] for i in (at - 1, at + 1) if 0 <= i < len(chosen)]
        if path in near:
            out.append((path, own))
        else:
            # A neighbour that this path begins with or begins is told apart by the turn behind.
            deep = max([_common(path, n) for n in near], default=0) + 1
            out.append((path, own) if deep * DIGEST >= len(path) else (path[: deep * DIGEST], _FIRST_ID))
    return sorted(set(out))


class Skeleton:
    """The trie of the splitters' paths; nodes are numbered so that each subtree is a range."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.children: list[dict[bytes, int]] = [{}]
        self.parents, self.last = [-1], [0]
        stack, before = [0], b""
        for path, _ in splitters:
            del stack[_common(path, before) + 1 :]
            before = path
            for at in range((len(stack) - 1) * DIGEST, len(path), DIGEST):
                self.children[stack[-1]][path[at : at + DIGEST]] = len(self.children)
                self.parents.append(stack[-1])
                stack.append(len(self.children))
                self.children.append({})
                self.last.append(0)
        for node in range(len(self.children) - 1, -1, -1):
            self.last[node] = max([node, *[self.last[c] for c in self.children[node].values()]])

    def rows(self) -> list[tuple[int, int | None, int, int]]:
        return [(i, p if i else None, self.last[i], len(self.children[i])) for i, p in enumerate(self.parents)]


class _Open:
    """A node on the way to the path that is being read."""

    __slots__ = ("children", "convs", "first", "held", "ids", "leaves", "node", "saved", "waiting", "words")

    def __init__(self, node: int, words: int):
        self.node, self.words = node, words
        self.first, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ids = self.held = self.waiting = None


class _Shard:
    """One pass over the sorted paths of a shard."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard, self.place = skeleton, shard, 0
        self.rows: list[tuple] = []
        self.stack = [_Open(0, 0)]
        self.path = b""

    def add(self, path: bytes, own: int, words: list[int]) -> None:
        keep = _common(path, self.path)
        while len(self.stack) - 1 > keep:
            self.close()
        self.path = path
        for depth in range(keep, len(path) // DIGEST):
            above = self.stack[-1].node
            node = self.skeleton.children[above].get(path[depth * DIGEST : (depth + 1) * DIGEST], -1) if above >= 0 else -1
            self.stack.append(_Open(node, words[depth]))
        self.end(self.stack[-1], own)

    def end(self, top: _Open, own: int) -> None:
        """A conversation that ends at the node; ids come in ascending order."""
        top.convs += 1
        top.first = own if top.first is None else min(top.first, own)
        if top.node >= 0:
            top.held = top.held or []
            top.held.append(str(own))
            if len(top.held) >= IDS:
                self.tell(top)
        elif top.ids is None:
            top.ids = hashlib.sha256(str(own).encode())
        else:
            top.ids.update(f",{own}".encode())

    def tell(self, top: _Open) -> None:
        """Pass on the ids that end at a skeleton's node."""
        self.place += 1
        self.rows.append((IDENTIFIERS, top.node, self.shard, self.place, *[None] * 9, ",".join(top.held)))
        top.held = None

    def close(self) -> None:
        done, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.convs += done.convs
            above.first = done.first if above.first is None else min(above.first, done.first)
        if done.node >= 0:
            if done.held:
                self.tell(done)
            if done.convs:
                sums = (done.convs, done.children, done.leaves, done.saved, done.words)
                self.rows.append((PART, done.node, self.shard, 0, done.first, depth, None, None, *sums, None))
            return
        if not done.children:
            done.leaves = 1
        done.saved += (done.convs - 1) * done.words
        for first, *sums in done.waiting or ():
            self.rows.append((NODE, None, self.shard, 0, first, depth + 1, done.first, None, *sums))
        ends = done.ids.hexdigest() if done.ids else _NONE
        row = (done.first, done.convs, done.children, done.leaves, done.saved, None, ends)
        above.children += 1
        above.leaves += done.leaves
        above.saved += done.saved
        if above.node >= 0:
            self.rows.append((NODE, None, self.shard, 0, row[0], depth, None, above.node, *row[1:]))
        else:
            above.waiting = above.waiting or []
            above.waiting.append(row)

    def finish(self) -> None:
        while self.stack:
            self.close()

    def taken(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(_ARROW)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
        self.rows = []
        return batch


def _read(shared):
    """Nodes and partial sums of the shards in a sorted part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading: _Shard | None = None
        for batch in batches:
            for shard, path, own, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if reading is None or reading.shard != shard:
                    if reading is not None:
                        reading.finish()
                        yield reading.taken()
                    reading = _Shard(shared.value, shard)
                reading.add(path, own, words)
            if reading is not None:
                yield reading.taken()
        if reading is not None:
            reading.finish()
            yield reading.taken()

    return run


def _dealt(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            splitters = shared.value.splitters
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, batch.column(1), batch.column(0), batch.column(2)], names=["shard", "path", "conv_id", "words"])

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the ids of each node, whose rows come in order."""
    node, digest = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _ended(done)
    if node is not None:
        yield _ended([(node, digest.hexdigest())])


def _ended(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n for n, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.string())], names=["ended", "ends_sha256"]
    )


# The trie.


def trie(conversations: DataFrame, ways: int | None = None) -> DataFrame:
    """One row for each node of the trie of `conv_id, path, words`, with sums over its subtree."""
    spark = conversations.sparkSession
    rows = written(conversations.select("conv_id", "path", "words"), "paths")
    if ways is None:
        turns = rows.agg(F.sum(F.size("words"))).first()[0] or 0
        ways = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // SHARD)
    # The sample decides only where shards end; paths in it are cut at the depth of a splitter.
    cut_path = F.substring("path", 1, (DEPTH + 1) * DIGEST).alias("path")
    sample = rows.select(cut_path, "conv_id").orderBy(F.xxhash64("conv_id")).limit(ways * SAMPLE).collect()
    skeleton = Skeleton(choose_splitters([(bytes(r.path), r.conv_id) for r in sample], ways))
    shared = spark.sparkContext.broadcast(skeleton)
    dealt = rows.mapInArrow(_dealt(shared), "shard int, path binary, conv_id long, words array<int>")
    sorted_rows = dealt.repartitionById(ways, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = written(sorted_rows.mapInArrow(_read(shared), FOUND), "nodes")
    shape = spark.createDataFrame(skeleton.rows(), "at int, above int, last int, kids int")
    trunk = _trunk(found, shape)
    # The splitters bound the skeleton, and with it this table.
    above = F.broadcast(trunk.select(F.col("node").alias("of"), F.col("conv_id").alias("of_conv")))
    nodes = found.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256")
    nodes = nodes.join(above, nodes.parent == F.col("of"), "left")
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_conv"))
    return nodes.select(*COLUMNS).unionByName(trunk.select(*COLUMNS))


def _trunk(found: DataFrame, shape: DataFrame) -> DataFrame:
    """The skeleton's nodes: their partial sums added up, then summed over subtrees."""
    parts = found.where(F.col("kind") == PART).groupBy("node")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    own = parts.agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"), *sums)
    own = own.join(F.broadcast(shape), own.node == shape["at"])
    own = own.withColumn("n_children", F.col("n_children") + F.col("kids"))
    own = own.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
    own = own.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    # As many rows as the skeleton has nodes, which its splitters bound.
    running = Window.orderBy("node")
    for name in ("n_leaves", "saved_tokens"):
        own = own.withColumn(f"up_to_{name}", F.sum(name).over(running))
    ends = own.select(F.col("node").alias("end"), F.col("up_to_n_leaves").alias("all_leaves"), F.col("up_to_saved_tokens").alias("all_saved"))
    own = own.join(F.broadcast(ends), own["last"] == ends.end)
    own = own.withColumn("n_leaves", F.col("all_leaves") - F.col("up_to_n_leaves") + F.col("n_leaves"))
    own = own.withColumn("saved_tokens", F.col("all_saved") - F.col("up_to_saved_tokens") + F.col("saved_tokens"))
    parents = own.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    told = found.where(F.col("kind") == IDENTIFIERS).select("node", "ends", "shard", "place")
    ordered = told.repartition("node").sortWithinPartitions("node", "shard", "place").select("node", "ends")
    ended = ordered.mapInArrow(_joined, "ended int, ends_sha256 string")
    own = own.join(F.broadcast(parents), own.above == parents.parent_node, "left").join(F.broadcast(ended), own.node == ended.ended, "left")
    return own.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))

"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set holds its distinct five-word shingles, its signature the
smallest of them under each of many hash orders. Every (coordinate, value) pair
of the first POSTED coordinates is a posting list. Two sets that are similar
enough agree in at least POSTED_MATCHES of these, so they still meet when each
document skips its POSTED_MATCHES - 1 most frequent pairs (prefix): common
passages, whose lists are long, are skipped, and a document whose other pairs are
all its own posts nothing at all. Collisions are counted on whole signatures;
pairs above the match threshold are confirmed on the full sets.

Long lists are never expanded into pairs of members. First equal sets become one
entry. Then every member of a list is held against the list's centre, the member
whose values are the most frequent; what is linked gets a common label, and lists
of one label are done. In a list of up to SHORT members those of different labels
are compared. The members of the longer lists with the same centre form a family.
If two of them are similar enough, either both have values in common with it as
often as similar sets do, or they agree in a posted value that it lacks. Those like
the centre are told by what they have and the family's head lacks, or the reverse: how
many differences two of them need in common follows from their numbers, and only
differences, rarest first, are posted and joined. A family of a thousand unlike
relatives so costs as many comparisons, not their square.

A pair of similarity 0.75 is skipped by the prefix with a chance of 2e-7 and by
the count with 4e-7, more similar pairs with less.

Defined cases: a text of fewer than five words is one shingle; a null or blank
text has an empty set and is linked with nothing; rows without an id are linked
with nothing and kept; each distinct pair of id and set is one document, so
repeated rows appear once, and an id with several texts links what any of them
links. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratepanel.llm.frames import cut
from ratepanel.llm.graph import components
from ratepanel.llm.words import texts, window_hashes, word_hashes

WIDTH = 5
COORDINATES, MATCHES = 96, 50
POSTED, POSTED_MATCHES = 48, 20
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Longest list whose members are compared with each other.
SHORT = 32
#: Members of a family that meet one copy of its head's set; without effect on results.
SLICE = 1000
#: Words hashed at a time; a memory bound, without effect on results.
AT_ONCE = 400_000

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_SALTS = _RANDOM.integers(1, 1 << 63, COORDINATES, np.uint64)
_FACTORS = _RANDOM.integers(1, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(documents: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = [d.lower().split() for d in documents]
    hashes, starts = word_hashes(words)
    windows = window_hashes(hashes, width)
    out = []
    for begin, end in zip(starts, starts[1:], strict=False):
        if end - begin >= width:
            own = np.sort(windows[begin : end - width + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif end > begin:
            out.append(window_hashes(hashes[begin:end], int(end - begin)) ^ np.uint64(end - begin))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of COORDINATES 32-bit values for each set; no set may be empty."""
    sizes = [len(s) for s in sets]
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    starts = np.zeros(len(sets), np.int64)
    np.cumsum(sizes[:-1], out=starts[1:])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    if len(sets):
        for i in range(COORDINATES):
            out[:, i] = np.minimum.reduceat((every ^ _SALTS[i]) * _FACTORS[i], starts) >> np.uint64(32)
    return out.view(np.int32)


def _portions(documents: list[bytes]):
    """Runs of documents of bounded length."""
    run, size = [], 0
    for d in documents:
        run.append(d)
        size += len(d)
        if size >= AT_ONCE * 6:
            yield run
            run, size = [], 0
    if run:
        yield run


_SKETCH = "n long, digest binary, posted array<int>, signature array<short>"


def _sketch(column: pa.Array) -> pa.Array:
    sizes, digests, posted, signed = [], [], [], []
    for run in _portions(texts(column)):
        sets = shingle_sets(run)
        values = signatures([s for s in sets if len(s)])
        # Lists are keyed by 32 bits of a value, collisions are counted on 16.
        pairs = zip(values[:, :POSTED], values.astype(np.int16), strict=True)
        for s in sets:
            sizes.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()))
            post, sign = next(pairs) if len(s) else (None, None)
            posted.append(post)
            signed.append(sign)
    columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(posted, pa.list_(pa.int32())), pa.array(signed, pa.list_(pa.int16()))]
    return pa.StructArray.from_arrays(columns, ["n", "digest", "posted", "signature"])


def _full_set(column: pa.Array) -> pa.Array:
    sets = [s for run in _portions(texts(column)) for s in shingle_sets(run)]
    return pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))


def _matches(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, m: n + m)


def _sizes_allow(n: Column, m: Column) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(PERCENT) * F.greatest(n, m)


def _entries(sets: DataFrame) -> DataFrame:
    """`key, id, rank`: the prefixes' posting lists; a high rank stands for frequent values."""
    values = sets.select("id", F.posexplode("posted").alias("coordinate", "value"))
    key = F.shiftleft(F.col("coordinate").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posts = values.select("id", key.alias("key"))
    often = posts.groupBy("key").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = posts.join(often, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("often", "key"))).alias("shared"))
    # Pairs that only this set has come first in the prefix.
    take = F.lit(POSTED - POSTED_MATCHES + 1) - (F.lit(POSTED) - F.size("shared"))
    rank = F.aggregate("shared", F.lit(0.0), lambda total, s: total + F.log2(s["often"]))
    kept = shared.where(take > 0).select("id", rank.alias("rank"), F.slice("shared", F.lit(1), take)["key"].alias("keys"))
    return kept.select(F.explode("keys").alias("key"), "id", "rank")


def _counted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs `a, b` whose sizes and signatures allow the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("an"), F.col("signature").alias("s"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("bn"), F.col("signature").alias("t"))
    sized = pairs.join(left, "a").join(right, "b").where(_sizes_allow(F.col("an"), F.col("bn")))
    return sized.where(_matches(F.col("s"), F.col("t")) >= MATCHES).select("a", "b")


def _common(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """`a, b, common, total`: the size of the intersection, and of both sets together."""
    left = full.select(F.col("id").alias("a"), F.col("members").alias("as"))
    right = full.select(F.col("id").alias("b"), F.col("members").alias("bs"))
    both, total = F.size(F.array_intersect("as", "bs")).cast("long"), (F.size("as") + F.size("bs")).cast("long")
    return pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("common"), total.alias("total"))


def _similar(common: Column, total: Column) -> Column:
    """100 * common >= PERCENT * union."""
    return common * (100 + PERCENT) >= total * PERCENT


def _labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries with their label: their own id as long as they have no link."""
    if labels is None:
        return entries.withColumn("label", F.col("id"))
    known = labels.select(F.col("node"), F.col("label").alias("known"))
    joined = entries.join(known, F.col("id") == F.col("node"), "left")
    return joined.select(*entries.columns, F.coalesce("known", "id").alias("label"))


def _open(entries: DataFrame) -> DataFrame:
    """`key, centre, middle, size` of the lists that hold more than one label; `middle` is the centre's."""
    best = F.max(F.struct("rank", (-F.col("id")).alias("minus"), "label")).alias("best")
    lists = entries.groupBy("key").agg(best, F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    return lists.where("low < high").select("key", (-F.col("best.minus")).alias("centre"), F.col("best.label").alias("middle"), "size")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _in_short_lists(entries: DataFrame) -> DataFrame:
    """Pairs of different labels in lists of bounded length; the centre has met all others."""
    x = entries.where((F.col("size") <= SHORT) & (F.col("id") != F.col("centre"))).select("key", F.col("id").alias("x"), F.col("label").alias("xl"))
    y = x.select(F.col("key").alias("k"), F.col("x").alias("y"), F.col("xl").alias("yl"))
    met = x.join(y, (F.col("key") == F.col("k")) & (F.col("x") < F.col("y")) & (F.col("xl") != F.col("yl")))
    return met.select(F.col("x").alias("a"), F.col("y").alias("b"))


def _failed(family: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that agree where they differ from their centre, one of them unlike the centre."""
    told = F.array_compact(F.transform("posted", lambda v, i: F.when(v != F.get(F.col("c"), i), F.struct(i.alias("i"), v.alias("v")))))
    posts = family.select("centre", "id", "label", "passed", F.explode(told).alias("value"))
    # Values that only one label has, or only members like the centre, are left out at once.
    open_ = F.min("label").alias("low"), F.max("label").alias("high"), F.min("passed").alias("all")
    lists = posts.groupBy("centre", "value").agg(*open_).where("low < high and not all").select("centre", "value")
    met = posts.join(lists, ["centre", "value"], "left_semi").join(sets.select("id", "signature"), "id")
    posted = cut(met)
    x, y = posted.alias("x"), posted.alias("y")
    same = (F.col("x.centre") == F.col("y.centre")) & (F.col("x.value") == F.col("y.value"))
    both = same & (F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label")) & (~F.col("x.passed") | ~F.col("y.passed"))
    agree = _matches(F.col("x.signature"), F.col("y.signature")) >= MATCHES
    return x.join(y, both & agree).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _differences(family: DataFrame, full: DataFrame) -> DataFrame:
    """`middle, head, id, known, label, weight, free, differs`: what members like their centre have and their family's head lacks, or the reverse.

    Families whose centres have one label are one. Its head is the centre of the most members. Two sets that differ
    from a head of H shingles by x and y have H - |x's lack| - |y's lack| + (differences in common) shingles in
    common, so they are similar if (100 + PERCENT) * (differences in common) >= weight + weight - free.
    """
    alike = family.where("passed").select("middle", "centre", "id", "label")
    served = alike.groupBy("middle", "centre").agg(F.count(F.lit(1)).alias("served"))
    most = F.max(F.struct("served", (-F.col("centre")).alias("minus"))).alias("most")
    heads = served.groupBy("middle").agg(most, F.sum("served").alias("many"))
    # A large family meets copies of its head's set in slices.
    slices = F.ceil(F.col("many") / SLICE).cast("int").alias("slices")
    heads = cut(heads.select("middle", (-F.col("most.minus")).alias("head"), slices))
    # Any set will do as a head's, if an id has several.
    own = full.join(heads, full.id == heads["head"]).groupBy("middle", "head", "slices").agg(F.min("members").alias("own"))
    dealt = own.select("middle", "head", "own", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    members = alike.select("middle", "id", "label").distinct().join(heads, "middle").where("id <> head")
    members = members.select("middle", "id", "label", F.pmod(F.hash("id"), F.col("slices")).alias("slice"))
    met = members.join(full, "id").join(dealt, ["middle", "slice"])
    lacks, more = F.array_except("own", "members"), F.array_except("members", "own")
    told = met.select("middle", "head", "id", F.col("label").alias("known"), F.size("own").alias("h"), lacks.alias("lacks"), more.alias("more"))
    weight = (F.size("lacks") * 100 + F.size("more") * PERCENT).cast("long").alias("weight")
    free = (F.col("h") * (100 - PERCENT)).cast("long").alias("free")
    out = told.select("middle", "head", "id", "known", weight, free, F.concat("lacks", "more").alias("differs"))
    # By itself the weight tells whether a member is linked with the head; the head's label is the family's.
    label = F.when(F.col("weight") <= F.col("free"), F.col("middle")).otherwise(F.col("known"))
    return cut(out.withColumn("label", label))


def _passed(family: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs of members like their centre that the differences from their head don't rule out."""
    differs = _differences(family, full)
    with_head = differs.where(F.col("known") != F.col("label")).select(*_ordered("head", "id"))
    # Of two members with different labels one isn't linked with the head, so they have differences in common.
    spread = differs.select("middle", "id", "label", "weight", "free", F.explode("differs").alias("value"))
    lists = spread.groupBy("middle", "value").agg(F.count(F.lit(1)).alias("often"), F.min("label").alias("low"), F.max("label").alias("high"))
    # What one label alone has can't be common to two; the rest comes rarest first.
    several = lists.where("low < high").select("middle", "value", "often")
    listed = F.sort_array(F.collect_list(F.struct("often", "value")))["value"].alias("shared")
    shared = spread.join(several, ["middle", "value"]).groupBy("middle", "id", "label", "weight", "free").agg(listed)
    # The least that any partner must have in common: a linked member's partner weighs more than is free,
    # and one of a weight beyond what is free finds as much only in a partner of enough differences.
    linked = F.floor(F.col("weight") / (100 + PERCENT)) + 1
    least = F.when(F.col("weight") <= F.col("free"), linked).otherwise(F.ceil((F.col("weight") - F.col("free")) / 100))
    # In an order that both keep to, two members then meet in the first of what they have.
    first = F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.size("shared") - least + 1).cast("int"))
    posts = shared.select("middle", "id", "label", "weight", "free", F.size("shared").alias("size"), F.posexplode(first).alias("at", "value"))
    posts = cut(posts.select("middle", "value", "id", "label", "weight", "free", (F.col("size") - F.col("at")).cast("long").alias("rest")))
    x, y = posts.alias("x"), posts.alias("y")
    same = (F.col("x.middle") == F.col("y.middle")) & (F.col("x.value") == F.col("y.value"))
    both = same & (F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label"))
    # Where they first meet, all that is common is yet to come.
    enough = F.least("x.rest", "y.rest") * (100 + PERCENT) >= F.col("x.weight") + F.col("y.weight") - F.col("x.free")
    return with_head.union(x.join(y, both & enough).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))).distinct()


def links(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """`node, label` of all sets that have a link.

    `sets` has `id, n, posted, signature`, a row for each distinct set; `docs` has `id, text`.
    """
    entries = cut(_entries(sets))
    lists = _open(_labelled(entries, None))
    with_centre = entries.join(lists, "key").where("id <> centre").select(*_ordered("centre", "id")).distinct()
    pairs = cut(_counted(with_centre, sets))
    full = cut(docs.join(entries.select("id").distinct(), "id", "left_semi").select("id", F.arrow_udf(_full_set, "array<long>")("text").alias("members")))
    passed = cut(_common(pairs, full))
    linked = passed.where(_similar(F.col("common"), F.col("total"))).select("a", "b")
    labels = components(linked)
    told = _labelled(entries, labels)
    left = cut(told.join(_open(told), "key"))
    long = left.where((F.col("size") > SHORT) & (F.col("id") != F.col("centre"))).select("centre", "middle", "id", "label").distinct()
    middles = sets.select(F.col("id").alias("centre"), F.col("posted").alias("c"))
    signed = long.join(sets.select("id", "posted"), "id").join(middles, "centre")
    family = cut(signed.withColumn("passed", _matches(F.col("posted"), F.col("c")) >= POSTED_MATCHES))
    met = _in_short_lists(left).union(_failed(family, sets)).union(_passed(family, full)).distinct()
    again = _common(_counted(met, sets), full)
    more = cut(again.where(_similar(F.col("common"), F.col("total"))).select("a", "b"))
    if more.limit(1).count():
        labels = components(linked.union(more), labels)
    return labels


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, `n_shingles`, `component_id` and `kept` of each document."""
    plain = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    sketches = cut(plain.select("id", F.arrow_udf(_sketch, _SKETCH)("text").alias("s")).select("id", "s.*"))
    some = F.col("id").isNotNull() & (F.col("n") > 0)
    # Equal sets are one entry, named by the smallest id, so groups of copies shrink before they are shuffled.
    sets = cut(sketches.where(some).groupBy("n", "digest").agg(F.min(F.struct("id", "posted", "signature")).alias("s")).select("n", "digest", "s.*"))
    # A repeated id with several texts names several sets; they are one document's.
    first = plain.where(F.col("id").isNotNull())
    labels = links(sets.select("id", "n", "posted", "signature"), first)
    named = sets.join(labels, sets.id == labels.node, "left").select("n", "digest", F.coalesce("label", "id").alias("component"))
    rows = sketches.select("id", "n", F.when(some, F.col("digest")).alias("digest")).distinct()
    told = rows.join(named, ["n", "digest"], "left")
    component = F.coalesce("component", "id")
    return told.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: the smallest id of each component."""
    gone = near_duplicates(docs, id_column, text).where(~F.col("kept")).select(F.col(id_column).alias("gone")).distinct()
    return docs.join(gone, docs[id_column] == gone["gone"], "left_anti")

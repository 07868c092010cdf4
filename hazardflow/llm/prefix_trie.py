"""Prefix trie of conversations by truncation peeling.

Turns are rows throughout, so a conversation of any length is spread over tasks. A node is named by a
128-bit key of the turns on its path, an exclusive or of hashes of (turn, depth): keys of all prefixes
are running totals, taken within blocks of a conversation and then over the blocks.

Peeling starts at the greatest depth and takes off a strip of levels at a time. What is left of a
conversation at a strip's lower edge is a path: conversations that end inside the strip enter, those
with equal turns as one path, and meet the survivors of the strip below. Stripped of their last turns
and regrouped by the keys of the strip's levels, paths become the strip's nodes, and one pass gives
members and subtree figures; a node is carried into the next strip as one survivor, by its least member.

Within a strip every node belongs to one of its paths, the one of its least member. A subtree's sum is
then the sum, over the paths through its top, of what each path owns from there down: a running total
along the path, and no second descent. Strips hold about equal shares of the turns, so their number does not
grow with the depth; a strip has one level at least.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardflow.llm.store import map_arrow, stored

#: Strips that the turns are shared out to. A level with more than its share is a strip of its own.
STRIPS = 6
#: Turns of a conversation that one task totals.
BLOCK = 4096
#: Characters of joined ids in one row.
JOINED = 1 << 20
KEY = ["k1", "k2"]
PARENT = ["p1", "p2"]
_ROW = (1 << 33) - 1


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, t1, t2, length): each conversation's turns in order, pos from 1.

    ``t1`` and ``t2`` name role and text, ``length`` is the text's code points; null ones count as
    empty. Equal and null turn numbers are ordered by that name. Rows without conv_id have no
    conversation and are left out. Rows are numbered within a range partitioning of the whole table, so
    neither a long conversation nor one with a single turn number meets in one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    name = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        name.alias("name"), F.length(text).cast("long").alias("length"))
    rows = rows.select("conv", "turn", F.xxhash64(F.lit(1), "name").alias("t1"), F.xxhash64(F.lit(2), "name").alias("t2"), "length")
    order = ["conv", F.col("turn").asc_nulls_first(), "t1", "t2"]
    dealt = stored(rows, "turns").repartitionByRange(*order, F.rand(0)).sortWithinPartitions(*order)
    dealt = stored(dealt.select("conv", "t1", "t2", "length", F.monotonically_increasing_id().alias("at")), "ordered")
    part = F.shiftright("at", 33)
    # one row for each partition of the table just written
    sizes = dealt.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    sizes = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    placed = dealt.withColumn("part", part).join(F.broadcast(sizes), "part")
    placed = placed.withColumn("at", F.col("before") + F.col("at").bitwiseAND(_ROW))
    first = placed.groupBy("conv").agg(F.min("at").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("pos"), "t1", "t2", "length")


def with_shared_heads(ordered: DataFrame, every: int = 100, folds: int = 6) -> DataFrame:
    """``ordered`` with the first h turns of each conversation c taken from conversation c - c % every.

    h is crc32 of the decimal c, modulo ``folds``; fewer where that conversation is shorter, none
    where it is absent. The turns of c after its first h follow.
    """
    convs = ordered.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = convs.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % folds)
    convs = stored(convs.withColumn("base", F.col("conv") - F.col("conv") % every), "convs")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    taken = convs.join(bases, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    head = ordered.filter(F.col("pos") < folds).withColumnRenamed("conv", "base")
    heads = taken.join(head, "base").filter("pos <= taken").select("conv", "pos", "t1", "t2", "length")
    tails = ordered.join(taken, "conv").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    none = convs.select("conv", F.lit(0).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(c) for c in ("t1", "t2", "length")])
    return heads.unionByName(tails.select(heads.columns)).unionByName(none)


def with_roots(ordered: DataFrame) -> DataFrame:
    """``ordered`` with the textless turn 0 of each conversation."""
    none = ordered.select("conv").distinct().select("conv", *[F.lit(0).cast("long").alias(c) for c in ("pos", "t1", "t2", "length")])
    return ordered.unionByName(none)


def _running(rows: DataFrame, along: str, order: Column, columns: dict[str, tuple], block: Column) -> DataFrame:
    """Running totals of columns along ``along`` in ``order``: {out: (aggregate, combine, in)}.

    Blocks are totalled first and the totals then run over the blocks, of which there are few.
    """
    rows = rows.withColumn("block", block)
    totals = rows.groupBy(along, "block").agg(*[add(c).alias(f"{c}_total") for add, _, c in columns.values()])
    earlier = Window.partitionBy(along).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(along, "block", *[add(f"{c}_total").over(earlier).alias(f"{c}_before") for add, _, c in columns.values()])
    inner = Window.partitionBy(along, "block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = rows.withColumns({out: add(c).over(inner) for out, (add, _, c) in columns.items()})
    ran = ran.join(before, [along, "block"], "left")
    zero = F.lit(0).cast("long")
    ran = ran.withColumns({out: combine(F.col(out), F.coalesce(f"{c}_before", zero)) for out, (_, combine, c) in columns.items()})
    return ran.drop("block", *[f"{c}_before" for _, _, c in columns.values()])


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, length) of every prefix of every conversation; p is the parent's key."""
    hashed = rows.select("conv", F.col("pos").alias("depth"), "length", *[
        F.when(F.col("pos") > 0, F.xxhash64(F.lit(10 + i), "t1", "t2", "pos")).otherwise(F.lit(0).cast("long")).alias(f"f{i}") for i in (1, 2)])
    xor = lambda a, b: a.bitwiseXOR(b)
    ran = _running(hashed, "conv", F.col("depth"), {f"k{i}": (F.bit_xor, xor, f"f{i}") for i in (1, 2)}, F.floor(F.col("depth") / BLOCK))
    return ran.select("conv", "depth", "k1", "k2", *[xor(F.col(f"k{i}"), F.col(f"f{i}")).alias(f"p{i}") for i in (1, 2)], "length")


def _strips(rows: DataFrame, strips: int) -> list[tuple[int, int]]:
    """(top, bottom) depths of the strips, deepest first."""
    deepest = rows.agg(F.max("depth")).first()[0]
    if deepest is None:
        return []
    shares = [i / strips for i in range(1, strips)]
    cuts = rows.approxQuantile("depth", shares, 0.01) if shares else []
    tops = sorted({0, *(int(c) + 1 for c in cuts if c < deepest)})
    return list(zip(tops, [*(t - 1 for t in tops[1:]), deepest]))[::-1]


def _peel(rows: DataFrame, paths: DataFrame, bottom: int) -> DataFrame:
    """Nodes of a strip with their subtree figures.

    ``rows`` are the prefixes of the strip's levels; ``paths`` (conv, until, n, leaves, saved, goes_on)
    are its paths: the least member, the depth it has in the strip, members, and for survivors the
    figures of the node they come from.
    """
    met = stored(rows.join(paths, "conv").filter("depth <= until"), "met")
    beyond = F.col("goes_on") | (F.col("until") > F.col("depth"))
    nodes = met.groupBy(*KEY).agg(
        F.first("depth").alias("depth"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("length").alias("length"),
        F.min("conv").alias("least"), F.sum("n").alias("n_convs"), F.max(beyond).alias("inner"))
    nodes = stored(nodes, "nodes")
    owned = met.select("conv", "depth", "until", "leaves", "saved", "goes_on", *KEY).join(nodes.select(*KEY, "least", "n_convs", "length", "inner"), KEY)
    # a childless node has the one path that ends there
    ends = F.when(~F.col("goes_on") & (F.col("depth") == F.col("until")) & ~F.col("inner"), 1).otherwise(0).cast("long")
    owned = owned.select("conv", "depth", "leaves", *KEY, ends.alias("leaf"),
        (F.when(F.col("conv") == F.col("least"), (F.col("n_convs") - 1) * F.col("length")).otherwise(0)
         + F.when(F.col("goes_on") & (F.col("depth") == F.col("until")), F.col("saved")).otherwise(0)).alias("own"))
    plus = lambda a, b: a + b
    ran = _running(owned, "conv", F.col("depth").desc(), {"saved": (F.sum, plus, "own"), "below": (F.sum, plus, "leaf")},
                   F.floor((F.lit(bottom) - F.col("depth")) / BLOCK))
    sums = ran.groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum(F.col("below") + F.col("leaves")).alias("n_leaves"))
    return stored(nodes.drop("inner").join(sums, KEY), "peeled")


def _ends(last: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the prefixes at which conversations end.

    Ids are sorted over the whole table and joined to texts of bounded length in each range; the texts
    of a prefix then pass one hash in order, one at a time.
    """
    order = [*KEY, "conv"]
    dealt = last.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def join(batches):
        key, first, ids, size = None, None, [], 0
        for batch in batches:
            for k1, k2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (k1, k2) != key or size > JOINED:
                    if ids:
                        yield [[key[0]], [key[1]], [first], [",".join(ids)]]
                    key, first, ids, size = (k1, k2), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield [[key[0]], [key[1]], [first], [",".join(ids)]]

    joined = map_arrow(dealt, _many(join), schema)
    digest = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def hashed(batches):
        key, state = None, None
        for batch in batches:
            for k1, k2, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
                if (k1, k2) != key:
                    if key is not None:
                        yield [[key[0]], [key[1]], [state.hexdigest()]]
                    key, state = (k1, k2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
        if key is not None:
            yield [[key[0]], [key[1]], [state.hexdigest()]]

    whole = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return map_arrow(whole, _many(hashed), digest)


def _many(function, rows: int = 4096):
    """Single rows of ``function`` gathered to batches; rows with long texts go in smaller ones."""

    def run(batches):
        kept, size = [], 0
        for row in function(batches):
            kept.append(row)
            size += len(row[-1][0]) + 64
            if len(kept) >= rows or size > 4 * JOINED:
                yield [[x[0] for x in column] for column in zip(*kept)]
                kept, size = [], 0
        if kept:
            yield [[x[0] for x in column] for column in zip(*kept)]

    return run


def trie(rows: DataFrame, strips: int = STRIPS) -> DataFrame:
    """One row for each distinct prefix of the conversations in ``rows`` (conv, pos, t1, t2, length).

    ``rows`` come from ``turns``, with the textless turn 0 that ``with_roots`` or ``with_shared_heads``
    adds. Columns: conv_id (least member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, each node's members but one times its last text's length),
    ends_sha256 (of the ids of the conversations that end there, ascending, joined by commas). An empty
    table has no nodes.
    """
    rows = stored(prefixes(rows), "prefixes")
    last = rows.groupBy("conv").agg(F.max_by(F.struct("depth", *KEY), "depth").alias("last")).select("conv", "last.*")
    last = stored(last, "last")
    # conversations with equal turns are one path from the start
    ended = last.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.first("depth").alias("until"), F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    ended = stored(ended.select("conv", "until", "n", zero.alias("leaves"), zero.alias("saved"), F.lit(False).alias("goes_on")), "ended")
    nodes, survivors = None, None
    for top, bottom in _strips(rows, strips):
        paths = ended.filter(F.col("until").between(top, bottom))
        if survivors is not None:
            paths = paths.unionByName(survivors)
        peeled = _peel(rows.filter(F.col("depth").between(top, bottom)), paths, bottom)
        survivors = peeled.filter(F.col("depth") == top).select(
            F.col("least").alias("conv"), F.lit(top - 1).cast("long").alias("until"), F.col("n_convs").alias("n"),
            F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(True).alias("goes_on"))
        nodes = peeled if nodes is None else nodes.unionByName(peeled)
    if nodes is None:
        nodes = rows.select(*KEY, "depth", *PARENT, "length", F.col("conv").alias("least"), *[zero.alias(c) for c in ("n_convs", "saved_tokens", "n_leaves")])
    below = nodes.filter("depth > 0")
    children = below.groupBy(*[F.col(p).alias(k) for p, k in zip(PARENT, KEY)]).agg(F.count("*").alias("n_children"))
    parents = nodes.select(*[F.col(k).alias(p) for p, k in zip(PARENT, KEY)], F.col("least").alias("parent_conv_id"))
    out = nodes.join(children, KEY, "left").join(_ends(last), KEY, "left").join(parents, PARENT, "left")
    return out.select(
        F.col("least").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))

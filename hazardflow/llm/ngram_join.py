"""N-gram Jaccard join by universe partition and pigeonhole.

Sets of word shingles are joined exactly at a Jaccard similarity of ``percent`` / 100.

* Sizes fall into bands [lo, 2 lo). Two sets at the threshold differ in at most H shingles,
  H = floor(lesser size * (100 - percent) / percent). In each band the universe of shingles is
  hashed into m segments, so a set is cut into m pieces.
* The lesser set of a pair spends H + 1 units on its pieces: one unit on a piece asks the other
  set for an equal piece, two units for a piece at a distance of at most one shingle, which the
  pieces with one shingle deleted find. If no piece is found, the sets differ in H + 1 shingles
  or more. Empty pieces get no unit.
* Cost decides. Per band, the segment count and whether one-deletion neighbourhoods are indexed come
  from the expected index rows and false hits (``band_plan``). Per set, the units go to the pieces
  with the shortest lists in the index: first to those no other set has, which cost nothing. A set
  with H + 1 such pieces is done; others ask only for as many shared pieces as they lack.
* A set whose pieces hold fewer than H + 1 units is cut anew with the next seed. The seeds that
  occur in a band are counted first, and the greater sets are indexed for each of them. The last
  seed makes every shingle a piece of its own, and a set that comes to it asks for all of them: two
  similar sets have a shingle in common at any threshold. At 50 percent and less no other cut can
  hold H + 1 units, so all sets start there.

Equal pieces meet by one shuffle of (piece hash, set id), each list walked in sort order. A list of g
sets pairs those with a unit on it with one hub, at most g candidates: first with the set of the list
that shares most pieces with others, which tends to be what the others are copies of; then, where
components still differ, with a set chosen by hash, another one for each list and round. Candidates
are verified on the whole shingle sets and joined into components after each round. At last the sets
with a unit on a list are verified against all members that are still in other components. After
that no link between two components is possible, whatever hubs were taken. Equal sets share one id
from the start and never meet as pairs.

Before any verification, pairs are tested on 512-bit parity sketches, in which every shingle flips one
bit: two sketches differ in no more bits than the sets differ in shingles, so the test loses nothing.
In the last step it is part of the join's condition.

Links lie inside components, so ``link_counts`` counts them there, exactly and for all pairs of different
sets. A component is dealt into blocks of bounded size, and a task compares two blocks by one product of
a 0/1 table with itself, a stretch of shingles at a time. Only numbers leave it. In a component of k sets
each set is sent k / BLOCK_SETS times.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from hazardflow.llm import graph
from hazardflow.llm.store import chunks, map_arrow, stored, text_bytes, unused
from hazardflow.llm.words import U, mix, shingles, words

#: Share of shingles assumed to be common to many texts; only the cost model uses it.
COMMON = 0.15
#: Index rows that one expected false hit outweighs.
HIT_COST = 40.0
#: Rounds with hubs chosen by hash.
HASHED_ROUNDS = 1
#: Expected units of a set's pieces, in units it needs: the rest may lie on shared pieces for nothing.
SPARE = 1.3
#: Cuts into segments that are tried; after them every shingle is a piece.
MOST_SEEDS = 8
SET_ID = U((1 << 63) - 1)
_LINKABLE = "n_shingles > 0 AND doc_id IS NOT NULL"
#: Sets and shingles of a block when links are counted, on average: hashes deal the sets of a component.
BLOCK_SETS, BLOCK_SHINGLES = 256, 1_000_000
#: Cells of the table of sets by shingles that a task holds at once.
TABLE_CELLS = 4_000_000
#: Words of the parity sketch of a set.
SKETCH = [f"k{i}" for i in range(8)]


def budget(size, percent: int):
    """Greatest symmetric difference of a set of this size to a larger similar one."""
    return size * (100 - percent) // percent


def band_of(sizes: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(sizes, 1).astype(np.float64))[1] - 1


def band_plan(band: int, percent: int) -> tuple[int, bool]:
    """(segments, with one-deletion neighbourhoods) of least expected cost for a band."""
    lo, hi = 1 << band, (2 << band) - 1
    best = None
    for near in (False, True):
        for m in sorted({max(1, round(hi * share / 100)) for share in range(4, 80, 2)}):
            fits = True
            for n in (lo, hi):
                filled = m * (1 - (1 - 1 / m) ** n)
                single = n * (1 - 1 / m) ** (n - 1)
                fits &= filled + (filled - single) * near >= (SPARE if m > 1 else 1) * (budget(n, percent) + 1)
            if not fits:
                continue
            size = lo / m
            units = budget(lo, percent) + 1
            if near:
                rows, hits = m + lo, units / 2 * (1 + size) * COMMON ** max(size - 1, 1)
            else:
                rows, hits = m * (1 - math.exp(-size)), units * COMMON ** max(size, 1)
            cost = rows + HIT_COST * hits
            if best is None or cost < best[0]:
                best = cost, m, near
    return (best[1], best[2]) if best else (1 << band, True)


def _pieces(owner, shingle, owners: int, m: int, band: int, seed: int):
    """(set, segment, size, sum of the mixed shingles) of the non-empty pieces, and the piece of each shingle."""
    salt = mix(np.array([band * 1024 + seed], U))[0]
    place = mix(shingle ^ salt)
    if seed == MOST_SEEDS:
        value = mix(place)
        return owner, np.zeros(len(owner), np.int64), np.ones(len(owner), np.int64), value, np.arange(len(owner)), value
    key = owner * m + (place % U(m)).astype(np.int64)
    sizes = np.bincount(key, minlength=owners * m)
    value = mix(place)
    total = np.bincount(key, (value & U(0xFFFFFFFF)).astype(np.float64), owners * m).astype(U)
    total += np.bincount(key, (value >> U(32)).astype(np.float64), owners * m).astype(U) << U(32)
    filled = np.flatnonzero(sizes)
    number = np.zeros(owners * m, np.int64)
    number[filled] = np.arange(len(filled))
    return filled // m, filled % m, sizes[filled], total[filled], number[key], value


def _allocate(owner, sizes, need, near: bool) -> tuple[np.ndarray, np.ndarray]:
    """Units of each piece, and the units that each set lacks. One unit for the largest pieces
    first, then second ones for the smallest that have two shingles."""
    order = np.lexsort((-sizes, owner))
    first = np.searchsorted(owner, np.arange(len(need)))
    count = np.bincount(owner, minlength=len(need))
    units = np.zeros(len(owner), np.int64)
    rank = np.arange(len(owner)) - first[owner]
    units[order] = rank < need[owner]
    lack = np.maximum(need - count, 0)
    if near and lack.any():
        can = np.flatnonzero((sizes >= 2) & (lack[owner] > 0))
        can = can[np.lexsort((sizes[can], owner[can]))]
        start = np.searchsorted(owner[can], np.arange(len(need)))
        units[can] += np.arange(len(can)) - start[owner[can]] < lack[owner[can]]
        lack = np.maximum(lack - np.bincount(owner[can], minlength=len(need)), 0)
    return units, lack


def _select(owner, shingle, chosen: np.ndarray):
    """Shingles of the chosen sets, renumbered."""
    number = np.full(max(int(owner.max(initial=-1)), int(chosen.max(initial=-1))) + 1, -1)
    number[chosen] = np.arange(len(chosen))
    keep = number[owner] >= 0
    return number[owner[keep]], shingle[keep]


def _seeds(owner, shingle, sizes, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first seed with which a set's pieces hold its units, and the pieces that need no unit then."""
    seeds, spare = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    bands = band_of(sizes)
    for band in np.unique(bands[budget(sizes, percent) > 0]).tolist():
        m, near = band_plan(band, percent)
        left, seed = np.flatnonzero(bands == band), 0 if percent > 50 else MOST_SEEDS
        seeds[left] = seed
        while len(left) and seed < MOST_SEEDS:
            own, values = _select(owner, shingle, left)
            piece_owner, _, piece_size, _, _, _ = _pieces(own, values, len(left), m, band, seed)
            need = budget(sizes[left], percent) + 1
            _, lack = _allocate(piece_owner, piece_size, need, near)
            if not near:
                spare[left] = np.maximum(np.bincount(piece_owner, minlength=len(left)) - need, 0)
            left = left[lack > 0]
            seed += 1
            seeds[left] = seed
    return seeds, spare


def _rows(owner, shingle, sizes, ids, percent: int, seeds: dict[int, int]):
    """(piece hash, set id) rows of the sets. The sign bit of the id marks a piece that may have a unit."""
    found = []
    bands, own_seed = band_of(sizes), _seeds(owner, shingle, sizes, percent)[0]
    reach = (100 // percent).bit_length()  # bands above its own in which a similar set can be
    for band in sorted({b - r for b in set(bands.tolist()) for r in range(reach + 1)}):
        if band < 0 or budget(hi := (2 << band) - 1, percent) < 1:
            continue
        most = hi * 100 // percent
        chosen = np.flatnonzero((bands == band) | (bands > band) & (sizes <= most))
        if not len(chosen):
            continue
        m, near = band_plan(band, percent)
        own, values = _select(owner, shingle, chosen)
        for seed in range(0 if percent > 50 else MOST_SEEDS, seeds.get(band, 0) + 1):
            piece_owner, segment, size, total, piece, value = _pieces(own, values, len(chosen), m, band, seed)
            asks = (bands[chosen] == band) & (own_seed[chosen] == seed)
            tag = mix(segment.astype(U) + (U(band) << U(48)) + (U(seed) << U(40)))
            who = ids[chosen][piece_owner]
            units = asks[piece_owner].astype(np.int64)
            if near and seed < MOST_SEEDS:
                need = np.where(asks, budget(sizes[chosen], percent) + 1, 0)
                units, _ = _allocate(piece_owner, size, need, near)
                kept = (size[piece] >= 3) | (units[piece] == 2)
                at = piece[kept]
                found.append((mix(total[at] - value[kept] ^ tag[at]), who[at] | (units[at] == 2).astype(U) << U(63)))
            found.append((mix(total ^ tag), who | (units > 0).astype(U) << U(63)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x).view(np.int64) for x in zip(*found))


def _sets(batch: pa.RecordBatch, size: int):
    """Shingles of a slice of documents: owner, shingle, set sizes, set ids (63 bits)."""
    row, word = words(*text_bytes(batch.column("text")))
    owner, shingle = shingles(row, word, batch.num_rows, size)
    sizes = np.bincount(owner, minlength=batch.num_rows)
    sums = np.zeros(len(shingle) + 1, U)
    np.cumsum(mix(shingle), out=sums[1:])
    ends = np.cumsum(sizes)
    ids = mix(sums[ends] - sums[ends - sizes] ^ mix(sizes.astype(U))) & SET_ID
    return owner, shingle, sizes, ids.astype(np.int64)


def _sketches(owner, shingle, owners: int) -> np.ndarray:
    """Parity sketches of the sets: bit mix(shingle) modulo 512 flipped for every shingle."""
    bits = 64 * len(SKETCH)
    place = (mix(shingle + U(77)) % U(bits)).astype(np.int64)
    odd = np.bincount(owner * bits + place, minlength=owners * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(owners, bits), axis=1).view(np.int64)


def set_ids(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, row, n_shingles, set_id, band, seed, spare, sketch) of every row; equal sets have equal ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()),
                        ("band", pa.int32()), ("seed", pa.int32()), ("spare", pa.int32()), *((k, pa.int64()) for k in SKETCH)])

    def run(batches):
        for batch in chunks(batches):
            owner, shingle, sizes, ids = _sets(batch, size)
            seeds, spare = _seeds(owner, shingle, sizes, percent)
            yield [batch.column("doc_id"), batch.column("row"), sizes, ids, *(x.astype(np.int32) for x in (band_of(sizes), seeds, spare)),
                   *_sketches(owner, shingle, batch.num_rows).T]

    return map_arrow(docs, run, schema)


def piece_rows(docs: DataFrame, size: int, percent: int, seeds: dict[int, int]) -> DataFrame:
    """(piece, member) rows; each task sends a set of which it sees several copies once."""
    schema = pa.schema([("piece", pa.int64()), ("member", pa.int64())])

    def run(batches):
        seen = set()
        for batch in chunks(batches):
            owner, shingle, sizes, ids = _sets(batch, size)
            _, first = np.unique(ids, return_index=True)
            new = np.sort([i for i in first.tolist() if sizes[i] and ids[i] not in seen]).astype(np.int64)
            if not len(new):
                continue
            seen.update(ids[new].tolist())
            owner, shingle = _select(owner, shingle, new)
            yield list(_rows(owner, shingle, sizes[new], ids[new].astype(U), percent, seeds))

    return map_arrow(docs, run, schema)


def shared_pieces(rows: DataFrame) -> DataFrame:
    """(piece, member, length) of the lists with two sets or more.

    The rows of a piece come sorted, so a list of any length is walked with one row kept. ``length``
    is the list's, or its part in a batch of rows if it goes beyond; it only serves as a cost.
    """
    schema = pa.schema([("piece", pa.int64()), ("member", pa.int64()), ("length", pa.int32())])
    dealt = rows.repartition("piece").sortWithinPartitions("piece", "member")

    def run(batches):
        last = None  # (piece, last row, whether that is written) of the list that may go on
        for batch in batches:
            piece, member = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(piece):
                continue
            if last is not None:
                piece, member = np.append(last[0], piece), np.append(last[1], member)
            new = np.ones(len(piece), bool)
            new[1:] = piece[1:] != piece[:-1]
            fresh = new.copy()
            fresh[1:] |= member[1:] != member[:-1]
            number = np.cumsum(new) - 1
            length = np.bincount(number, fresh).astype(np.int64)
            carried = last is not None and last[2]
            length[0] += carried
            keep = fresh & (length[number] > 1)
            keep[0] &= not carried
            yield [piece[keep], member[keep], length[number[keep]].astype(np.int32)]
            last = piece[-1], member[-1], bool(length[-1] > 1)

    return map_arrow(dealt, run, schema)


def unit_lists(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """(piece, set_id, unit, weight) of the lists on which a set spends a unit.

    A set may leave out as many pieces as it has to spare, so of its shared pieces it leaves out that
    many with the longest lists. ``weight`` is the sum of the lengths of all its lists.
    """
    rows = shared.select("piece", "length", F.expr(f"member & {int(SET_ID)}").alias("set_id"), (F.col("member") < 0).alias("asks"))
    costly = Window.partitionBy("set_id").orderBy(F.desc("asks"), F.desc("length"), "piece")
    rows = rows.join(sets.select("set_id", "spare"), "set_id").withColumn("place", F.row_number().over(costly))
    rows = rows.withColumn("weight", F.sum("length").over(Window.partitionBy("set_id")))
    unit = F.col("asks") & (F.col("place") > F.col("spare"))
    rows = stored(rows.select("piece", "set_id", unit.alias("unit"), "weight"), "shared")
    used = rows.filter("unit").select("piece").distinct()
    return rows.join(used, "piece", "left_semi")


def hub_pairs(lists: DataFrame, order) -> DataFrame:
    """(u, v): the sets with a unit on a list, v, and the list's first set by ``order``, u."""
    first = lists.groupBy("piece").agg(F.min(F.struct(order.alias("order"), "set_id")).alias("first"))
    met = lists.filter("unit").join(first.select("piece", F.col("first.set_id").alias("u")), "piece")
    return met.filter("set_id != u").select("u", F.col("set_id").alias("v")).distinct()


def _shingle_arrays(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(set_id, shingles) of the wanted sets, from the text of one document each."""
    schema = pa.schema([("set_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    picked = docs.join(wanted.select("row", F.col("set_id").alias("__set_id")), "row")

    def run(batches):
        for batch in chunks(batches):
            owner, shingle, sizes, ids = _sets(batch, size)
            right = np.flatnonzero(ids == batch.column("__set_id").to_numpy())
            ends = np.cumsum(sizes)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            arrays = pa.ListArray.from_arrays(offsets, pa.array(shingle.view(np.int64)))
            yield [ids[right], arrays.take(pa.array(right))]

    return map_arrow(picked, run, schema).dropDuplicates(["set_id"])


def _verified(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose shingle sets are similar enough."""
    left = arrays.select(F.col("set_id").alias("u"), F.col("shingles").alias("a"))
    right = arrays.select(F.col("set_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    met = pairs.join(left, "u").join(right, "v").select("u", "v", both.alias("n"), F.size("a").alias("x"), F.size("b").alias("y"))
    return met.filter(F.expr(f"100 * n >= {percent} * (x + y - n)")).select("u", "v")


def _may_be_similar(u: str, v: str, percent: int):
    """Condition on sizes and sketches that holds for all similar sets; ``u`` and ``v`` name their structs or aliases."""
    flipped = " + ".join(f"bit_count({u}.{k} ^ {v}.{k})" for k in SKETCH)
    return F.expr(f"100 * least({u}.n, {v}.n) >= {percent} * greatest({u}.n, {v}.n) AND "
                  f"{100 + percent} * ({flipped}) <= {100 - percent} * ({u}.n + {v}.n)")


def _text_components(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    return _linked_texts(docs, size, percent)


def _linked_texts(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``docs`` (doc_id, text, row) with their set ids, and the component of each set by links of texts.

    The first is (doc_id, row, n_shingles, set_id); the second, (set_id, root, first), has the sets of
    rows with an id and a shingle, ``first`` being the least (doc_id, row) of the set; the third,
    (set_id, shingles), the sets that may have links.
    """
    member = stored(set_ids(docs, size, percent), "sets")
    linkable = member.filter(_LINKABLE)
    seeds = {r[0]: r[1] for r in linkable.groupBy("band").agg(F.max("seed")).collect()}
    first = F.min(F.struct("doc_id", "row")).alias("first")
    sets = stored(linkable.groupBy("set_id").agg(first, F.first("n_shingles").alias("n"), F.first("spare").alias("spare"),
        *(F.first(k).alias(k) for k in SKETCH)), "unique")
    known = docs.filter("doc_id IS NOT NULL")
    lists = stored(unit_lists(shared_pieces(piece_rows(known, size, percent, seeds)), sets), "lists")

    wanted = lists.select("set_id").distinct().join(sets, "set_id").select("set_id", "first.row")
    arrays = stored(_shingle_arrays(known, wanted, size), "shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        known = F.struct("n", *SKETCH)
        met = pairs.join(sets.select(F.col("set_id").alias("u"), known.alias("x")), "u").join(sets.select(F.col("set_id").alias("v"), known.alias("y")), "v")
        return stored(_verified(met.filter(_may_be_similar("x", "y", percent)).select("u", "v"), arrays, percent), "links")

    def still_open(roots: DataFrame) -> DataFrame:
        """Lists whose members are in several components, with these."""
        named = lists.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        mixed = named.groupBy("piece").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("piece")
        return stored(named.join(mixed, "piece", "left_semi"), "open")

    links = verified(hub_pairs(lists, -F.col("weight")))
    roots = graph.components(links)
    for salt in range(HASHED_ROUNDS):
        links = links.unionByName(verified(hub_pairs(still_open(roots), F.xxhash64("piece", "set_id", F.lit(salt)))))
        roots = graph.components(links)
    rest = still_open(roots).join(sets.select("set_id", "n", *SKETCH), "set_id")
    pairs = rest.filter("unit").alias("s").join(rest.alias("t"), "piece").filter("s.root != t.root").filter(_may_be_similar("s", "t", percent))
    more = verified(pairs.select(F.least("s.set_id", "t.set_id").alias("u"), F.greatest("s.set_id", "t.set_id").alias("v")).distinct())
    if more.limit(1).count():
        roots = graph.components(links.unionByName(more))

    rooted = sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    return member, rooted.select("set_id", "root", "first"), arrays


def _block_links(groups: pa.RecordBatch, percent: int):
    """(set ids, rows linked to) of groups of rows (root, one, two, block, set_id, weight, shingles) in order.

    A group holds blocks ``one`` and ``two`` of a component; pairs of a set of each are compared, or all pairs if
    they are the same block.
    """
    root, one, two, block, ids, weight = (groups.column(i).to_numpy() for i in range(6))
    shingle = groups.column(6)
    values, sizes = shingle.flatten().to_numpy(), pc.list_value_length(shingle).to_numpy().astype(np.int64)
    start = np.concatenate([[0], np.cumsum(sizes)])
    new = (np.diff(root) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(ids)]
    linked = np.zeros(len(ids), np.int64)
    for a, b in zip(cuts, cuts[1:]):
        m, n = b - a, sizes[a:b]
        _, column = np.unique(values[start[a] : start[b]], return_inverse=True)
        owner = np.repeat(np.arange(m), n)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        both, width = np.zeros((m, m)), max(1, TABLE_CELLS // max(m, 1))
        for low in range(0, int(column.max(initial=-1)) + 1, width):
            at = slice(*np.searchsorted(column, (low, low + width)))
            table = np.zeros((m, min(width, int(column[-1]) + 1 - low)), np.float32)
            table[owner[at], column[at] - low] = 1
            both += table @ table.T
        links = 100 * both >= percent * (n[:, None] + n[None, :] - both)
        np.fill_diagonal(links, False)
        if one[a] != two[a]:
            links &= block[a:b, None] != block[None, a:b]
        linked[a:b] = links @ weight[a:b]
    return ids, linked


def link_counts(member: DataFrame, rooted: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """(set_id, copies, links): the rows with the set, and the rows with another set that is similar."""
    copies = stored(member.filter(_LINKABLE).groupBy("set_id").agg(F.count("*").alias("copies"), F.first("n_shingles").alias("n")), "copies")
    named = rooted.select("set_id", "root").join(copies, "set_id")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    several = named.groupBy("root").agg(F.count("*").alias("k"), parts.alias("parts")).filter("k > 1")
    dealt = named.join(several, "root").withColumn("block", F.expr("CAST(pmod(xxhash64(set_id), parts) AS INT)"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["root", "one", "two"]
    met = dealt.select("root", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block",
                       "set_id", F.col("copies").alias("weight")).join(arrays, "set_id")
    met = met.select(*keys, "block", "set_id", "weight", "shingles").repartition(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([("set_id", pa.int64()), ("links", pa.int64())])

    def run(batches):
        rest = None  # the group that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            root, one, two = (rest.column(i).to_numpy() for i in range(3))
            last = np.flatnonzero((root != root[-1]) | (one != one[-1]) | (two != two[-1]))
            if len(last):
                cut = int(last[-1]) + 1
                yield list(_block_links(rest.slice(0, cut), percent))
                rest = rest.slice(cut)
        if rest is not None:
            yield list(_block_links(rest, percent))

    links = map_arrow(met, run, schema).groupBy("set_id").agg(F.sum("links").alias("links"))
    return copies.select("set_id", "copies").join(links, "set_id", "left").withColumn("links", F.coalesce("links", F.lit(0)))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, row): ``row`` is equal for rows with equal id and text."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return docs.withColumn("row", F.xxhash64("doc_id", "text"))


def _joined_by_ids(member: DataFrame, rooted: DataFrame) -> DataFrame:
    """``rooted`` with the components of all texts of an id made one."""
    named = member.filter(_LINKABLE).select("doc_id", "set_id").distinct()
    several = named.groupBy("doc_id").agg(F.min("set_id").alias("hub"), F.max("set_id").alias("top")).filter("hub != top")
    met = named.join(several.select("doc_id", "hub"), "doc_id").select("hub", "set_id").filter("hub != set_id")
    met = met.join(rooted.select("set_id", F.col("root").alias("v")), "set_id")
    met = met.join(rooted.select(F.col("set_id").alias("hub"), F.col("root").alias("u")), "hub")
    edges = stored(met.filter("u != v").select("u", "v").distinct(), "ids")
    if not edges.limit(1).count():
        return rooted
    joined = graph.components(edges).select(F.col("node").alias("root"), F.col("root").alias("__root"))
    return rooted.join(joined, "root", "left").withColumn("root", F.coalesce("__root", "root")).drop("__root")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of ``docs``.

    ``n_shingles`` is the number of distinct ``size``-word shingles of the whole text; a text with
    fewer words is one shingle. Rows link when 100 * intersection >= ``percent`` * union, and
    ``component_id`` is the least id reachable by links, the own one included. A null or empty
    text, or one without words, has 0 shingles and stays alone. A null id gets a null component
    and links with nothing. A repeated id gives one row for each occurrence, and the component
    joins what any of them links. ``n_links`` is the number of other rows that the row links with,
    copies included, by its own text; 0 without a shingle or an id. Ties cannot occur: components do not depend on the order of rows.
    """
    member, texts, arrays = _text_components(_keyed(docs, doc_id, text), size, percent)
    texts = stored(texts, "texts")
    counts = link_counts(member, texts, arrays, percent)
    rooted = stored(_joined_by_ids(member, texts), "components")
    least = rooted.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    group = rooted.join(least, "root").join(counts, "set_id").select("set_id", "component_id", F.expr("copies - 1 + links").alias("n_links"))
    out = member.join(group, "set_id", "left")
    alone = F.col("n_shingles") == 0
    result = out.select(
        "doc_id", "n_shingles",
        F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone | F.col("doc_id").isNull(), F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )
    return result


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, equal_rows: bool = False,
) -> DataFrame:
    """Rows of ``docs``, one of each group that links of texts join: the least id, and of several rows
    with it the one whose text has the least hash.

    Columns and their names stay. Rows without shingles or without id all stay. Unlike in
    ``near_duplicates``, rows of one id are not joined by it: a row goes for its own text. Of rows
    with equal id and text one stays, the one with the least hash over all columns, or with
    ``equal_rows`` all of them.
    """
    names = docs.columns
    key = unused("row", names)
    member, rooted, _ = _text_components(_keyed(docs, doc_id, text), size, percent)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row", F.lit(True).alias("stays"))
    seen = member.filter(_LINKABLE).groupBy("row").agg(F.count("*").alias("n"))
    # rows that go, and those of which one of several equal ones stays
    several = F.lit(not equal_rows) & (F.col("n") > 1)
    marked = stored(seen.join(kept, "row", "left").filter(F.col("stays").isNull() | several).select(
        F.col("row").alias(key), F.col("stays").isNotNull().alias("__again")), "marked")
    keyed = docs.withColumn(key, F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string")))
    out = keyed.join(marked, key, "left_anti").select(*names)
    again = marked.filter("__again").select(key)
    if not again.limit(1).count():
        return out
    one = keyed.join(again, key).groupBy(key).agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("__one"))
    return out.unionByName(one.select("__one.*"))

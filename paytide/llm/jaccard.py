"""Exact Jaccard join of word-shingle sets by signature trees, and its groups.

Documents with equal sets are one class. Classes that can be linked are brought together by prefix
blocks: in one total order of all shingles, two sets that are similar enough share a shingle among
the first few of each, so a block per such shingle loses no link. The order puts shingles that many
documents share last, so passages and boilerplate seldom make a block.

Within a block the classes form signature trees: a leaf holds records, every node the OR of their
token bitmaps, their size range and whether they are in one group already. Two trees are traversed
together; a pair of nodes is left out if the largest overlap that its bitmaps and sizes allow is too
small for a link, or if all its records are in one group. What is left is compared exactly.

In both rounds the trees are first built over bitmaps of the prefixes alone: two sets may be linked only
if their prefixes agree so far that the rest can make up for what differs. A first round brings each class
into one block, which finds most groups; the texts of what hangs together by the bitmaps are compared. A
second takes all blocks in which classes of different groups are left. What hangs together in a block by the
bitmaps is compared again by the prefixes themselves, equal sets of classes once; what hangs together by
these is a cluster, whose texts are compared as in the first round.

Blocks and clusters are divided by size band and by hash into nodes of bounded weight, and only pairs of
nodes that can hold a link across groups are sent to a task, so neither a large group nor a frequent
shingle meets in one task. Tasks report no more links than join what they found, never all pairs.

Whole texts are compared; the comparison of shares is done in integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from math import log

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .tables import SENT_IDS, drop_ids, map_rows, written

# Shingles per task of one traversal, and per node of a divided block.
WEIGHT = 400_000
# Shingles the order puts last: the most frequent ones. The number bounds a list that every task gets;
# which shingles are on it changes the work, not the result.
FREQUENT = 1 << 17
# A shingle is a candidate for the list if so many documents of a part of the table hold it.
SEEN_TOGETHER = 3
COUNTED_AT_ONCE = 1_500_000
FAN = 8

PASS_SCHEMA = "doc_id long, n long, d1 long, d2 long, shingle long, seen long"
PREFIX_SCHEMA = "doc_id long, n long, shingles array<long>, bits binary"
GROUP_SCHEMA = "found long, least long, class_id long"


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of a text's k-word shingles; of all its words, if they are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(k, len(words))
    out = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out ^= h[i : len(h) - width + 1 + i]
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def needed(n: int, share: int) -> int:
    """The least overlap of a set of n with any set it is linked with."""
    return -(-n * share // 100)


def first_pass(docs: DataFrame, k: int) -> DataFrame:
    """Set size and digest of every document, and rows of shingles seen in several documents of a part."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, size, known = [], 0, set()
        for doc_id, text in rows:
            found = shingles(text, k)
            raw = xxhash.xxh3_128_intdigest(found.tobytes())
            digest = (raw >> 64) - (1 << 63), (raw & ((1 << 64) - 1)) - (1 << 63)
            yield doc_id, len(found), *digest, None, None
            if digest in known:
                continue
            known.add(digest)
            held.append(found)
            size += len(found)
            if size >= COUNTED_AT_ONCE:
                yield from counted(held)
                held, size, known = [], 0, set()
        yield from counted(held)

    def counted(held: list[np.ndarray]) -> Iterator[tuple]:
        if held:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= SEEN_TOGETHER
            for value, n in zip(values[often].tolist(), counts[often].tolist()):
                yield None, None, None, None, value, n

    return map_rows(docs.select("doc_id", "text"), rows_of, PASS_SCHEMA)


def frequent(passed: DataFrame) -> np.ndarray:
    """The most frequent shingles, sorted; at most FREQUENT of them."""
    counts = passed.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("seen").alias("n"))
    rows = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toPandas()
    return np.sort(rows["shingle"].to_numpy(dtype=np.int64))


def prefixes(docs: DataFrame, k: int, share: int, late: np.ndarray) -> DataFrame:
    """(doc_id, n, shingles, bits): the shingles each document is brought together by, in their order and as a bitmap."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            found = shingles(text, k)
            if not len(found):
                continue
            length = len(found) - needed(len(found), share) + 1
            if len(late):
                at = np.minimum(np.searchsorted(late, found), len(late) - 1)
                is_late = late[at] == found
                found = np.concatenate([found[~is_late], found[is_late]])
            part = found[:length]
            yield doc_id, len(found), part.tolist(), bitmap(part, width(length)).tobytes()

    return map_rows(docs.select("doc_id", "text"), rows_of, PREFIX_SCHEMA, 5_000)


def width(n: int) -> int:
    """Bits for about n shingles: a power of two, so that bitmaps of different widths can be compared.

    With sixteen bits or more for each shingle hardly any two share one, so bounds are nearly counts.
    """
    return 1 << min(16, max(8, (16 * n).bit_length() - 1))


def bitmap(found: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of shingles; the first bits of a hash, mixed once more, are its place.

    Prefixes are the least hashes of their sets, which without mixing would share the first few places.
    """
    places = (found.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits.bit_length() + 1)
    out = np.zeros(bits // 64, dtype=np.uint64)
    np.bitwise_or.at(out, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))
    return out


def folded(raw: bytes, bits: int) -> np.ndarray:
    """A stored bitmap at a smaller width: neighbouring bits become one."""
    if len(raw) * 8 == bits:
        return np.frombuffer(raw, dtype=np.uint64)
    single = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little").reshape(bits, -1).any(axis=1)
    return np.packbits(single, bitorder="little").view(np.uint64)


class Tree:
    """A signature tree over records sorted so that similar ones are neighbours.

    A record is a set, or a part of one: ``known`` shingles of a set of ``sizes``. Level 0 holds the
    leaves. Nodes are numbered; a node's children and records are ranges.
    """

    def __init__(self, maps: np.ndarray, known: np.ndarray, sizes: np.ndarray):
        # Shingles of a record beyond its bits: so much more than the common bits two records may share.
        excess = known - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        # Per level: bitmaps, least and largest size, largest excess, most shingles that the part lacks.
        level = (maps, sizes, sizes, excess, sizes - known)
        combine = (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.maximum)
        self.levels, self.steps, self.n = [level], [1], len(maps)
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), FAN)
            level = tuple(f.reduceat(values, starts, axis=0) for f, values in zip(combine, level))
            self.levels.append(level)
            self.steps.append(self.steps[-1] * FAN)

    def top(self) -> int:
        return len(self.levels) - 1

    def records(self, level: int, node: int) -> range:
        step = self.steps[level]
        return range(node * step, min((node + 1) * step, self.n))

    def children(self, level: int, node: int) -> range:
        return range(node * FAN, min((node + 1) * FAN, len(self.levels[level - 1][0])))

    def may_link(self, level: int, a: int, b: int, share: int) -> bool:
        """Can a record below one node reach a record below the other?"""
        maps, low, high, excess, rest = self.levels[level]
        if 100 * high[a] < share * low[b] or 100 * high[b] < share * low[a]:
            return False
        common = int(np.bitwise_count(maps[a] & maps[b]).sum()) + min(excess[a], excess[b])
        overlap = min(common + max(rest[a], rest[b]), high[a], high[b])
        return (100 + share) * overlap >= share * (low[a] + low[b])

    def pairs(self, a: range, b: range, share: int) -> np.ndarray:
        """Places in two ranges of records that may be linked, all compared at once."""
        maps, sizes, _, excess, rest = self.levels[0]
        x, y = slice(a.start, a.stop), slice(b.start, b.stop)
        common = np.bitwise_count(maps[x][:, None, :] & maps[y][None, :, :]).sum(axis=2, dtype=np.int64)
        common += np.minimum.outer(excess[x], excess[y]) + np.maximum.outer(rest[x], rest[y])
        overlap = np.minimum(common, np.minimum.outer(sizes[x], sizes[y]))
        return np.argwhere((100 + share) * overlap >= share * np.add.outer(sizes[x], sizes[y]))


class Groups:
    """Union-find whose roots are the smallest members."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, n: int) -> int:
        while self.parent[n] != n:
            self.parent[n] = self.parent[self.parent[n]]
            n = self.parent[n]
        return n

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)

    def one(self, *ranges: range) -> bool:
        root = self.root(ranges[0][0])
        return all(self.root(n) == root for r in ranges for n in r)


def linked(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, share: int) -> bool:
    """Are two sets linked? Of parts: can their sets be linked?

    Parts are the first shingles in one order, so all common shingles up to the nearer one of the two
    ends are in both; beyond it there are no more than that set has left.
    """
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    overlap = int((b[at] == a).sum()) + max(size_a - len(a), size_b - len(b))
    return (100 + share) * overlap >= share * (size_a + size_b)


def traverse(
    tree: Tree, labels: np.ndarray, share: int, confirmed: Callable[[int, int], bool], sides: np.ndarray | None = None
) -> Groups:
    """Groups of records that are joined by links between different labels, and different sides if there are any.

    ``labels`` names the groups known before: within one nothing is looked for. They join no records
    here, because a link may be a possible one only, and who is in a group with one end of it must
    still meet the other end.
    """
    groups = Groups(tree.n)
    todo = [(tree.top(), 0, 0)]
    while todo:
        level, a, b = todo.pop()
        both = tree.records(level, a), tree.records(level, b)
        known = {name for r in both for name in labels[r.start : r.stop].tolist()}
        met = {0, 1} if sides is None else {side for r in both for side in sides[r.start : r.stop].tolist()}
        if len(known) == 1 or len(met) == 1 or groups.one(*both) or (a != b and not tree.may_link(level, a, b, share)):
            continue
        if level <= 1:
            for i, j in tree.pairs(*both, share).tolist():
                i, j = both[0].start + i, both[1].start + j
                if i == j or labels[i] == labels[j] or (sides is not None and sides[i] == sides[j]):
                    continue
                if groups.root(i) != groups.root(j) and confirmed(i, j):
                    groups.join(i, j)
            continue
        below_a, below_b = tree.children(level, a), tree.children(level, b)
        # What is popped first is pushed last: nodes with themselves, where most links are.
        todo += [(level - 1, x, y) for x in below_a for y in below_b if a != b or x < y]
        if a == b:
            todo += [(level - 1, x, x) for x in below_a]
    return groups


def compare_sets(records: list[tuple], share: int) -> tuple[list[int], Groups]:
    """Groups of records (class_id, label, size, shingles), whole sets or parts; the ids in the groups' order."""
    records = sorted(records, key=lambda r: (int(r[3][0]), r[2], r[0]))
    ids, labels, sizes, sets = zip(*records)
    sizes, known = np.array(sizes, dtype=np.int64), np.array(list(map(len, sets)), dtype=np.int64)
    bits = width(int(np.median(known)))
    tree = Tree(np.stack([bitmap(s, bits) for s in sets]), known, sizes)
    confirmed = lambda a, b: linked(sets[a], sets[b], int(sizes[a]), int(sizes[b]), share)
    return list(ids), traverse(tree, np.array(labels), share, confirmed)


def compare_texts(rows: list[tuple], k: int, share: int) -> tuple[list[int], Groups]:
    """Groups by links of records (class_id, label, n, text)."""
    return compare_sets([(i, label, n, shingles(text, k)) for i, label, n, text in rows], share)


def compare_parts(rows: list[tuple], share: int) -> tuple[list[int], Groups]:
    """Groups by possible links of records (class_id, label, n, sorted prefix); its shingles may be shortened, and two then be equal."""
    return compare_sets([(i, label, n, np.frombuffer(raw, dtype=np.int64)) for i, label, n, raw in rows], share)


def packed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows whose last column is a prefix, as the bytes of its sorted shingles: a list of numbers takes four times as much."""
    return ((*row, np.sort(np.array(prefix, dtype=np.int64)).tobytes()) for *row, prefix in rows)


def compare_prefixes(rows: list[tuple], share: int) -> tuple[list[int], Groups]:
    """Groups by possible links of records (class_id, label, n, bitmap of the prefix).

    The prefixes are the first shingles in one order, so all common shingles up to the nearer one of
    two prefixes' ends are in both; beyond it there are no more than that set has left.
    """
    classes: dict[int, list[tuple]] = {}
    for row in rows:
        classes.setdefault(8 * len(row[3]), []).append(row)
    ids, place_of = [row[0] for row in rows], {row[0]: n for n, row in enumerate(rows)}
    groups = Groups(len(rows))
    widths = sorted(classes)
    for n, bits in enumerate(widths):
        for other in widths[n:]:
            # Bitmaps of different widths meet at the smaller one, if the sizes can be linked at all.
            if 100 * max(r[2] for r in classes[bits]) < share * min(r[2] for r in classes[other]):
                continue
            found = classes[bits] + (classes[other] if other != bits else [])
            found = sorted(((folded(r[3], bits), r) for r in found), key=lambda x: (x[0].tobytes(), x[1][0]))
            maps, met = zip(*found)
            sizes = np.array([r[2] for r in met], dtype=np.int64)
            tree = Tree(np.stack(maps), sizes + sizes * share // -100 + 1, sizes)
            sides = np.array([len(r[3]) for r in met]) if other != bits else None
            joined = traverse(tree, np.array([r[1] for r in met]), share, lambda a, b: True, sides)
            for place, row in enumerate(met):
                groups.join(place_of[row[0]], place_of[met[joined.root(place)][0]])
    return ids, groups


def groups_of(rows: Iterator[tuple], keys: int, compare) -> Iterator[tuple]:
    """Of rows sorted by their first ``keys`` columns: a number for the key, and each joined record under the
    least id of its group."""
    for key, group in groupby(rows, key=lambda r: r[:keys]):
        records = list({r[keys]: r[keys:] for r in group}.values())
        if len(records) < 2:
            continue
        ids, groups = compare(records)
        found = xxhash.xxh64_intdigest(repr(key)) - (1 << 63)
        members: dict[int, list[int]] = {}
        for place, class_id in enumerate(ids):
            members.setdefault(groups.root(place), []).append(class_id)
        for joined in members.values():
            least = min(joined)
            if len(joined) > 1:
                yield from ((found, least, class_id) for class_id in joined)


def traversed(members: DataFrame, keys: list[str], payload: DataFrame, compare, read=iter) -> DataFrame:
    """(found, least, class_id): what ``compare`` joins in every group of ``keys`` of ``members`` (keys, class_id, label, n).

    ``payload`` (class_id, payload) has what records are made of; ``read`` is applied to the rows as they come. The ids are sent to its scan if they
    are few enough, so only what is needed is shuffled; else both sides are. A task reads its groups
    one after the other.
    """
    ids = members.select("class_id").distinct()
    if ids.limit(SENT_IDS + 1).count() <= SENT_IDS:
        payload = payload.join(F.broadcast(ids), "class_id", "left_semi")
    full = members.join(payload, "class_id").select(*keys, "class_id", "label", "n", "payload")
    sorted_groups = full.repartition(*keys).sortWithinPartitions(*keys)
    n_keys = len(keys)
    return map_rows(sorted_groups, lambda rows: groups_of(read(rows), n_keys, compare), GROUP_SCHEMA)


def as_links(groups: DataFrame) -> DataFrame:
    """Each member linked with the least one of its group."""
    return groups.where("class_id <> least").select(F.col("class_id").alias("u"), F.col("least").alias("v")).distinct()


def once(groups: DataFrame) -> DataFrame:
    """Groups with the same members once: number, extremes and two sums of hashes tell sets apart."""
    sets = groups.groupBy("found", "least").agg(
        F.count("*").alias("members"), F.max("class_id").alias("most"),
        F.bit_xor(F.xxhash64("class_id")).alias("x1"), F.bit_xor(F.xxhash64("class_id", F.lit(1))).alias("x2"),
    )
    first = sets.groupBy("least", "members", "most", "x1", "x2").agg(F.min("found").alias("found")).select("found", "least")
    return groups.join(written(first, "sets"), ["found", "least"])


def divided(rows: DataFrame, share: int, weight: str) -> tuple[DataFrame, list[str]]:
    """``rows`` (block, class_id, n, label) as members of the pairs of nodes that may hold a link.

    Blocks that hold one group are gone. A block is divided by size band, and a band by hash into
    nodes of at most about WEIGHT (the sum of the expression ``weight``). A pair of nodes is left out if
    all in it is one group or if the sizes are too far apart.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / log(100 / share)).cast("int")
    # A block that fits one task is one node.
    heavy = rows.groupBy("block").agg(F.sum(F.expr(weight)).alias("all"), F.min("label").alias("low"), F.max("label").alias("high"))
    heavy = written(heavy.where("low < high").select("block", (F.col("all") > WEIGHT).alias("heavy")), "heavy")
    rows = rows.join(heavy, "block").withColumn("band", F.when(F.col("heavy"), band).otherwise(F.lit(0))).drop("heavy")
    rows = written(rows, "open_blocks")
    parts = rows.groupBy("block", "band").agg(F.ceil(F.sum(F.expr(weight)) / WEIGHT).alias("parts"))
    placed = rows.join(parts, ["block", "band"]).withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts")))
    placed = written(placed.drop("parts"), "placed")
    # The upper levels of the trees: size range and group of each node; pairs of them that may hold a link.
    nodes = placed.groupBy("block", "band", "part").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    left = nodes.select("block", *(F.col(c).alias(f"{c}_a") for c in nodes.columns if c != "block"))
    right = nodes.select("block", *(F.col(c).alias(f"{c}_b") for c in nodes.columns if c != "block"))
    # A link's sizes differ by less than one band's width, so they are in one band or in neighbouring ones.
    ordered = (F.col("band_b") == F.col("band_a") + 1) | ((F.col("band_a") == F.col("band_b")) & (F.col("part_a") <= F.col("part_b")))
    mixed = ~((F.col("low_a") == F.col("high_a")) & (F.col("low_b") == F.col("high_b")) & (F.col("low_a") == F.col("low_b")))
    fits = (F.col("most_a") * 100 >= F.col("least_b") * share) & (F.col("most_b") * 100 >= F.col("least_a") * share)
    key = ["block", "band_a", "part_a", "band_b", "part_b"]
    pairs = written(left.join(right, "block").where(ordered & mixed & fits).select(*key), "node_pairs")
    side_a = pairs.join(placed.withColumnsRenamed({"band": "band_a", "part": "part_a"}), ["block", "band_a", "part_a"])
    side_b = pairs.where("band_a <> band_b OR part_a <> part_b").join(
        placed.withColumnsRenamed({"band": "band_b", "part": "part_b"}), ["block", "band_b", "part_b"]
    )
    columns = [*key, "class_id", "label", "n"]
    return side_a.select(*columns).unionByName(side_b.select(*columns)), key


def first_round(shared: DataFrame, short: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """Links in one block per class: that of its first shared shingle.

    A heavy block is divided by hash; the class with the least id is in each part, so parts of a
    group of copies meet in it. Only the texts of classes whose prefixes let them be linked are read.
    """
    one = written(shared.groupBy("class_id", "n").agg(F.min("shingle").alias("block")), "round_one")
    blocks = one.groupBy("block").agg(
        F.min(F.struct("class_id", "n")).alias("leader"), F.count("*").alias("members"), F.sum("n").alias("weight")
    )
    blocks = blocks.where("members > 1").select("block", "leader", F.ceil(F.col("weight") / WEIGHT).alias("parts"))
    rows = one.join(blocks, "block").select("block", F.pmod(F.xxhash64("class_id"), F.col("parts")).alias("part"), "class_id", "n")
    leaders = blocks.where("parts > 1").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "leader.*"
    )
    members = written(rows.unionByName(leaders).withColumn("label", F.col("class_id")), "members_one")
    bits = short.select("class_id", F.col("bits").alias("payload"))
    met = written(traversed(members, ["block", "part"], bits, lambda rows: compare_prefixes(rows, share)), "near_one")
    members = met.join(one.select("class_id", "n"), "class_id").withColumn("label", F.col("class_id"))
    return as_links(traversed(members, ["found", "least"], texts, lambda rows: compare_texts(rows, k, share)))


def second_round(shared: DataFrame, groups: DataFrame, short: DataFrame, texts: DataFrame, k: int, share: int) -> DataFrame:
    """Links across groups in all blocks that hold classes of several groups."""
    # Of a pair's first common shingle: no more can be common than the set has from there on, so it
    # is linked with no set larger than this.
    reach = F.floor((F.col("n") - F.col("place")) * (100 + share) / share).cast("long") - F.col("n")
    labelled = shared.join(groups, F.col("class_id") == F.col("node"), "left").select(
        "shingle", "class_id", "n", reach.alias("reach"), F.coalesce("component", "class_id").alias("label")
    )
    labelled = written(labelled, "labelled")
    mixed = labelled.groupBy("shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least"), F.max("reach").alias("farthest")
    )
    mixed = written(mixed.where("low < high").select("shingle", "least", "farthest"), "mixed")
    useful = labelled.join(mixed, "shingle").where("reach >= least AND n <= farthest")
    useful = written(useful.select("shingle", "class_id", "n", "label"), "useful")
    open_blocks = useful.groupBy("shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        # Blocks with the same members need one visit: number, extremes and two sums of hashes tell them apart.
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("class_id")).alias("x1"), F.bit_xor(F.xxhash64("class_id", F.lit(1))).alias("x2"),
    ).where("low < high")
    open_blocks = open_blocks.groupBy("low", "high", "members", "x1", "x2").agg(F.min("shingle").alias("shingle")).select("shingle")
    open_blocks = written(open_blocks, "open")
    rows = useful.join(open_blocks, "shingle").select(F.col("shingle").alias("block"), "class_id", "n", "label")
    members, key = divided(rows, share, f"n - ceil(n * {share} / 100) + 1")
    bits = short.select("class_id", F.col("bits").alias("payload"))
    met = written(traversed(members, key, bits, lambda rows: compare_prefixes(rows, share)), "met_by_bits")
    known = written(labelled.select("class_id", "n", "label").distinct(), "known")
    members = written(once(met).join(known, "class_id").select("found", "least", "class_id", "label", "n"), "met_once")
    # Half of each hash is enough here: shingles that are taken for one only make a link look possible.
    parts = short.select("class_id", F.transform("shingles", lambda s: s.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("payload"))
    near = traversed(members, ["found", "least"], parts, lambda rows: compare_parts(rows, share), packed)
    clusters = components(written(as_links(near), "near"))
    rows = clusters.join(known, F.col("node") == F.col("class_id")).select(F.col("component").alias("block"), "class_id", "n", "label")
    members, key = divided(rows, share, "n")
    return as_links(traversed(members, key, texts, lambda rows: compare_texts(rows, k, share)))


def join(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``: two documents are linked when
    100 * intersection >= ``share`` * union of their sets of ``k``-word shingles.

    Words are stretches without ASCII white space, A-Z in lower case. A document with fewer words is
    one shingle of all of them; one without words, or with a null text, is linked with nothing.
    ``component_id`` is the smallest doc_id that links lead to. A null id takes no part: its row has
    its set's size and a null component. Rows that share an id should share the text; they are one
    document each with its own set, and the id's component is the least one found. An empty table
    gives an empty one; columns other than doc_id and text are not read.
    """
    docs = docs.select("doc_id", "text")
    passed = written(first_pass(docs, k), "first_pass")
    sets = passed.where("shingle IS NULL").select("doc_id", "n", "d1", "d2")
    named = sets.where("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("class_id"), F.max("doc_id").alias("last"))
    classes = written(classes, "classes")
    late = frequent(passed)
    short = prefixes(docs, k, share, late).join(classes.select("class_id"), F.col("doc_id") == F.col("class_id"), "left_semi")
    short = written(short.withColumnRenamed("doc_id", "class_id"), "prefixes")
    rows = short.select("class_id", "n", F.posexplode("shingles").alias("place", "shingle"))
    met = rows.groupBy("shingle").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high")).where("low < high")
    # Stored, so that nothing but its shuffle is below the join and a frequent shingle's rows are split.
    met = written(met.select("shingle"), "met")
    shared = written(rows.join(met, "shingle").select("shingle", "class_id", "n", "place"), "shared")
    texts = docs.select(F.col("doc_id").alias("class_id"), F.col("text").alias("payload"))
    links = written(first_round(shared, short, texts, k, share), "links_one")
    groups = components(links)
    more = written(second_round(shared, groups, short, texts, k, share), "links_two")
    groups = components(links.unionByName(more))
    of_class = classes.join(groups, F.col("class_id") == F.col("node"), "left").select(
        "d1", "d2", F.coalesce("component", "class_id").alias("class_component")
    )
    told = sets.join(of_class, ["d1", "d2"], "left")
    return told.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), F.lit(None).cast("long"))
        .when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("class_component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, k: int = 5, share: int = 80) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id; all columns kept.

    Rows without an id, words or text stay.
    """
    groups = join(docs, k, share)
    return drop_ids(docs, "doc_id", groups.where("doc_id <> component_id").select("doc_id"))

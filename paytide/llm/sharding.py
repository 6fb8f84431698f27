"""Sharding by balanced label propagation, in DataFrame functions only.

Documents with equal texts are linked, each with every other of its group. Every document starts with a label by a hash of
its own; then rounds of joins move documents to the shard that most of their neighbours are in. Members of a group with one
label behave alike, so a round works on one row per group and label, however large the group is.

Shards have quotas. What leaves a shard in a round is room for what comes, so full shards can swap; how much may enter each
is found from the numbers that wish to go from shard to shard, and groups are admitted in an order that puts larger ones first, up
to that quota. First groups move whole or not at all, which cuts nothing; when no whole group can move any more, what is left moves in
parts, so that a group that fits nowhere whole is in few shards. Groups that are together leave the rounds, which shrink quickly.
A group that is large beside a shard starts where it fits best, or fills one shard after the other; these
are so few (16 per shard or so) that they are placed on the driver.

The law is ``rows``: in the end the numbers of documents per shard differ by one at most. Documents without a link have no
neighbours to go to and count in no quota; what a shard holds beyond its number is handed to shards that lack some, these first,
because moving them cuts nothing, then groups that are divided anyway, then whole groups one after the
other, so each end of a stretch cuts one group at most.

Slots, and the order of admission, are counted in buckets of bounded size whose offsets are summed up, so no task
sees a whole shard.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import written

SHARDS = 8
# Documents per bucket, on average, when slots are counted.
BUCKET_ROWS = 20_000
# Steps a group can be divided into when it is in several shards.
STEPS = 1 << 20
# A group of more than one part in so many of a shard is placed by its number, not by chance.
LARGE = 16

# Rounds at most, of each kind; they end when nothing moves.
ROUNDS = 12

KEY = ("g1", "g2", "size")


def measured(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, g1, g2, start): all that is needed of the texts.

    A null text has the size 1, the checksum 0 and the group of the empty text.
    """
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64(text).alias("g1"), F.xxhash64(text, F.lit("second")).alias("g2"),
    )
    return rows.withColumn("start", F.pmod(F.xxhash64("doc_id", "g1", F.lit("start")), F.lit(shards)).cast("int"))


def case(column: Column, values: list[int]) -> Column:
    """The value at the place a column names."""
    return F.element_at(F.array(*map(F.lit, values)).cast("array<bigint>"), column.cast("int") + 1)


def goals(total: int, shards: int) -> list[int]:
    """Numbers of documents per shard that differ by one at most."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def packed(members: list[int], free: list[int]) -> list[list[tuple[int, int]]]:
    """(shard, n) parts of each group, given the largest first; ``free`` is reduced by them.

    A group goes whole where it leaves the least room. One that fits nowhere takes the shards with most
    room one after the other.
    """
    out = []
    for left in members:
        fits = [s for s in range(len(free)) if free[s] >= left]
        order = [min(fits, key=lambda s: (free[s], s))] if fits else sorted(range(len(free)), key=lambda s: (-free[s], s))
        parts = []
        for s in order:
            n = min(left, free[s])
            if n:
                parts.append((s, n))
                free[s] -= n
                left -= n
        out.append(parts)
    return out


def seeds(rows: DataFrame, shards: int, total: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Where groups of two or more start, as (key, label, n): the large ones, the others, and what the large ones leave free.

    Documents of the others start each by a hash of its own, in proportion to the room there is.
    """
    sizes = written(rows.groupBy(*KEY).agg(F.count("*").alias("members")).where("members > 1"), "shard_groups")
    free = goals(total, shards)
    is_large = F.col("members") * (LARGE * shards) > total
    large = sorted(sizes.where(is_large).collect(), key=lambda r: (-r["members"], r["g1"], r["g2"], r["size"]))
    told = [
        {**{k: r[k] for k in KEY}, "label": s, "n": n}
        for r, parts in zip(large, packed([r["members"] for r in large], free)) for s, n in parts
    ]
    kind = "array<struct<g1:bigint,g2:bigint,size:bigint,label:int,n:bigint>>"
    known = rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(told)), kind)))
    ends, upto = [], 0
    for n in free:
        upto += n
        ends.append(upto * STEPS // max(1, sum(free)))
    place = F.pmod(F.xxhash64("doc_id", "g1", F.lit("seed")), F.lit(STEPS))
    label = reduce(lambda rest, s: F.when(place < ends[s], F.lit(s)).otherwise(rest), reversed(range(shards)), F.lit(shards - 1))
    # Reduced before the join, so a group is a row per shard in it.
    by_hash = rows.groupBy(*KEY, label.alias("label")).agg(F.count("*").alias("n"))
    return known, by_hash.join(sizes.where(~is_large).select(*KEY), list(KEY), "left_semi"), free


def quotas(wanted: dict[tuple[int, int], int], room: list[int]) -> list[int]:
    """How many may enter each shard, of those that wish to go from shard to shard.

    Begins with all of them and takes back what exceeds a shard's room and what leaves it, until nothing does:
    the shards can then all be served at once, full ones by swapping.
    """
    share = [1.0] * len(room)
    entering = [sum(n for (_, to), n in wanted.items() if to == s) for s in range(len(room))]
    for _ in range(200):
        leaving = [sum(n * share[to] for (at, to), n in wanted.items() if at == s) for s in range(len(room))]
        new = [min(share[s], max(0.0, room[s] + leaving[s]) / entering[s]) if entering[s] else 0.0 for s in range(len(room))]
        if max(abs(a - b) for a, b in zip(new, share)) < 1e-6:
            break
        share = new
    return [int(share[s] * entering[s] + 0.5) for s in range(len(room))]


def wishes(scattered: DataFrame, open_to: list[bool], nth: int) -> DataFrame:
    """(key, to, there, need): the open shard most members of a group are in, how many are there, and how many are not."""
    tie = F.xxhash64(*KEY, "label", F.lit(nth))
    best = F.max(F.when(case(F.col("label"), [int(o) for o in open_to]) == 1, F.struct("n", tie.alias("tie"), "label")))
    asked = scattered.groupBy(*KEY).agg(F.sum("n").alias("members"), best.alias("best")).where("best IS NOT NULL")
    return asked.select(
        *KEY, F.col("best.label").alias("to"), F.col("best.n").alias("there"), (F.col("members") - F.col("best.n")).alias("need")
    ).where("need > 0")


def admitted(asked: DataFrame, quota: list[int], count: int, nth: int, whole: bool) -> DataFrame:
    """(key, to, moves): how many of each group may enter, larger groups first and then by a hash."""
    if whole:
        # A group that cannot enter holds up none behind it.
        asked = asked.where(F.col("need") <= case(F.col("to"), quota))
    buckets = max(1, count // BUCKET_ROWS)
    cell = ["to", "turn", "bucket"]
    queued = asked.withColumns({
        "turn": -F.floor(F.log2(F.col("there") + F.col("need"))).cast("int"),
        "bucket": F.pmod(F.xxhash64(*KEY, F.lit(nth)), F.lit(buckets)),
    })
    sums = queued.groupBy(*cell).agg(F.sum("need").alias("asks"))
    before = Window.partitionBy("to").orderBy("turn", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*cell, F.coalesce(F.sum("asks").over(before), F.lit(0)).alias("offset"))
    ahead = Window.partitionBy(*cell).orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    placed = queued.withColumn("ahead", F.coalesce(F.sum("need").over(ahead), F.lit(0))).join(offsets, cell)
    left = case(F.col("to"), quota) - F.col("offset") - F.col("ahead")
    moves = F.when(left >= F.col("need"), F.col("need")).otherwise(0 if whole else F.greatest(left, F.lit(0)))
    return placed.select(*KEY, "to", moves.alias("moves")).where("moves > 0")


def moved(scattered: DataFrame, entering: DataFrame) -> DataFrame:
    """Where the members are after a round: those that enter a shard come from the group's smallest parts."""
    line = Window.partitionBy(*KEY).orderBy(F.col("label") == F.col("to"), "n", "label").rowsBetween(Window.unboundedPreceding, -1)
    joined = scattered.join(entering, list(KEY), "left").withColumn("before", F.coalesce(F.sum("n").over(line), F.lit(0)))
    goes = F.when(
        F.col("to").isNotNull() & (F.col("label") != F.col("to")),
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("moves") - F.col("before"))),
    ).otherwise(0)
    told = joined.withColumn("goes", goes).select(
        *KEY, F.inline(F.array(
            F.struct("label", (F.col("n") - F.col("goes")).alias("n")), F.struct(F.col("to").alias("label"), F.col("goes").alias("n")),
        )),
    )
    return told.where("n > 0").groupBy(*KEY, "label").agg(F.sum("n").alias("n"))


def propagated(start: DataFrame, goal: list[int]) -> DataFrame:
    """(key, label, n) after the rounds, with ``goal`` documents at most in each shard.

    At most one row per shard or pair of shards reaches the driver in each round.
    """
    state, whole, nth, last = start, True, 0, 0
    settled: list[DataFrame] = []
    held = [0] * len(goal)
    while True:
        # At most as many rows per group as there are shards.
        parts = F.count("*").over(Window.partitionBy(*KEY))
        state = written(state.withColumn("parts", parts), "shard_round")
        together, state = state.where("parts = 1").drop("parts"), state.where("parts > 1").drop("parts")
        settled.append(together)
        for r in together.groupBy("label").agg(F.sum("n").alias("n")).collect():
            held[r["label"]] += r["n"]
        loads = list(held)
        for r in state.groupBy("label").agg(F.sum("n").alias("n")).collect():
            loads[r["label"]] += r["n"]
        room = [g - n for g, n in zip(goal, loads)]
        # Where only what is together is more than the goal, nothing can enter.
        asked = written(wishes(state, [h < g for h, g in zip(held, goal)], nth), "shard_wishes")
        asking = asked.count()
        if not asking:
            break
        pairs = state.join(asked.select(*KEY, "to"), list(KEY)).where("label <> to").groupBy("label", "to").agg(F.sum("n").alias("n"))
        quota = quotas({(r["label"], r["to"]): r["n"] for r in pairs.collect()}, room)
        entering = written(admitted(asked, quota, asking, nth, whole), "shard_moves")
        nth += 1
        if entering.isEmpty() or nth - last >= ROUNDS:
            if not whole:
                break
            whole, last = False, nth
            continue
        state = moved(state, entering)
    return reduce(DataFrame.unionByName, [*settled, state])


def placed(rows: DataFrame, shards: int, total: int) -> DataFrame:
    """(g1, g2, size, parts): in which shards the members of each group of two or more are, and how many."""
    large, small, free = seeds(rows, shards, total)
    labels = large.unionByName(propagated(small, free))
    return labels.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct(F.col("label").alias("shard"), "n"))).alias("parts"))


def labelled(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Each document's shard so far, its group's members, and its turn: 2 to be handed over first.

    A group in several shards is divided by a hash of the document, in proportion.
    """
    # Stored, so that nothing but its shuffle is below the join and a large group's rows are split.
    known = rows.join(written(parts, "shard_parts"), list(KEY), "left")
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("int").alias("shard"))
    whole = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
    place = F.pmod(F.xxhash64("doc_id", "g1", F.lit("part")), F.lit(STEPS))
    # The first part whose end, as a share of the group, lies beyond the document's place.
    picked = F.aggregate(
        "parts", zero,
        lambda acc, p: F.struct(
            (acc["upto"] + p["n"]).alias("upto"),
            F.when(acc["shard"].isNull() & (place * whole < (acc["upto"] + p["n"]) * STEPS), p["shard"])
            .otherwise(acc["shard"]).alias("shard"),
        ),
    )["shard"]
    return known.select(
        "doc_id", "size", "text_crc32", "g1", "g2", F.coalesce(picked, "start").alias("label"),
        F.coalesce(whole, F.lit(1)).alias("members"),
        F.when(F.col("parts").isNull(), 2).when(F.size("parts") > 1, 1).otherwise(0).alias("turn"),
    )


def ranked(labels: DataFrame, total: int) -> DataFrame:
    """``place``: the documents of each shard counted from 0, those in groups first, group by group."""
    buckets = max(1, total // BUCKET_ROWS)
    cell = ["label", "turn", "bucket", "sub"]
    # A group beyond a bucket's size is divided further by a hash of the document.
    rows = labels.withColumns({
        "bucket": F.pmod(F.xxhash64(*KEY, F.lit("bucket")), F.lit(buckets)),
        "sub": F.pmod(F.xxhash64("doc_id", "g1", F.lit("sub")), F.floor(F.col("members") / BUCKET_ROWS) + 1),
    })
    counts = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    before = Window.partitionBy("label").orderBy("turn", "bucket", "sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy(*cell).orderBy("g1", "g2", "size", "doc_id")
    return rows.withColumn("nth", F.row_number().over(within) - 1).join(offsets, cell).withColumn(
        "place", F.col("offset") + F.col("nth")
    )


def settle(counts: list[int]) -> tuple[list[int], list[int], list[tuple[int, int, int, int]]]:
    """Equal numbers from given ones.

    Returns how many each shard keeps, the running number of the first document it hands over, and
    the stretches of running numbers as (from, to, shard that takes them, its first free slot).
    """
    total, shards = sum(counts), len(counts)
    # The larger number goes to the fuller shards, so the fewest move.
    order = sorted(range(shards), key=lambda s: (-counts[s], s))
    goal = [0] * shards
    for s, n in zip(order, goals(total, shards)):
        goal[s] = n
    keep = [min(counts[s], goal[s]) for s in range(shards)]
    first, takes, given, taken = [], [], 0, 0
    for s in range(shards):
        first.append(given)
        given += counts[s] - keep[s]
        lack = goal[s] - keep[s]
        if lack:
            takes.append((taken, taken + lack, s, keep[s]))
            taken += lack
    return keep, first, takes


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    Slots count the documents of a shard from 0 without gaps; ``grown_shard`` is null under this
    law. Null ids and repeated rows are documents of their own; rows equal
    in everything share their slots in any order. An empty table gives an empty one, and columns
    other than doc_id and text are not read.
    """
    rows = written(measured(docs.select("doc_id", "text"), shards), "shard_rows")
    total = rows.count()
    labels = written(labelled(rows, placed(rows, shards, total)), "shard_labels")
    counts = [0] * shards
    for r in labels.groupBy("label").count().collect():
        counts[r["label"]] = r["count"]
    keep, first, takes = settle(counts)
    place, label = F.col("place"), F.col("label")
    stays = place < case(label, keep)
    running = case(label, first) + place - case(label, keep)

    def of_taker(value) -> Column:
        return reduce(
            lambda rest, t: F.when(F.col("running") < t[1], value(t)).otherwise(rest),
            reversed(takes), F.lit(None).cast("long"),
        )

    told = ranked(labels, total).withColumn("running", F.when(~stays, running))
    return told.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.when(stays, label).otherwise(of_taker(lambda t: F.lit(t[2]))).cast("int").alias("shard"),
        F.when(stays, place).otherwise(of_taker(lambda t: F.col("running") - t[0] + t[3])).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Near duplicates by SimHash fingerprints, found with covering locality-sensitive hashing.

A text's fingerprint has a bit set where over half of its shingles' hashes have it. Texts are linked if
their fingerprints differ in ``RADIUS`` bits or fewer.

Every bit position gets a vector of RADIUS + 1 bits that is not zero, and every such vector v gives a mask: the
positions whose vector has an odd product with v. RADIUS positions span less than the whole space, so some v is
orthogonal to all of them, and its mask leaves exactly these positions out. Whatever bits two linked
fingerprints differ in, they are equal under one of the 2^(RADIUS+1) - 1 masks: no link is lost, and nothing is
left to chance. Seven masks of 36 or 37 bits each serve radius two.

Fingerprints equal under a mask share a bucket. In a bucket of up to ``SMALL`` all are compared. A larger one, such as
thousands of variants of one page, is not compared pair by pair: two of its fingerprints are within two bits of
each other exactly if some value is within one bit of both, so each proposes itself and every value one free bit
away, and a value that several propose links them. That is linear in the bucket and spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from .components import components
from .tables import SENT_IDS, map_rows, written
from .words import word_blocks

BITS = 64
RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
SMALL = 32


def fingerprint(data: bytes, k: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a UTF-8 text as a signed number; 0 without words."""
    ones, n, carried = np.zeros(BITS, np.int64), 0, []
    for block in word_blocks(data.lower()):
        words = carried + block
        shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
        hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(hashes)
        carried = words[max(0, len(words) - k + 1) :]
    if not n:
        # Fewer than k words, so all are still carried, and they are one shingle.
        return int(np.uint64(xxh64_intdigest(b" ".join(carried), SEED)).astype(np.int64)) if carried else 0
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The covering family: wherever up to ``radius`` bits differ, one mask leaves all of them out."""
    vectors = range(1, 1 << (radius + 1))
    return [sum(1 << i for i in range(bits) if (vectors[i % len(vectors)] & v).bit_count() % 2) for v in vectors]


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; a null text has no words."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, data in rows:
            yield doc_id, fingerprint(data or b"", k)

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return map_rows(plain, rows_of, "doc_id long, fp long")


def signed(value: int) -> Column:
    return F.lit(value - (1 << BITS) if value >> (BITS - 1) else value).cast("long")


def close_in(members: Column) -> Column:
    """All links (u, v) in an array of fingerprints."""
    near = lambda x: lambda y: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= RADIUS)
    return F.flatten(
        F.transform(members, lambda x: F.transform(F.filter(members, near(x)), lambda y: F.struct(x.alias("u"), y.alias("v"))))
    )


def links(known: DataFrame, small: int = SMALL) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints of ``known`` (fp, distinct) that are within the radius.

    Links of large buckets lead through values that may be no one's fingerprint; who is connected stays the same.
    """
    family = masks()
    keys = [F.struct(F.lit(nth).alias("nth"), F.col("fp").bitwiseAND(signed(m)).alias("key")) for nth, m in enumerate(family)]
    tagged = known.select("fp", F.explode(F.array(*keys)).alias("bucket")).select("fp", "bucket.nth", "bucket.key")
    large = written(tagged.groupBy("nth", "key").agg(F.count("*").alias("n")).where(F.col("n") > small).drop("n"), "large")
    # A bucket holds more than ``small`` rows, so these are few; beyond the bound the same joins shuffle.
    sent = F.broadcast(large) if large.limit(SENT_IDS + 1).count() <= SENT_IDS else large
    compared = tagged.join(sent, ["nth", "key"], "left_anti").groupBy("nth", "key").agg(F.collect_list("fp").alias("members"))
    pairs = compared.where(F.size("members") > 1).select(F.explode(close_in(F.col("members"))).alias("link")).select("link.*")
    free = F.array(*[
        F.array(F.lit(0).cast("long"), *[signed(1 << i) for i in range(BITS) if not m >> i & 1]) for m in family
    ])
    crowded = tagged.join(sent, ["nth", "key"], "left_semi").select("fp", F.explode(F.element_at(free, F.col("nth") + 1)).alias("flip"))
    # At most 65 fingerprints are within one bit of a value.
    met = crowded.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).groupBy("value").agg(F.collect_set("fp").alias("members"))
    through = met.where(F.size("members") > 1).select(F.explode("members").alias("u"), F.col("value").alias("v"))
    return pairs.unionByName(through)


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, small: int = SMALL) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    ``component_id`` is the smallest doc_id that links lead to, the row's own included. A null or empty text has
    fingerprint zero and is linked like any other. A row without an id gets a fingerprint and a component, but
    gives no component its name: it is null only where no row of the component has an id. Repeated rows
    are all returned. An empty table gives an empty one. Other columns are not read.
    """
    every = written(fingerprints(docs, k), "fingerprints")
    known = written(every.groupBy("fp").agg(F.min("doc_id").alias("least")), "known")
    labels = components(links(known.select("fp"), small))
    rooted = known.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = written(rooted.select("fp", "least", F.coalesce("component", "fp").alias("root")), "rooted")
    # Stored, so that a component or a fingerprint that many share is split in the joins.
    names = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    named = written(rooted.join(names, "root").select("fp", "component_id"), "named")
    digits = F.lpad(F.lower(F.hex("fp")), BITS // 4, "0")
    return every.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")

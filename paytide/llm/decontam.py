"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is the hash of some words of a window; the mask says which, and the others may differ.
Seeds of all windows of the documents meet the seeds of the benchmark. Hits on one alignment of a
document with an item that lie close together are one stretch, and the stretch is verified word
by word: it counts if it is long enough and all but a fifth of its words agree, or if that holds
for the whole item. If neither holds, the part of the stretch with the most agreeing words for which it does
counts, so a passage is not lost because a weaker hit lies near it.

Both masks leave a gap for a word in four to be replaced. Words are runs of letters, marks and
digits in lower case. Items and documents of fewer words than a window have no seed, so they match
nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import SENT_IDS, drop_ids, written

WORD = r"[\p{L}\p{M}\p{N}]+"
# Which words of a window are hashed.
MASKS = ((0, 1, 3, 5, 6), (0, 2, 3, 4, 7))
SPAN = 8
# Hits on one alignment at most this far apart are one stretch.
GAP = 16
# A stretch of so many words, or the whole item, must agree in so many parts of a hundred.
LEAST_WORDS = 13
AGREE = 80
# Benchmark seeds up to this number (about 40 bytes each) are sent to every task; beyond it both sides shuffle.
SENT_SEEDS = 500_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def hashed(df: DataFrame, key: str) -> DataFrame:
    """(key, h): the hashes of a row's words in order."""
    return df.select(key, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))


def seeds(rows: DataFrame, key: str, at: str) -> DataFrame:
    """(key, at, seed, mask) for every window and mask of ``rows`` (key, h)."""
    h = F.col("h")

    def window(first: Column, i: Column) -> Column:
        return F.array(*(F.xxhash64(first, *(F.get(h, i + k) for k in mask[1:])) for mask in MASKS))

    starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - SPAN + 1, F.lit(0)))
    spread = rows.select(key, F.posexplode(F.flatten(F.transform(starts, window))).alias("n", "seed"))
    return spread.select(
        key, F.floor(F.col("n") / len(MASKS)).cast("int").alias(at), "seed", (F.col("n") % len(MASKS)).alias("mask")
    )


def stretches(hits: DataFrame) -> DataFrame:
    """Neighbouring hits of one alignment as one row: where it begins in the item, and its words."""
    line = Window.partitionBy("doc_id", "item_id", "shift").orderBy("q")
    new = F.coalesce((F.col("q") - F.lag("q").over(line) > GAP).cast("int"), F.lit(1))
    numbered = hits.withColumn("new", new).withColumn("stretch", F.sum("new").over(line))
    return numbered.groupBy("doc_id", "item_id", "shift", "stretch").agg(
        F.min("q").alias("first"), (F.max("q") - F.min("q") + SPAN).alias("n")
    )


def agreement(shift: Column, first: Column, n: Column) -> Column:
    """Which of the n item words from ``first`` on are the same in the document."""
    return F.zip_with(
        F.slice(F.col("doc"), shift + first + 1, n), F.slice(F.col("item"), first + 1, n),
        lambda a, b: F.coalesce(a == b, F.lit(False)),
    )


def agreeing(shift: Column, first: Column, n: Column) -> Column:
    """How many of the n item words from ``first`` on are the same in the document."""
    return F.size(F.filter(agreement(shift, first, n), lambda same: same))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def best_part(marks: Column) -> Column:
    """(n_same, fewest, earliest) of the best range with enough words of which enough agree; null if none.

    The most agreeing words win, then the fewest words, then the earliest. Such a range begins and
    ends with a run of agreeing words, because a whole run only adds to it.
    """

    def edges(m: Column, step: int) -> Column:
        at = F.transform(m, lambda same, i: F.when(same & ~F.coalesce(F.get(m, i + step), F.lit(False)), i))
        return F.filter(at, lambda i: i.isNotNull())

    def sums(starts: Column, stops: Column) -> Column:
        lengths = F.zip_with(starts, stops, lambda a, b: b - a + 1)
        return F.aggregate(lengths, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def best(starts: Column, stops: Column, before: Column) -> Column:
        def of_start(a: Column, i: Column) -> Column:
            parts = F.transform(F.slice(stops, i + 1, F.size(stops)), lambda b, j: F.struct(
                (F.get(before, i + j + 1) - F.get(before, i)).alias("n_same"), (a - b - 1).alias("fewest"), (-a).alias("earliest"),
            ))
            return F.array_max(F.filter(
                parts, lambda p: (-p["fewest"] >= LEAST_WORDS) & (p["n_same"] * 100 >= -p["fewest"] * AGREE)
            ))

        return F.array_max(F.transform(starts, of_start))

    return bound(marks, lambda m: bound(edges(m, -1), lambda starts: bound(edges(m, 1), lambda stops: bound(
        sums(starts, stops), lambda before: best(starts, stops, before)
    ))))


def overlaps(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_words, n_same, doc_word, item_word) per document and item it holds.

    ``docs`` has doc_id and text, ``tests`` item_id and text; other columns are not read. The row
    tells the verified stretch, or part of one, with the most agreeing words (then the fewest words, then the
    earliest), counted in words from 0. Null texts hold nothing; null ids are an id like any
    other; repeated rows give one result; empty tables an empty one.
    """
    docs, tests = docs.select("doc_id", "text"), tests.select("item_id", "text")
    items = hashed(tests, "item_id").where(F.size("h") >= SPAN).distinct()
    test_seeds = seeds(items, "item_id", "q").distinct()
    small = test_seeds.limit(SENT_SEEDS + 1).count() <= SENT_SEEDS
    sent = F.broadcast if small else (lambda side: side)

    hits = (
        seeds(hashed(docs, "doc_id"), "doc_id", "p").join(sent(test_seeds), ["seed", "mask"])
        .select("doc_id", "item_id", (F.col("p") - F.col("q")).alias("shift"), "q").distinct()
    )
    item_words = items.select(F.col("item_id").alias("i"), F.col("h").alias("item"))
    # Few documents hold anything, so their ids are known first, and only their texts are moved.
    alike = written(stretches(hits), "stretches")
    ids = alike.select(F.col("doc_id").alias("hit")).distinct()
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    texts = docs.select(F.col("doc_id").alias("d"), "text").join(
        F.broadcast(ids) if few else ids, F.col("d").eqNullSafe(F.col("hit")), "left_semi"
    )
    both = (
        alike.join(texts, F.col("doc_id").eqNullSafe(F.col("d")))
        .withColumn("doc", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))
        .join(sent(item_words), F.col("item_id").eqNullSafe(F.col("i")))
    )

    shift, first, n = F.col("shift"), F.col("first"), F.col("n")
    whole_from = F.greatest(F.lit(0), -shift)
    whole_n = F.least(F.size("item"), F.size("doc") - shift) - whole_from
    inside = both.where((shift + first >= 0) & (shift + first < F.size("doc")))
    judged = inside.select(
        "doc_id", "item_id", shift, first, n, F.size("item").alias("size"),
        agreeing(shift, first, n).alias("same"),
        whole_from.alias("whole_from"), agreeing(shift, whole_from, whole_n).alias("whole_same"),
        agreement(shift, first, n).alias("marks"),
    )
    stretch_ok = (F.col("n") >= LEAST_WORDS) & (F.col("same") * 100 >= F.col("n") * AGREE)
    whole_ok = F.col("whole_same") * 100 >= F.col("size") * AGREE
    # Only a stretch that fails as one and has enough words for a part is searched.
    searched = ~stretch_ok & ~whole_ok & (F.col("n") > LEAST_WORDS) & (F.col("same") * 100 >= LEAST_WORDS * AGREE)
    judged = judged.withColumn("part", F.when(searched, best_part(F.col("marks"))))
    in_part = F.col("part").isNotNull()
    told = judged.where(stretch_ok | whole_ok | in_part).select(
        "doc_id", "item_id",
        F.when(whole_ok, F.col("size")).when(in_part, -F.col("part.fewest")).otherwise(F.col("n")).alias("n_words"),
        F.when(whole_ok, F.col("whole_same")).when(in_part, F.col("part.n_same")).otherwise(F.col("same")).alias("n_same"),
        F.when(whole_ok, F.col("whole_from")).when(in_part, F.col("first") - F.col("part.earliest"))
        .otherwise(F.col("first")).alias("item_word"),
        "shift",
    )
    best = F.max(F.struct("n_same", (-F.col("n_words")).alias("fewest"), (-F.col("item_word") - F.col("shift")).alias("earliest"),
                          (-F.col("item_word")).alias("item_earliest")))
    return (
        told.groupBy("doc_id", "item_id").agg(best.alias("b"))
        .select("doc_id", "item_id", (-F.col("b.fewest")).alias("n_words"), F.col("b.n_same").alias("n_same"),
                (-F.col("b.earliest")).alias("doc_word"), (-F.col("b.item_earliest")).alias("item_word"))
    )


def clean(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark passage; all columns stay.

    Rows are told apart by a hash of the text, so null and repeated ids do no harm; a null text
    holds nothing and stays.
    """
    key = F.xxhash64("text")
    leaking = overlaps(docs.select(key.alias("doc_id"), "text"), tests).select("doc_id")
    keyed = docs.withColumn(KEY, F.when(F.col("text").isNotNull(), key))
    return drop_ids(keyed, KEY, leaking).select(*docs.columns)


# A name no input column has; the rows' text hash travels under it.
KEY = "decontam text hash"

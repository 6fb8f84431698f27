"""Substring dedup by hashing sentences and lines.

A unit is a stretch up to and with the next sentence end or line end, so the units of a text are
the text. A unit is compared by its words: lower-cased A-Z, any white space as one space. Digests
are grouped over the whole table; the occurrence in the smallest doc_id, and there the first, is
kept, every other one is a repeat.

Single common sentences are no reason to cut a text. Neighbouring repeats form a passage, and a
passage is removed if its units of ``SOLID`` words or more have ``LEAST_WORDS`` words together. In
scripts without blanks between words, ``WORD_SIGNS`` letters weigh as much as a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .tables import map_rows, written

UNIT = re.compile(r"[^\n.!?]*[.!?\n]+|[^\n.!?]+")
SOLID = 4
LEAST_WORDS = 20
# Thai, Lao, Burmese, Khmer, kana and Han letters.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
WORD_SIGNS = 2

UNIT_SCHEMA = "h1 long, h2 long, doc_id long, nth int, start int, stop int, n_words int, weight int, fresh boolean"


def unit_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Units of each text; ``fresh`` tells the first occurrence within the text."""
    for doc_id, text in rows:
        seen, ascii_only = set(), text.isascii()
        for nth, m in enumerate(UNIT.finditer(text)):
            words = m[0].encode().lower().split()
            digest = xxhash.xxh3_128_intdigest(b" ".join(words))
            h1, h2 = (digest >> 64) - (1 << 63), (digest & MASK) - (1 << 63)
            weight = max(len(words), 0 if ascii_only else len(UNSPACED.findall(m[0])) // WORD_SIGNS)
            yield h1, h2, doc_id, nth, m.start(), m.end(), len(words), weight if weight >= SOLID else 0, digest not in seen
            seen.add(digest)


MASK = (1 << 64) - 1


def units(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, nth, start, stop, n_words, weight, fresh) of every unit; offsets in code points."""
    named = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return map_rows(named.select("doc_id", "text"), unit_rows, UNIT_SCHEMA)


def passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, start, stop, n_units, n_words, kept_doc_id) of every passage to remove.

    ``kept_doc_id`` holds the kept occurrence of the passage's first unit; it may be the same
    document. Null ids and null texts are left out: they have no name to report, no text to
    repeat. Rows with the same id and text are one occurrence. An empty table gives an empty one.
    Other columns are not read.
    """
    every = units(docs)
    # Only digests of several documents are joined back; the sums are combined before the shuffle.
    spread = (
        every.where("fresh").groupBy("h1", "h2").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        .where("keeper < last").drop("last")
    )
    # A stored table has no aggregate left above its shuffle, so a unit that many documents share is split.
    spread = written(spread, "spread")
    told = every.join(spread, ["h1", "h2"], "left").where(~F.col("fresh") | (F.col("keeper") < F.col("doc_id")))
    repeats = told.select(
        "doc_id", "nth", "start", "stop", "n_words", "weight", F.coalesce("keeper", "doc_id").alias("kept")
    ).distinct()
    line = Window.partitionBy("doc_id").orderBy("nth")
    numbered = repeats.withColumn("run", F.col("nth") - F.row_number().over(line))
    return (
        numbered.groupBy("doc_id", "run").agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_units"),
            F.sum("n_words").alias("n_words"), F.min_by("kept", "nth").alias("kept_doc_id"), F.sum("weight").alias("weight"),
        )
        .where(F.col("weight") >= least_words)
        .select("doc_id", "start", "stop", "n_units", "n_words", "kept_doc_id")
    )


def without_passages(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the passages cut out of ``text``, all rows and columns kept.

    ``removed`` lists the cut stretches as (start, stop) of the original text.
    """
    cuts = passages(docs, least_words).groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("removed")
    )
    joined = docs.join(cuts.withColumnRenamed("doc_id", CUT_KEY), docs["doc_id"] == F.col(CUT_KEY), "left")
    begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    text = docs["text"]
    kept = F.aggregate(
        "removed", begin,
        lambda acc, cut: F.struct(
            F.concat(acc["text"], F.substring(text, acc["at"] + 1, cut["start"] - acc["at"])).alias("text"),
            cut["stop"].alias("at"),
        ),
        lambda acc: F.concat(acc["text"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    columns = [F.coalesce(kept, text).alias(c) if c == "text" else docs[c] for c in docs.columns]
    return joined.select(*columns, "removed")


# A name no input column has.
CUT_KEY = "repeats document"

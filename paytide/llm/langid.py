"""Language identification by rank order of n-grams.

A language is the list of its most frequent letter n-grams in order. So is a document. Their
out-of-place distance adds up, over the document's n-grams, how far each is from its place in
the language's list; an n-gram the list lacks counts the length of a list. The nearest
language wins.

Texts are lower-cased; every run of other characters than letters is one word border, and
n-grams of one to three characters, borders included, are packed into one integer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import map_rows, map_text

# Length of a rank list, of documents and languages alike.
RANKS = 300
UNKNOWN = "und"
BORDER = 32

COUNT_SCHEMA = "lang string, gram long, n long"
PREDICTED_SCHEMA = "doc_id long, lang_pred string, score double"

Profile = tuple[list[str], np.ndarray, np.ndarray]


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, packed; none if it has no letter. A lone border is no n-gram."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.empty(0, dtype=np.int64)
    # One border before, between and after the words.
    before = np.empty_like(is_letter)
    before[0] = False
    before[1:] = is_letter[:-1]
    keep = is_letter | before
    line = np.where(is_letter, codes, BORDER)[keep].astype(np.int64)
    if line[-1] != BORDER:
        line = np.append(line, BORDER)
    line = np.insert(line, 0, BORDER)
    pairs = line[:-1] | (line[1:] << 21)
    triples = pairs[:-1] | (line[2:] << 42)
    return np.concatenate([line[line != BORDER], pairs, triples])


def ranked(found: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by the packed value."""
    values, counts = np.unique(found, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:ranks]]


def learn(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, gram, place): the rank list of each language in ``docs`` (text, lang).

    All rows are counted. Rows without text, letters or language teach nothing.
    """

    def counts(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for text, lang in rows:
            found = grams(text)
            held.setdefault(lang, []).append(found)
            size += len(found)
            if size > 1_000_000:
                yield from flushed(held)
                held, size = {}, 0
        yield from flushed(held)

    def flushed(held: dict[str, list[np.ndarray]]) -> Iterator[tuple]:
        for lang, arrays in held.items():
            values, n = np.unique(np.concatenate(arrays), return_counts=True)
            yield from zip([lang] * len(values), values.tolist(), n.tolist())

    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    total = map_rows(usable, counts, COUNT_SCHEMA, 100_000).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= ranks)
        .select("lang", "gram", (F.col("place") - 1).alias("place"))
    )


def profile(learned: DataFrame, ranks: int = RANKS) -> Profile:
    """Languages in name order, all their n-grams sorted, and each n-gram's place per language.

    At most ``ranks`` rows per language reach the driver.
    """
    rows = learned.collect()
    langs = sorted({r["lang"] for r in rows})
    values = np.unique(np.array([r["gram"] for r in rows], dtype=np.int64))
    places = np.full((len(langs), len(values)), -1, dtype=np.int64)
    for r in rows:
        places[langs.index(r["lang"]), np.searchsorted(values, r["gram"])] = r["place"]
    return langs, values, places


def nearest(text: str | None, known: Profile, ranks: int = RANKS) -> tuple[str, float]:
    """The nearest language and 1 minus its distance as a share of the largest possible one.

    Ties go to the language first by name. Without a letter, or without a learned language,
    the answer is ``und`` with score 0.
    """
    langs, values, places = known
    found = grams(text) if text else np.empty(0, dtype=np.int64)
    if not len(found) or not langs:
        return UNKNOWN, 0.0
    mine = ranked(found, ranks)
    at = np.minimum(np.searchsorted(values, mine), len(values) - 1)
    there = np.where(values[at] == mine, places[:, at], -1)
    apart = np.where(there < 0, ranks, np.abs(there - np.arange(len(mine)))).sum(axis=1)
    best = int(np.argmin(apart))
    return langs[best], 1.0 - float(apart[best]) / (ranks * len(mine))


def predict(docs: DataFrame, known: Profile, ranks: int = RANKS) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs``; only the text is looked at.

    A null text, an empty one and one without letters are ``und`` with score 0. Repeated rows
    and null ids are rows like others; other columns are not read.
    """

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, *nearest(text, known, ranks)

    return map_rows(docs.select("doc_id", "text"), rows_of, PREDICTED_SCHEMA)


def held_out(doc_id: Column) -> Column:
    """Documents no language is learned from: crc32 of the id as text leaves 2 when divided by 4.

    A null id is not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the rows not held out, told for all."""
    known = profile(learn(docs.where(~held_out(F.col("doc_id"))), ranks), ranks)
    told = predict(docs, known, ranks)
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """``docs`` without the rows whose language is ``und``, all columns kept.

    A missing ``lang`` is filled with the language told. What is learned comes from the rows not
    held out, as in :func:`identify`.
    """
    known = profile(learn(docs.where(~held_out(F.col("doc_id"))), ranks), ranks)
    told = map_text(docs, "text", lambda text: nearest(text, known, ranks)[0])
    lang = F.coalesce("lang", TOLD)
    return docs.withColumn(TOLD, told).where(F.col(TOLD) != UNKNOWN).withColumn("lang", lang).select(*docs.columns)


# A name no input column has.
TOLD = "language told"

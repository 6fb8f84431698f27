"""Periodic runs of words, found by splitting texts at words that are too rare to be in one.

A run is a stretch of words that repeats itself with smallest period q, at least ``TIMES`` times and at least
``LEAST`` words long, and that no neighbouring word prolongs.

Every word of a run occurs TIMES times or more within it. So a word that occurs less often in a segment is in no
run of the segment, and splits it; in the pieces further words have become rare, and so on until nothing
changes. Ordinary prose falls apart within a few rounds. In what survives, words are compared with those q places on,
for all lags q. A run of lag q is a stretch of (TIMES - 1) * q equal places, so looking at ``POINTS`` places per q
cannot miss it: all lags together take n * log n looks, and only where they hit are neighbours compared.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .tables import map_rows
from .words import word_blocks

TIMES = 4
LEAST = 6
POINTS = 16

Words = np.ndarray
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def segments(ids: Words) -> Iterator[tuple[int, int]]:
    """(start, stop) of the segments in which every word occurs TIMES times or more, and which are LEAST words long.

    All segments of a round are split together; those in which nothing was rare are done.
    """
    at = np.arange(len(ids))
    segment = np.zeros(len(ids), np.int64)
    while len(at):
        # Words as numbers without gaps, so (segment, word) is one number.
        word = ids[at]
        _, which, counts = np.unique(segment * (int(word.max()) + 1) + word, return_inverse=True, return_counts=True)
        often = counts[which] >= TIMES
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        whole = np.logical_and.reduceat(often, starts)
        lengths = np.diff(np.r_[starts, len(at)])
        for start, length in zip(at[starts[whole]], lengths[whole]):
            yield int(start), int(start + length)
        left = often & ~np.repeat(whole, lengths)
        old, at = segment[left], at[left]
        if not len(at):
            return
        segment = np.cumsum(np.r_[False, (np.diff(at) != 1) | (np.diff(old) != 0)])
        long_enough = np.bincount(segment)[segment] >= LEAST
        at, segment = at[long_enough], segment[long_enough]


def equal_from(ids: Words, lag: int, at: int, step: int) -> int:
    """The last place reached from ``at`` in direction ``step`` while words are equal to those ``lag`` places on."""
    width, last = 64, len(ids) - lag
    while True:
        end = min(last, at + width) if step > 0 else max(-1, at - width)
        there = np.arange(at, end, step)
        differs = np.flatnonzero(ids[there] != ids[there + lag])
        if len(differs):
            return at + step * (int(differs[0]) - 1)
        if end in (last, -1):
            return end - step
        at, width = end, width * 2


def lag_scan(ids: Words) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of one segment."""
    found: list[tuple[int, int, int]] = []
    n = len(ids)
    for lag in range(1, n // TIMES + 1):
        least = max(LEAST, TIMES * lag)
        step = max(1, lag // POINTS)
        # Of the ``least - lag`` equal places in a row that a run has, at least so many are looked at.
        needed = (least - lag) // step
        same = ids[: n - lag : step] == ids[lag::step]
        # What repeats with a divisor of the lag is no run of this lag, and is known already.
        for start, length, period in found:
            if length >= 2 * lag and lag % period == 0:
                same[-(-start // step) : -(-(start + length - lag) // step)] = False
        edges = np.flatnonzero(np.diff(np.r_[False, same, False]))
        wide = edges[1::2] - edges[::2] >= needed
        for look, behind in zip(edges[::2][wide].tolist(), edges[1::2][wide].tolist()):
            # Several stretches may lie in one row of hits, where the words between them were not looked at.
            while behind - look >= needed:
                start, last = equal_from(ids, lag, look * step, -1), equal_from(ids, lag, look * step, 1)
                if last - start + 1 + lag >= least:
                    found.append((start, last - start + 1 + lag, lag))
                look = last // step + 1
    return found


def runs(ids: Words) -> list[tuple[int, int, int]]:
    """All runs of a text, given as word numbers, by start and period."""
    every = ((start + a, length, q) for start, stop in segments(ids) for a, length, q in lag_scan(ids[start:stop]))
    return sorted(every, key=lambda run: (run[0], run[2]))


def without_repeats(n: int, found: list[tuple[int, int, int]]) -> Words:
    """Which of ``n`` words stay: those in no run, and the first period of each run unless another run drops it."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def numbered(data: bytes) -> tuple[list[bytes], Words]:
    """The distinct words of a text and, for every word of it, its number among them."""
    known: dict[bytes, int] = {}
    blocks = [np.array([known.setdefault(w, len(known)) for w in block], np.int64) for block in word_blocks(data)]
    return list(known), np.concatenate([np.zeros(0, np.int64), *blocks])


def echoed(doc_id: int | None, ids: Words) -> Words:
    """The words of a test document: every tenth one, by the checksum of its id, repeats itself from some word on."""
    n = len(ids)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([ids[:a], ids[a + np.arange(n - a) % p]])


def find(docs: DataFrame, change: Callable[[int | None, Words], Words] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs``: all runs by start and period, and the text without repetitions.

    ``collapsed`` holds the words that stay, joined by one blank. ``change`` may rewrite a text's word numbers before.
    A null, empty or blank text has no runs and collapses to the empty text; a null id is kept, repeated rows are all
    returned, an empty table gives an empty one. Other columns are not read.
    """

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, data in rows:
            words, ids = numbered(data or b"")
            if change is not None:
                ids = change(doc_id, ids)
            found = runs(ids)
            kept = ids[without_repeats(len(ids), found)]
            text = b" ".join(map(words.__getitem__, kept.tolist()))
            yield doc_id, [{"start": s, "length": n, "period": q} for s, n, q in found], text

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return map_rows(plain, rows_of, RUNS).withColumn("collapsed", F.col("collapsed").cast("string"))


def summary(found: DataFrame) -> DataFrame:
    """One row per document: the number of runs, its longest run, and digests of all runs and of the collapsed text."""
    longest = F.try_element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))), F.lit(1)
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    told = found.withColumn("longest", longest)
    length, period = -F.col("longest.col1"), F.col("longest.period")
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

"""Nearest neighbours by an inverted multi-index.

The vectors' two halves are quantised apart, so ``k`` centroids per half make ``k * k`` cells. For a
query, cells are visited in the order of the summed nearness of their two centroids, by a heap over
the two sorted lists, until they hold the wanted share of all entries; those are reranked by the
exact inner product in double precision.

The centroids are learned from at most ``SAMPLE`` vectors; every vector is indexed. The wanted share
is measured, not guessed: for at most ``PROBES`` queries the true neighbours among all vectors are
found by brute force, and the share is the one that reaches ``RECALL`` of them. What those bounds
limit is the fit, not the vectors searched.

Copies of a vector beyond the ``top + 1`` smallest ids can be in no answer, so the index leaves them
out; equal queries are answered once. Entries lie in blocks of at most ``BLOCK`` rows, cells larger
than that in several, so a vector that a third of the table shares is no large group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .tables import map_rows, written

TOP = 20
SAMPLE = 20_000
PROBES = 64
# The measured share leaves some room above the recall that is asked for.
RECALL = 0.97
BLOCK = 8_192
QUERIES = 1_024
LARGEST_K = 256
PASSES = 12

CELL_SCHEMA = "vec_id long, v array<double>, cell int"
VISIT_SCHEMA = "d1 long, d2 long, v array<double>, first int, block long, cells array<int>"
FOUND_SCHEMA = "d1 long, d2 long, vec_id long, score double"
RESULT_SCHEMA = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, d1, d2): vectors that take part, each id and vector once.

    Left out are null ids, null and zero vectors, those with a null or non-finite component, and
    those of another length than most (of the longer one, if two lengths are equally frequent).
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (common["n"] if common else 0))
    return rows.select("vec_id", "v", F.xxhash64("v").alias("d1"), F.xxhash64("v", F.lit(1)).alias("d2")).dropDuplicates(
        ["vec_id", "d1", "d2"]
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def kmeans(points: np.ndarray, k: int, passes: int = PASSES) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced starting points of a fixed shuffle; empty centroids stay."""
    rng = np.random.default_rng(0)
    centroids = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(passes):
        owner = closest(points, centroids)
        counts = np.bincount(owner, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, points)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centroids


def closest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(axis=1) - 2 * points @ centroids.T, axis=1)


class Codebook:
    """The centroids of both halves."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        k = min(k, len(sample))
        self.left = kmeans(sample[:, : self.half], k)
        self.right = kmeans(sample[:, self.half :], k)

    def cells(self, points: np.ndarray) -> np.ndarray:
        left = closest(points[:, : self.half], self.left)
        return left * len(self.right) + closest(points[:, self.half :], self.right)

    def trail(self, query: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
        """Non-empty cells, nearest first, until they hold ``wanted`` entries."""
        near_left = self.left @ query[: self.half]
        near_right = self.right @ query[self.half :]
        a, b = np.argsort(-near_left, kind="stable"), np.argsort(-near_right, kind="stable")
        la, lb = near_left[a].tolist(), near_right[b].tolist()
        a, b = a.tolist(), b.tolist()
        heap = [(-(la[0] + lb[0]), 0, 0)]
        out, held, width = [], 0, len(b)
        # A pair enters the heap after its left and upper neighbours: reach[i] pairs of row i are out.
        reach = [0] * len(a)
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            reach[i] = j + 1
            cell = a[i] * width + b[j]
            if sizes[cell]:
                out.append(cell)
                held += int(sizes[cell])
            if i + 1 < len(a) and reach[i + 1] == j:
                heapq.heappush(heap, (-(la[i + 1] + lb[j]), i + 1, j))
            if j + 1 < width and (i == 0 or reach[i - 1] > j + 1):
                heapq.heappush(heap, (-(la[i] + lb[j + 1]), i, j + 1))
        return out


def top_exact(queries: np.ndarray, entries: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None, top: int):
    """Per query the places of its nearest entries and their scores; ties by id."""
    rough = queries @ entries.T
    if allowed is not None:
        rough[~allowed] = -np.inf
    n = rough.shape[1]
    edge = np.partition(rough, n - top, axis=1)[:, n - top] if n > top else np.full(len(queries), -np.inf)
    for row, (line, least) in enumerate(zip(rough, edge)):
        slack = 1e-9 * max(1.0, abs(least)) if np.isfinite(least) else 0.0
        at = np.flatnonzero((line >= least - slack) & (line > -np.inf))
        # One fixed order of addition, so equal vectors have equal scores.
        score = (entries[at] * queries[row]).sum(axis=1)
        best = np.lexsort((ids[at], -score))[:top]
        yield row, at[best], score[best]


def brute_force(entries: DataFrame, queries: list[tuple[int, np.ndarray]], top: int) -> DataFrame:
    """(query, vec_id, score, cell): the true neighbours of a few queries among all entries."""
    matrix_of = np.array([q for _, q in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, cells = batch.column("vec_id").to_numpy(), batch.column("cell").to_numpy()
            for row, at, score in top_exact(matrix_of, matrix(batch.column("v")), ids, None, top):
                yield pa.record_batch(
                    {"query": pa.array(np.full(len(at), row, dtype=np.int32)), "vec_id": pa.array(ids[at]),
                     "score": pa.array(score), "cell": pa.array(cells[at].astype(np.int32))}
                )

    found = entries.mapInArrow(run, "query int, vec_id long, score double, cell int")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).drop("place")


def measured_share(entries: DataFrame, queries: DataFrame, book: Codebook, sizes: np.ndarray, top: int) -> float:
    """The share of entries to visit so that ``RECALL`` of the true neighbours are among them."""
    sample = queries.orderBy(F.xxhash64("d1", "d2"), "d1").limit(PROBES).collect()
    probes = [(n, np.array(r["v"], dtype=np.float64)) for n, r in enumerate(sample)]
    if not probes:
        return 1.0
    true = brute_force(entries, probes, top + 1).collect()
    total = int(sizes.sum())
    needed = []
    for n, query in probes:
        order = book.trail(query, sizes, total)
        upto = dict(zip(order, np.cumsum(sizes[order]).tolist()))
        own = float((query * query).sum())
        needed += [upto[r["cell"]] / total for r in true if r["query"] == n and abs(r["score"] - own) > 1e-9]
    return float(np.quantile(needed, RECALL)) if needed else 1.0


def blocks_of(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every cell; neighbouring small cells share one.

    A block gets at most ``most`` rows, or about that if it is part of a larger cell.
    """
    first, count = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    block, held = 0, 0
    for cell, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            block, held = block + 1, 0
        first[cell] = block
        if size > most:
            count[cell] = -(-size // most)
            block, held = block + int(count[cell]), 0
        else:
            held += size
    return first, count


def cell_table(spark: SparkSession, sizes: np.ndarray, most: int, key: str, name: str) -> DataFrame:
    """The blocks of each non-empty cell as a table: at most one row per cell."""
    first, count = blocks_of(sizes, most)
    rows = [(c, int(first[c]), int(count[c])) for c in np.flatnonzero(sizes).tolist()]
    return spark.createDataFrame(rows, f"{key} int, {name}_first long, {name}_count long")


def part(name: str, spread: str) -> Column:
    """The block of a row among those of its cell."""
    return F.col(f"{name}_first") + F.pmod(F.xxhash64(spread), F.col(f"{name}_count"))


def search(vectors: DataFrame, is_query: Column, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found of every query row.

    ``vectors`` has vec_id and embedding, other columns are only seen by ``is_query``. A query is no
    candidate of its own. Nearest first, ties to the smaller vec_id. What takes no part is told at
    :func:`usable`; a query that takes no part has no rows, and an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    marked = vectors.where(is_query).select("vec_id").distinct().withColumn("asks", F.lit(True))
    base = written(usable(vectors).join(marked, "vec_id", "left"), "vectors")
    order = Window.partitionBy("d1", "d2").orderBy("vec_id")
    kept = base.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= top + 1).select("vec_id", "v")
    kept = written(kept, "kept_vectors")
    sample = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    if not sample:
        return spark.createDataFrame([], RESULT_SCHEMA)
    total = kept.count()
    k = int(min(LARGEST_K, max(2, 2 * total**0.25)))
    book = Codebook(np.array([r["v"] for r in sample], dtype=np.float64), k)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = book.cells(matrix(batch.column("v"))).astype(np.int32)
                yield pa.record_batch({"vec_id": batch.column("vec_id"), "v": batch.column("v"), "cell": pa.array(cells)})

    entries = written(kept.mapInArrow(assign, CELL_SCHEMA), "entries")
    sizes = np.zeros(len(book.left) * len(book.right), dtype=np.int64)
    for r in entries.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    asked = base.where("asks").select("vec_id", "d1", "d2")
    queries = base.where("asks").dropDuplicates(["d1", "d2"]).select("d1", "d2", "v")
    share = measured_share(entries, queries, book, sizes, top)
    wanted = max(int(np.ceil(total * share)), min(total, 50 * top))
    first_block, n_blocks = blocks_of(sizes, BLOCK)

    def visits_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for d1, d2, v in rows:
            trail = book.trail(np.array(v, dtype=np.float64), sizes, wanted)
            by_block: dict[int, list[int]] = {}
            for cell in trail:
                for block in range(first_block[cell], first_block[cell] + n_blocks[cell]):
                    by_block.setdefault(block, []).append(cell)
            for block, cells in by_block.items():
                yield d1, d2, v, trail[0], block, cells

    visits = written(map_rows(queries, visits_of, VISIT_SCHEMA, 2_000), "visits")
    # Queries that begin in the same cell travel together, at most about QUERIES of them.
    begins = np.zeros(len(sizes), dtype=np.int64)
    for r in visits.select("d1", "d2", "first").distinct().groupBy("first").count().collect():
        begins[r["first"]] = r["count"]
    parties = cell_table(spark, begins, QUERIES, "first", "party")
    places = cell_table(spark, sizes, BLOCK, "cell", "block")
    in_parties = visits.join(parties, "first").select(
        "block", part("party", "d1").alias("party"), "d1", "d2", "v", "cells"
    )
    in_blocks = entries.join(places, "cell").select("vec_id", "v", "cell", part("block", "vec_id").alias("block"))
    in_parties = written(in_parties, "parties")
    # Under new names: the table meets itself in the cogroup.
    meetings = in_parties.select("block", "party").distinct().toDF("block_met", "party_met")
    entries_met = in_blocks.join(meetings, F.col("block") == F.col("block_met")).drop("block")
    found = (
        in_parties.groupBy("block", "party")
        .cogroup(entries_met.groupBy("block_met", "party_met"))
        .applyInArrow(lambda here, there: rerank(here, there, top), FOUND_SCHEMA)
    )
    best = Window.partitionBy("d1", "d2").orderBy(F.desc("score"), "vec_id")
    lists = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top + 1)
    told = asked.withColumnRenamed("vec_id", "query_id").join(lists, ["d1", "d2"]).where("query_id <> vec_id")
    told = told.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        told.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def rerank(asked: pa.Table, entries: pa.Table, top: int) -> pa.Table:
    """Exact scores of one block's entries for the queries that visit it."""
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not asked.num_rows or not entries.num_rows:
        return schema.empty_table()
    asked, entries = asked.combine_chunks(), entries.combine_chunks()
    points, ids = matrix(entries["v"].chunk(0)), entries["vec_id"].to_numpy()
    local, place = np.unique(entries["cell"].to_numpy(), return_inverse=True)
    visited = np.zeros((asked.num_rows, len(local)), dtype=bool)
    for row, cells in enumerate(asked["cells"].to_pylist()):
        visited[row] = np.isin(local, cells)
    d1, d2 = asked["d1"].to_numpy(), asked["d2"].to_numpy()
    queries = matrix(asked["v"].chunk(0))
    out = []
    for begin in range(0, len(queries), 256):
        part = slice(begin, begin + 256)
        for row, at, score in top_exact(queries[part], points, ids, visited[part][:, place], top + 1):
            n = begin + row
            out.append((np.full(len(at), d1[n]), np.full(len(at), d2[n]), ids[at], score))
    return pa.table([np.concatenate(c) for c in zip(*out)], schema=schema)

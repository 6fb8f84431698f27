import numpy as np
import pytest
from pyspark.sql import functions as F

from paytide.llm import multi_index
from paytide.llm.queries import REGISTRY
from paytide.llm.tables import table


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cell int, block long")


def brute(rows, asked, top):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for q in asked:
        score = (points * points[ids == q][0]).sum(axis=1)
        order = [n for n in np.lexsort((ids, -score)) if ids[n] != q][:top]
        out[q] = [(int(ids[n]), score[n]) for n in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    want = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = found(REGISTRY["op3_inverted_multi_index"](spark, sf))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, near in brute(rows, list(want)[:5], len(rows)).items() for i, s in near}
    assert all(exact[q, i] == s for q in list(want)[:5] for i, s in got[q])


@pytest.mark.parametrize("block, queries", [(2_048, 1_024), (7, 2)])
def test_copies_ties_and_scales(spark, monkeypatch, block, queries):
    """A third of the rows are one vector; norms differ, so the nearest need not be the query itself."""
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "QUERIES", queries)
    rng = np.random.default_rng(1)
    rows = [(i, [0.5, 0.25, -0.5, 1.0]) for i in range(0, 60, 1)]
    rows += [(i, (rng.integers(-4, 5, 4) / 4).tolist()) for i in range(60, 180)]
    rows = [(i, v) for i, v in rows if any(v)]
    want = brute(rows, [i for i, _ in rows if i % 5 == 0], 6)
    got = found(multi_index.search(vectors(spark, rows), F.col("vec_id") % 5 == 0, top=6))
    # So small a table is searched whole.
    assert got == want


def test_fewer_candidates_than_asked_for_and_unusable_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])]
    odd = [(3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 1.0])]
    got = found(multi_index.search(vectors(spark, rows + odd), F.lit(True)))
    assert got == {0: [(2, 1.0), (1, 0.0)], 1: [(0, 0.0), (2, 0.0)], 2: [(0, 1.0), (1, 0.0)]}
    assert multi_index.search(vectors(spark, []), F.lit(True)).count() == 0
    assert multi_index.search(vectors(spark, odd[:5]), F.lit(True)).count() == 0


def test_cells_come_in_the_order_of_summed_nearness():
    rng = np.random.default_rng(4)
    book = multi_index.Codebook(rng.normal(size=(200, 6)), 9)
    sizes = rng.integers(0, 4, 81)
    for _ in range(20):
        q = rng.normal(size=6)
        near = ((book.left @ q[:3])[:, None] + (book.right @ q[3:])[None, :]).ravel()
        want = [c for c in np.argsort(-near, kind="stable").tolist() if sizes[c]]
        got = book.trail(q, sizes, int(sizes.sum()))
        assert np.allclose(near[got], near[want]) and sorted(got) == sorted(want)
        some = book.trail(q, sizes, 20)
        assert got[: len(some)] == some and sizes[some].sum() >= 20 > sizes[some[:-1]].sum()

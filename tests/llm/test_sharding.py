import random
import zlib
from collections import Counter

import pytest
from samples import documents, odd_documents, prose

from paytide.llm import sharding
from paytide.llm.queries import REGISTRY
from paytide.llm.tables import table


def laws_hold(rows, shards=8):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    assert max(counts.values()) - (min(counts.values()) if len(counts) == shards else 0) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def spread(rows, text):
    """Group -> number of shards it is in, of groups of two or more."""
    groups = {}
    for r in rows:
        groups.setdefault(text[r["doc_id"]], []).append(r["shard"])
    return {t: len(set(s)) for t, s in groups.items() if len(s) > 1}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    text = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    rows = REGISTRY["op10_shard_documents"](spark, sf).collect()
    assert len(rows) == len(text)
    laws_hold(rows)
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in rows)
    assert set(spread(rows, text).values()) == {1}


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_a_group_larger_than_a_shard(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    rnd = random.Random(1)
    texts = ["hot"] * 400 + [f"pair {i // 2}" for i in range(300)] + [f"five {i // 5}" for i in range(200)] + [f"one {i}" for i in range(301)]
    rnd.shuffle(texts)
    text = dict(enumerate(texts))
    out = sharding.shard(documents(spark, list(text.items())))
    rows = out.collect()
    laws_hold(rows)
    groups = spread(rows, text)
    # The large group fills whole shards but for what the quota leaves free.
    assert Counter(r["shard"] for r in rows if text[r["doc_id"]] == "hot").most_common(1)[0][1] >= 100
    assert groups["hot"] <= 6
    assert sum(n > 1 for t, n in groups.items() if t != "hot") <= 0.03 * len(groups)
    assert sorted(map(repr, sharding.shard(documents(spark, list(text.items()))).collect())) == sorted(map(repr, rows))


def test_only_groups_and_only_single_documents(spark):
    for texts in ([f"t{i % 20}" for i in range(200)], [str(i) for i in range(203)], ["same"] * 50):
        text = dict(enumerate(texts))
        rows = sharding.shard(documents(spark, list(text.items()))).collect()
        laws_hold(rows)


@pytest.mark.parametrize("texts, cut", [
    # Eight shards of 25 hold 16 groups of ten whole; the division by hash may cut one more a shard.
    ([f"t{i % 20}" for i in range(200)], 12),
    ([f"pair {i // 2}" for i in range(4000)], 16),
    (["hot"] * 1500 + [f"pair {i // 2}" for i in range(2500)], 17),
])
def test_groups_stay_whole_where_every_document_is_in_one(spark, texts, cut):
    text = dict(enumerate(texts))
    rows = sharding.shard(documents(spark, list(text.items()))).collect()
    laws_hold(rows)
    groups = spread(rows, text)
    assert sum(n > 1 for n in groups.values()) <= cut
    assert max(groups.values()) <= 5


def test_packed():
    free = [25] * 8
    parts = sharding.packed([10] * 20, free)
    assert sum(len(p) == 1 for p in parts) == 16 and free == [0] * 8
    assert sharding.packed([400, 30], [150, 150, 150]) == [[(0, 150), (1, 150), (2, 100)], [(2, 30)]]


def test_odd_rows(spark):
    rows = sharding.shard(odd_documents(spark)).collect()
    assert len(rows) == 12
    laws_hold(rows)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert sharding.shard(documents(spark, [])).count() == 0
    laws_hold(sharding.shard(documents(spark, [(1, prose(1, 9))])).collect())


def test_settle():
    rnd = random.Random(2)
    for _ in range(200):
        counts = [rnd.choice([0, rnd.randint(0, 50)]) for _ in range(rnd.randint(1, 9))]
        keep, first, takes = sharding.settle(counts)
        given = sum(n - k for n, k in zip(counts, keep))
        assert [t[0] for t in takes] + [given] == [0] + [t[1] for t in takes] or (given == 0 and not takes)
        final = list(keep)
        for a, b, s, slot in takes:
            assert slot == keep[s]
            final[s] += b - a
        assert max(final) - min(final) <= 1


def test_no_python_in_the_plan(spark):
    plan = sharding.shard(odd_documents(spark))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))

import random

import numpy as np
import pytest
from samples import documents, odd_documents, prose

from paytide.llm import components, jaccard
from paytide.llm.queries import REGISTRY
from paytide.llm.tables import table


def plain_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)) if w else frozenset()


def brute(rows, k, share):
    """doc_id -> (set size, smallest id reachable by links), by comparing all pairs."""
    sets = {i: plain_set(t, k) for i, t in rows}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= share * len(x | y):
                i, j = root(a), root(b)
                group[max(i, j)] = min(i, j)
    return {i: (len(sets[i]), root(i)) for i in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(text, rnd, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


def families(seed):
    """Groups of copies with more and fewer edits, around the threshold, and shared passages."""
    rnd = random.Random(seed)
    out, passage = [], prose(99, 60)
    for n in range(12):
        base = prose(seed * 100 + n, rnd.randint(5, 160))
        if n % 3 == 0:
            base += " " + passage
        out += [base] * rnd.randint(1, 3) + [edited(base, rnd, rnd.randint(0, 8)) for _ in range(rnd.randint(0, 9))]
    out += [passage] * 2 + [edited(passage, rnd, 1) for _ in range(12)]
    rnd.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("weight, seed, k, share", [(300_000, 1, 4, 85), (300, 2, 5, 80), (150, 3, 4, 85), (300_000, 5, 4, 85), (200, 6, 5, 80)])
def test_groups_by_brute_force(spark, monkeypatch, weight, seed, k, share):
    """Small weights divide every block into many nodes."""
    monkeypatch.setattr(jaccard, "WEIGHT", weight)
    monkeypatch.setattr(jaccard, "SEEN_TOGETHER", 2)
    rows = families(seed)
    assert found(jaccard.join(documents(spark, rows), k, share)) == brute(rows, k, share)


def test_the_order_of_shingles_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SEEN_TOGETHER", 10**6)
    rows = families(4)
    assert found(jaccard.join(documents(spark, rows, extra=False), 4, 85)) == brute(rows, 4, 85)


def test_texts_are_shuffled_when_there_are_many_ids(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SENT_IDS", 1)
    rows = families(5)
    assert found(jaccard.join(documents(spark, rows), 4, 85)) == brute(rows, 4, 85)


def test_only_texts_that_may_be_linked_are_sent(spark, monkeypatch):
    """Classes that share a block, but little more, are told apart by the bitmaps of their prefixes."""
    sent = []

    def noted(members, keys, payload, *compare):
        if payload.schema["payload"].dataType.simpleString() == "string":
            sent.append(members.select("class_id").distinct().count())
        return traversed(members, keys, payload, *compare)

    traversed = jaccard.traversed
    monkeypatch.setattr(jaccard, "traversed", noted)
    # One passage in all texts; without a list of frequent shingles some of it is among the first of many texts.
    monkeypatch.setattr(jaccard, "SEEN_TOGETHER", 10**6)
    passage = prose(7, 30)
    rows = [(n, prose(1000 + n, 250) + " " + passage) for n in range(40)] + [(40, prose(1003, 250) + " once " + passage)]
    assert found(jaccard.join(documents(spark, rows), 4, 85)) == brute(rows, 4, 85)
    assert sent[0] == 2 and sum(sent) <= 4


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    assert found(REGISTRY["op4_signature_tree_join"](spark, sf)) == brute(rows, 4, 85)


def test_traversal_finds_all_groups():
    rnd = random.Random(5)
    for n in range(60):
        rows = families(n + 10)[: rnd.randint(2, 60)]
        ids, groups = jaccard.compare_texts([(i, i, len(jaccard.shingles(t, 4)), t) for i, t in rows], 4, 85)
        want = brute(rows, 4, 85)
        mine = [groups.root(place) for place in range(len(ids))]
        theirs = [want[i][1] for i in ids]
        assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_bitmaps_never_prune_a_link():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        whole = np.unique(rnd.integers(-(2**63), 2**63 - 1, 400))
        sets = [np.sort(rnd.choice(whole, rnd.integers(1, 300), replace=False)) for _ in range(2)]
        sizes = np.array(list(map(len, sets)))
        if jaccard.linked(*sets, *sizes.tolist(), 50):
            assert jaccard.Tree(np.stack([jaccard.bitmap(s, 1024) for s in sets]), sizes, sizes).may_link(0, 0, 1, 50)
            # The parts the blocks are made of, in one order, with bitmaps of different widths.
            parts = [s[: len(s) - jaccard.needed(len(s), 50) + 1] for s in sets]
            raw = [jaccard.bitmap(p, jaccard.width(len(p))).tobytes() for p in parts]
            assert jaccard.linked(*parts, *sizes.tolist(), 50)
            ids, groups = jaccard.compare_prefixes([(i, i, len(s), r) for i, (s, r) in enumerate(zip(sets, raw))], 50)
            assert groups.root(0) == groups.root(1)


def test_folding_is_a_bitmap_of_the_smaller_width():
    rnd = np.random.default_rng(6)
    found = rnd.integers(-(2**63), 2**63 - 1, 200)
    wide = jaccard.bitmap(found, 2048).tobytes()
    for bits in (256, 512, 2048):
        assert (jaccard.folded(wide, bits) == jaccard.bitmap(found, bits)).all()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = jaccard.join(docs, 5, 80).collect()
    told = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=repr)
    assert len(told) == 12
    by_id = {r["doc_id"]: r["component_id"] for r in out}
    assert by_id == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7, 9: 9}
    assert {r["n_shingles"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert jaccard.join(docs.limit(0)).count() == 0
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "5", "7", "9", "None", "None"]


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    random.Random(1).shuffle(chain)
    out = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_bits_of_a_prefix_are_spread(spark):
    """The least hashes of a set begin alike; their bitmap still tells prefixes apart, and a prefix is stored once."""
    rows = [(n, " ".join(f"x{n}y{i}" for i in range(300))) for n in range(2)]
    short = jaccard.prefixes(documents(spark, rows), 4, 85, np.empty(0, dtype=np.int64))
    assert short.columns == ["doc_id", "n", "shingles", "bits"]
    kept = [(r["doc_id"], r["doc_id"], r["n"], r["bits"]) for r in short.orderBy("doc_id").collect()]
    assert np.bitwise_count(np.frombuffer(kept[0][3], dtype=np.uint64)).sum() > 35
    ids, groups = jaccard.compare_prefixes(kept, 85)
    assert groups.root(0) != groups.root(1)
    part = short.first()["shingles"]
    assert list(jaccard.packed(iter([(1, 2, part[::-1])]))) == [(1, 2, np.array(sorted(part)).tobytes())]


def test_prefixes_are_compared_by_half_of_each_hash(spark, monkeypatch):
    """Of prefixes four bytes a shingle are sent; links around the threshold are all found."""
    sent = []

    def noted(members, keys, payload, *compare):
        sent.append(payload.schema["payload"].dataType.simpleString())
        return traversed(members, keys, payload, *compare)

    traversed = jaccard.traversed
    monkeypatch.setattr(jaccard, "traversed", noted)
    rows = families(8)
    assert found(jaccard.join(documents(spark, rows), 4, 85)) == brute(rows, 4, 85)
    assert "array<int>" in sent and "array<bigint>" not in sent


def test_shortened_prefixes_never_lose_a_link():
    """Also when different shingles become equal, in one set or in both."""
    rnd = np.random.default_rng(9)
    met = 0
    for _ in range(300):
        whole = np.unique(rnd.integers(-(2**63), 2**63 - 1, 400))
        sets = [np.sort(rnd.choice(whole, rnd.integers(200, 390), replace=False)) for _ in range(2)]
        if jaccard.linked(*sets, *map(len, sets), 50):
            met += 1
            parts = [s[: len(s) - jaccard.needed(len(s), 50) + 1] for s in sets]
            # Seven bits of a hash: most of a large prefix's shingles are taken for others.
            short = [(i, i, len(s), (p & 127).tolist()) for i, (s, p) in enumerate(zip(sets, parts))]
            ids, groups = jaccard.compare_parts(list(jaccard.packed(iter(short))), 50)
            assert groups.root(0) == groups.root(1)
    assert met > 20

import random

import pytest
import xxhash
from samples import documents, odd_documents, prose, rows

from paytide.llm import simhash
from paytide.llm.words import word_blocks


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_classes(fingerprints, radius=2):
    """The smallest name of everything links lead to, for (name, fingerprint) pairs."""
    root = {name: name for name, _ in fingerprints}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(fingerprints):
        for b, y in fingerprints[:i]:
            if (x ^ y).bit_count() <= radius:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {name: top(name) for name, _ in fingerprints}


def connected(spark, values, small):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), small))
    to = {r["node"]: r["component"] for r in found.collect()}
    groups = {}
    for v, s in zip(values, signed):
        groups.setdefault(to.get(s, s), set()).add(v)
    return {frozenset(g) for g in groups.values()}


def test_every_pair_within_the_radius_shares_a_bucket():
    family = simhash.masks()
    assert len(family) == 7 and {m.bit_count() for m in family} <= {36, 37}
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in family)
    assert len(simhash.masks(32, 3)) == 15


def test_spark_knows_the_same_hash(spark):
    assert spark.sql("SELECT xxhash64('a b c') AS h").first().h % (1 << 64) == xxhash.xxh64_intdigest("a b c", 42)


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "É é É x", prose(1, 50), prose(2, 4), "x " * 9000, " a b c d"])
def test_fingerprint_of_whole_texts(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == brute_fingerprint(text)


def test_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = prose(3, 3000).encode()
    whole = simhash.fingerprint(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "word_blocks", lambda data, size=size: word_blocks(data, size))
        assert simhash.fingerprint(text) == whole
        monkeypatch.undo()


@pytest.mark.parametrize("small", [1, 3, 32])
def test_links_connect_what_brute_force_connects(spark, small):
    rnd = random.Random(small)
    values = set()
    for _ in range(12):
        value = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 25)):
            values.add(value)
            for bit in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                value ^= 1 << bit
    values = sorted(values)
    classes = brute_classes([(v, v) for v in values])
    want = {}
    for v, c in classes.items():
        want.setdefault(c, set()).add(v)
    assert connected(spark, values, small) == {frozenset(g) for g in want.values()}


def test_a_crowded_bucket(spark):
    # All differ within the bits one mask leaves out; links of two bits, of one, and none.
    free = [i for i in range(64) if not simhash.masks()[2] >> i & 1]
    rnd = random.Random(4)
    values = sorted({sum(1 << i for i in rnd.sample(free, rnd.randrange(0, 9))) for _ in range(300)})
    classes = {}
    for v, c in brute_classes([(v, v) for v in values]).items():
        classes.setdefault(c, set()).add(v)
    assert connected(spark, values, 8) == {frozenset(g) for g in classes.values()}


def test_documents_against_brute_force(spark):
    texts = [prose(n, 400) for n in range(20)]
    for n in range(60):
        words = texts[n % 20].split()
        words[n * 7 % 400] = f"changed{n}"
        texts.append(" ".join(words))
    docs = [(i * 3, t) for i, t in enumerate(texts)] + [(500, texts[3].upper()), (501, ""), (502, None), (503, "a b")]
    have = {r["doc_id"]: r for r in simhash.near_duplicates(documents(spark, docs)).collect()}
    prints = [(i, brute_fingerprint(t)) for i, t in docs]
    classes = brute_classes(prints)
    assert {i: r["component_id"] for i, r in have.items()} == classes
    assert {i: r["fingerprint"] for i, r in have.items()} == {i: f"{p:016x}" for i, p in prints}
    assert classes[500] == 9 and classes[502] == 501 and len(set(classes.values())) < 60


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = simhash.near_duplicates(docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 12
    have = rows(out, "doc_id", "component_id")
    # The text-less row without an id is linked with the empty texts; the other one is alone and nameless.
    assert have.count((None, 1)) == 1 and have.count((None, None)) == 1
    assert have.count((5, 5)) == 2 and (6, 5) in have and (8, 7) in have and (2, 1) in have and (3, 1) in have
    assert simhash.near_duplicates(docs.limit(0)).count() == 0

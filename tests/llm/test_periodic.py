import hashlib
import random
import zlib

import numpy as np
from samples import documents, odd_documents, prose, rows

from paytide.llm import periodic


def brute_runs(words):
    """Every lag over the whole text, and every smaller period tried."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                run = words[i : i + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, echo=False):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if echo and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = None if q is None else 1000 * length // q
    return doc_id, len(found), s, length, q, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def noisy(rnd, n, vocabulary, longest):
    words = [rnd.randrange(vocabulary) for _ in range(n)]
    for _ in range(rnd.randrange(4)):
        block = [rnd.randrange(vocabulary) for _ in range(rnd.randrange(1, longest))]
        at = rnd.randrange(len(words) + 1)
        words[at:at] = (block * 9)[: rnd.randrange(1, 6 * len(block) + 2)]
    return words


def test_runs_against_brute_force():
    rnd = random.Random(5)
    for _ in range(1500):
        words = noisy(rnd, rnd.randrange(90), rnd.choice([1, 2, 3, 5, 20]), 12)
        assert periodic.runs(np.array(words, np.int64)) == brute_runs(words)


def test_long_lags_against_brute_force():
    rnd = random.Random(6)
    for _ in range(25):
        words = noisy(rnd, 300, rnd.choice([2, 3, 50]), 120)
        assert periodic.runs(np.array(words, np.int64)) == brute_runs(words)


def test_two_runs_of_a_long_lag_side_by_side():
    # The word between the two stretches is one that the scan does not look at.
    block = list(range(100, 180))
    words = block * 5 + [1] + block[1:] + block * 4
    assert periodic.runs(np.array(words, np.int64)) == brute_runs(words) and len(brute_runs(words)) == 2


def test_segments_are_stable_and_hold_every_run():
    rnd = random.Random(8)
    for _ in range(300):
        words = noisy(rnd, rnd.randrange(200), 8, 6)
        ids = np.array(words, np.int64)
        pieces = list(periodic.segments(ids))
        for a, b in pieces:
            assert b - a >= 6 and min(words[a:b].count(w) for w in words[a:b]) >= 4
        for start, length, _ in brute_runs(words):
            assert any(a <= start and start + length <= b for a, b in pieces)


def test_ordinary_prose_falls_apart():
    ids = np.array([int(w[1:]) for w in prose(1, 20_000, 30_000).split()], np.int64)
    assert sum(b - a for a, b in periodic.segments(ids)) == 0


def test_what_a_run_keeps():
    ids = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 1, 8], np.int64)
    assert periodic.runs(ids) == [(1, 9, 2)]
    assert ids[periodic.without_repeats(11, [(1, 9, 2)])].tolist() == [9, 1, 2, 8]


def test_documents_against_brute_force(spark):
    rnd = random.Random(9)
    texts = [(n, " ".join(f"W{w}" for w in noisy(rnd, 150, rnd.choice([3, 30, 400]), 9))) for n in range(300)]
    docs = documents(spark, texts)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for echo in (False, True):
        have = periodic.summary(periodic.find(docs, periodic.echoed if echo else None))
        assert have.columns == columns
        assert rows(have, *columns) == sorted((brute_row(*t, echo) for t in texts), key=repr)
    assert sum(brute_row(*t, True) != brute_row(*t) for t in texts) > 15


def test_collapsed_text(spark):
    docs = documents(spark, [(1, "so é  é é\té é é so"), (2, "a b a b a b"), (3, "a a a a a")])
    out = {r["doc_id"]: (r["collapsed"], [tuple(x) for x in r["runs"]]) for r in periodic.find(docs).collect()}
    assert out == {1: ("so é so", [(1, 6, 1)]), 2: ("a b a b a b", []), 3: ("a a a a a", [])}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = periodic.summary(periodic.find(docs, periodic.echoed))
    assert out.count() == 12 and periodic.summary(periodic.find(docs.limit(0))).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    have = {r["doc_id"]: r for r in out.collect()}
    for empty in (1, 2, 3):
        assert (have[empty].n_runs, have[empty].start, have[empty].runs_sha256, have[empty].collapsed_sha256) == (0, None, nothing, nothing)


def test_a_very_long_text_of_one_word():
    ids = np.zeros(300_000, np.int64)
    assert periodic.runs(ids) == [(0, 300_000, 1)]
    assert periodic.without_repeats(300_000, [(0, 300_000, 1)]).sum() == 1

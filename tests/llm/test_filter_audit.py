import itertools
import random

from samples import CLASHING, prose

from paytide.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute_steps(docs):
    """Rows of one part from (fails, good, toxic) of its documents, one order after the other."""
    out = []
    for order in map("".join, itertools.permutations("ABCDE")):
        left = list(docs)
        for step, f in enumerate(order, 1):
            gone = [d for d in left if f in d[0]]
            left = [d for d in left if f not in d[0]]
            redundant = sum(f in d[0] for d in docs) - len(gone)
            out.append((order, step, len(left), len(gone), redundant, sum(d[0] == f for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)))
    shapley = {f: sum(r[3] for r in out if r[0][r[1] - 1] == f) for f in "ABCDE"}
    return [(*r, shapley[r[0][r[1] - 1]]) for r in out]


def brute_fails(rows):
    """(part, fails) per (doc_id, text, source) row."""
    out = []
    for doc_id, text, source in rows:
        t = text or ""
        words = t.encode().split()
        same = [d for d, other, _ in rows if (other or "") == t and d is not None]
        fails = [
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            any(c in "#$%&*|" for c in t), doc_id is not None and any(d < doc_id for d in same),
        ]
        out.append((source or "", "".join(f for f, bad in zip("ABCDE", fails) if bad)))
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, *(1, "x", 2, "y", 3, 4, 5, 6, 7, 8)) for r in rows], f"doc_id long, text string, source string, {CLASHING}")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, n int")
    have = fa.audit(docs, told)
    assert have.columns == COLUMNS
    return sorted(tuple(r) for r in have.collect())


def expected(rows, labels):
    good, toxic = {d for d, q, _, _ in labels if q == 1}, {d for d, _, t, _ in labels if t == 1}
    parts = {}
    for (doc_id, _, _), (part, fails) in zip(rows, brute_fails(rows)):
        parts.setdefault(part, []).append((fails, doc_id is not None and doc_id in good, doc_id is not None and doc_id in toxic))
    return sorted((part, *r) for part, docs in parts.items() for r in brute_steps(docs))


def test_plain_changes_visit_every_order_once():
    for n in range(1, 6):
        order, seen = list(range(n)), [tuple(range(n))]
        for i in fa.plain_changes(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.append(tuple(order))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_a_swapped_diagram_is_the_diagram_built_in_that_order():
    rnd = random.Random(1)
    for density in (0.1, 0.5, 1.0):
        counts = {m: (rnd.randrange(1, 9), rnd.randrange(3), rnd.randrange(3)) for m in range(32) if rnd.random() < density}
        diagram = fa.Diagram()
        for order, root in fa.orders(diagram, diagram.build("ABCDE", counts)):
            # Equal diagrams are the same node, so nothing is left over from the order before.
            assert root == diagram.build(order, counts)


def test_a_level_without_failures_has_no_node():
    diagram = fa.Diagram()
    root = diagram.build("ABCDE", {0: (5, 1, 0), 4: (2, 0, 1)})
    assert diagram.asks[root] == "C" and diagram.weight[root] == (7, 1, 1) and len(diagram.weight) == 4
    assert diagram.build("ABCDE", {}) == fa.NOTHING


def test_random_documents_against_brute_force(spark):
    rnd = random.Random(7)
    texts = ["", "a b", prose(1, 60, 10**6), prose(2, 60, 10), prose(1, 60, 10**6).upper(), prose(3, 70, 10**6) + " #", "É" * 99, "ABC"]
    rows = [(rnd.randrange(60), rnd.choice(texts), rnd.choice(["s", "t", "", None])) for _ in range(150)]
    rows += [(None, texts[2], "s"), (None, None, None), (70, None, "t"), (71, "", "u"), (3, texts[2], "s"), (3, texts[2], "s")]
    labels = [(d, rnd.choice([0, 1, None]), rnd.choice([0, 1, None]), 1) for d in [*range(0, 60, 2), 4, 4, None]]
    assert audited(spark, rows, labels) == expected(rows, labels)


def test_edges_of_the_filters(spark):
    words = " ".join(f"w{i}" for i in range(50))
    distinct = lambda d: " ".join([f"w{i}" for i in range(d)] + ["w0"] * (100 - d))
    rows = [
        (1, words, "s"), (2, words[:-4], "s"), (3, distinct(65), "s"), (4, distinct(64), "s"), (5, "A" * 5 + "b" * 95, "s"),
        (6, "A" * 6 + "b" * 94, "s"), (7, "Ä" * 50, "s"), (8, "W0 w0 " * 99, "s"), (9, words.replace(" ", "\u00a0"), "s"),
    ]
    assert audited(spark, rows, []) == expected(rows, [])
    fails = dict(zip([r[0] for r in rows], [f for _, f in brute_fails(rows)]))
    assert fails == {1: "", 2: "A", 3: "", 4: "B", 5: "A", 6: "AC", 7: "A", 8: "BC", 9: "A"}


def test_empty_and_long(spark):
    assert audited(spark, [], []) == []
    rows = [(1, prose(1, 300_000, 10**6), "s"), (2, prose(1, 300_000, 10**6), "s")]
    assert audited(spark, rows, [(2, 1, 1, 0)]) == expected(rows, [(2, 1, 1, 0)])

"""What a chain of quality filters removes, for every order the filters may be applied in.

A document's failures are one mask, so all that an audit needs is how many documents of a part have which mask. Those
counts become a decision diagram per part: a node asks for one filter and leads to the documents that pass it and to
those that fail it, and carries how many documents lie below. A level at which nothing fails is left out, and equal
sub-diagrams are one node. Walking from the top along the passing sides tells, at each level, how many are left and how
many were removed there.

Another order of two neighbouring filters is a swap of two neighbouring levels; the rest of the diagram stays. Plain
changes lead from each order to the next by one such swap, so all orders are visited and no diagram is built anew.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import map_rows

FILTERS = "ABCDE"
LEAST_WORDS = 50
# Shares in percent.
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
SIGNS = "[#$%&*|]"

WORD = r"[^\x20\x09-\x0D]+"
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)

# Documents, good ones and toxic ones.
Weight = tuple[int, int, int]
NOTHING = 0


def added(a: Weight, b: Weight) -> Weight:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


class Diagram:
    """Decision diagrams over failures; nodes are numbers, and equal nodes have equal numbers. Node 0 holds no document."""

    def __init__(self) -> None:
        self.weight: list[Weight] = [(0, 0, 0)]
        # The filter a node asks for, where passing and failing lead; leaves ask for none.
        self.asks: list[str] = [""]
        self.sides: list[tuple[int, int]] = [(0, 0)]
        self.known: dict[tuple, int] = {}

    def _node(self, key: tuple, asks: str, sides: tuple[int, int], weight: Weight) -> int:
        if key not in self.known:
            self.known[key] = len(self.weight)
            self.weight.append(weight)
            self.asks.append(asks)
            self.sides.append(sides)
        return self.known[key]

    def leaf(self, weight: Weight) -> int:
        return self._node(("", weight), "", (NOTHING, NOTHING), weight) if any(weight) else NOTHING

    def node(self, asks: str, passed: int, failed: int) -> int:
        """A node, unless nothing fails."""
        if failed == NOTHING:
            return passed
        return self._node((asks, passed, failed), asks, (passed, failed), added(self.weight[passed], self.weight[failed]))

    def parted(self, node: int, by: str) -> tuple[int, int]:
        """What of a node passes and what fails a filter that no node above it asks for."""
        return self.sides[node] if self.asks[node] == by else (node, NOTHING)

    def build(self, order: str, counts: dict[int, Weight], mask: int = 0, level: int = 0) -> int:
        """The diagram of counts per mask; bit i of a mask is a failure of filter i of ``FILTERS``."""
        if level == len(order):
            return self.leaf(counts.get(mask, (0, 0, 0)))
        failing = mask | 1 << FILTERS.index(order[level])
        passed, failed = (self.build(order, counts, m, level + 1) for m in (mask, failing))
        return self.node(order[level], passed, failed)

    def swapped(self, node: int, first: str, second: str, above: str) -> int:
        """The diagram with level ``second`` before its neighbour ``first``; ``above`` are the levels before both."""
        if self.asks[node] and self.asks[node] in above:
            passed, failed = (self.swapped(side, first, second, above) for side in self.sides[node])
            return self.node(self.asks[node], passed, failed)
        passed, failed = (self.parted(side, second) for side in self.parted(node, first))
        return self.node(second, self.node(first, passed[0], failed[0]), self.node(first, passed[1], failed[1]))


def plain_changes(n: int) -> Iterator[int]:
    """Places whose swap with the next place leads through all orders of ``n`` things, each once."""
    if n < 2:
        return
    down, up = range(n - 2, -1, -1), range(n - 1)
    yield from down
    at_front = True
    for place in plain_changes(n - 1):
        yield place + at_front
        yield from up if at_front else down
        at_front = not at_front


def orders(diagram: Diagram, root: int, order: str = FILTERS) -> Iterator[tuple[str, int]]:
    """Every order of the filters with its diagram."""
    yield order, root
    for i in plain_changes(len(order)):
        root = diagram.swapped(root, order[i], order[i + 1], order[:i])
        order = order[:i] + order[i + 1] + order[i] + order[i + 2 :]
        yield order, root


def audit_part(part: str, counts: dict[int, Weight]) -> Iterator[tuple]:
    """One row per order and step."""
    diagram = Diagram()
    steps, failing, shapley = [], dict.fromkeys(FILTERS, 0), dict.fromkeys(FILTERS, 0)
    for order, node in orders(diagram, diagram.build(FILTERS, counts)):
        for step, name in enumerate(order, 1):
            node, gone = diagram.parted(node, name)
            removed, good, toxic = diagram.weight[gone]
            if step == 1:
                failing[name] = removed
            shapley[name] += removed
            steps.append((order, step, name, diagram.weight[node][0], removed, good, toxic))
    alone = {name: counts.get(1 << i, (0, 0, 0))[0] for i, name in enumerate(FILTERS)}
    for order, step, name, kept, removed, good, toxic in steps:
        yield part, order, step, kept, removed, failing[name] - removed, alone[name], good, toxic, shapley[name]


def failures(text: Column) -> Column:
    """The failures of filters A to D, which the text alone decides, as a mask."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    conditions = [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.char_length(text),
        text.rlike(SIGNS),
    ]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters."""
    text = F.coalesce("text", F.lit(""))
    marked = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), failures(text).alias("mask"),
    )
    told = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    # Rows of one id are counted together, which spreads copies of a text over all tasks by their ids.
    same = marked.groupBy(*marked.columns).agg(F.count("*").alias("n")).join(told, "doc_id", "left")
    kinds = same.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))).alias("named"),
        F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
    )
    # A text is now a row per part and label, whatever number of copies it has.
    first = F.min("least").over(Window.partitionBy("digest"))
    spared = F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
    copies = kinds.withColumn("copies", F.coalesce(F.col("named") - spared, F.lit(0)))
    copy = 1 << FILTERS.index("E")
    split = F.array(
        F.struct("mask", (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(copy)).alias("mask"), F.col("copies").alias("n")),
    )
    cells = copies.select("part", "good", "toxic", F.explode(split).alias("cell")).select("part", "good", "toxic", "cell.*")
    return cells.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")],
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there.

    ``docs`` needs doc_id, text and source, ``labels`` doc_id, quality and toxic; others are not read. A null source is the part
    ``''``, a null text the empty one. A row without an id is no copy of another, makes none a copy and has no
    label; rows that share id and text are no copies of each other. A document with several labels is good if one of
    them says so, and toxic likewise. Parts without documents have no rows, so an empty table gives an empty one.
    """
    cells = F.collect_list(F.array(F.col("mask").cast("long"), "n", "good", "toxic")).alias("cells")

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for part, cells in rows:
            yield from audit_part(part, {mask: (n, good, toxic) for mask, n, good, toxic in cells})

    # At most 32 cells each.
    return map_rows(mask_counts(docs, labels).groupBy("part").agg(cells), rows_of, STEPS)

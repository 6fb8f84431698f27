"""Totals of a stream of micro-batches, each reduced once.

Totals add up, so the totals of everything are those of its micro-batches together. The ledger is a list of folders with
one row per key; a micro-batch adds one, and FAN_IN folders of one level become one of the next, so n
micro-batches leave at most FAN_IN * log(n) of them. A refresh reads these and nothing else. Moving rows from the live
table to the archive changes no total, so archive runs need no entry.

The number of the last micro-batch is part of the committed state: one that is repeated after a failure adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..model import schema
from ..operators.totals import merge
from ..sources import CommitLog, remove_folder
from ..sources.commit_log import Folder, State
from ..sources.parts import FAN_IN
from ..sources.tables import empty

TOTALS = schema("kpi STRING, key BIGINT, n BIGINT, n_priced BIGINT, n_odd BIGINT, units BIGINT, parts BIGINT, n_fraud BIGINT")


def kpi_merge(partials: DataFrame) -> DataFrame:
    return merge(partials, "kpi", "key")


class Ledger:
    def __init__(
        self, spark: SparkSession, root: str, columns: StructType = TOTALS, combine: Callable[[DataFrame], DataFrame] = kpi_merge
    ):
        """``combine`` makes one row per key of totals with these columns."""
        self.spark = spark
        self.columns = columns
        self.combine = combine
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")

    def state(self) -> State:
        """``upto``: the last micro-batch; ``entries``: [folder, level] each."""
        return {"upto": -1, "entries": [], **self.log.newest()[1]}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return empty(self.spark, self.columns)
        return self.spark.read.schema(self.columns).parquet(*[f"{self.root}/{f}" for f in folders])

    def _write(self, totals: DataFrame) -> str:
        folder = f"entries/{uuid.uuid4().hex}"
        totals.select(*self.columns.names).write.parquet(f"{self.root}/{folder}")
        return folder

    def totals(self) -> DataFrame:
        """Totals per key of everything."""
        return self.combine(self._read([folder for folder, _ in self.state()["entries"]]))

    def add(self, number: int, batch: Callable[[], DataFrame], everything: Callable[[], DataFrame]) -> None:
        """Enter micro-batch ``number``, unless it is entered already.

        ``batch`` gives its totals. Where micro-batches before it are missing, because the ledger is younger than
        the stream, it begins with the totals of ``everything`` instead.
        """
        state = self.state()
        if number <= state["upto"]:
            return
        first = number != state["upto"] + 1
        entries = [] if first else list(state["entries"])
        entries.append([self._write(everything() if first else batch()), 0])
        level = 0
        while len(same := [e for e in entries if e[1] == level]) >= FAN_IN:
            merged = self._write(self.combine(self._read([folder for folder, _ in same])))
            level += 1
            entries = [e for e in entries if e not in same] + [[merged, level]]
        self.log.commit(lambda _: {"upto": number, "entries": entries})

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove folders that none of the newest ``keep`` states names, and older states; returns the folders."""
        named = {folder for state in self.log.prune(keep) for folder, _ in state["entries"]}
        there = [f"entries/{name}" for name in Folder(self.spark, f"{self.root}/entries").names()]
        return [f"{self.root}/{f}" for f in sorted(there) if f not in named and remove_folder(self.spark, f"{self.root}/{f}")]

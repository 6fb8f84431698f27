"""A table made of parts: folders that are written once and that a commit log names.

Adding rows adds a part; merging small parts replaces them by one. Either is one commit. A reader takes the parts of one
state and reads nothing else, so it neither sees half a change nor loses rows to one, and a part that was named and
is gone raises.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.checksum import checksum, total
from .commit_log import CommitLog, Conflict, Folder, State
from .tables import Source, empty, remove_folder

# So many parts of about one size become one part.
FAN_IN = 8


class LostRows(RuntimeError):
    """Stored rows are not what they were when they were committed."""


@dataclass(frozen=True)
class Part:
    """A folder, and the number and checksum of its rows."""

    path: str
    rows: int
    checksum: str


def parts_of(state: State) -> list[Part]:
    return [Part(**p) for p in state.get("parts", [])]


def with_parts(state: State, parts: list[Part], **more: object) -> State:
    return {**state, "parts": [asdict(p) for p in parts], **more}


def replaced(state: State, old: list[Part], new: list[Part], **more: object) -> State:
    """``state`` with some parts instead of others; raises if one of these is gone."""
    parts = parts_of(state)
    if not set(old) <= set(parts):
        raise Conflict("parts that were read have been replaced meanwhile")
    return with_parts(state, [p for p in parts if p not in old] + new, **more)


def tier(part: Part) -> int:
    """Parts of one tier differ in size by less than FAN_IN times."""
    return int(math.log(max(1, part.rows), FAN_IN) + 1e-9)


class PartTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, by: str | None = None):
        """``by`` is a column whose values become folders within each part."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.by = by
        self.log = CommitLog(spark, f"{self.root}/log")

    def parts(self) -> list[Part]:
        return parts_of(self.log.newest()[1])

    def rows(self, parts: list[Part] | None = None) -> DataFrame:
        """The rows of some parts, by default of the newest state."""
        return read_parts(self.spark, self.root, self.parts() if parts is None else parts, self.schema)

    def write(self, df: DataFrame, folder: str = "parts") -> Part:
        """Write a part that nobody sees yet, and take its facts from what lies on disk."""
        path = f"{folder}/part={uuid.uuid4().hex}"
        rows = df.select(*self.schema.names)
        if self.by is None:
            rows.write.parquet(f"{self.root}/{path}")
        else:
            rows.hint("rebalance", self.by).write.partitionBy(self.by).parquet(f"{self.root}/{path}")
        return Part(path, *facts_of(read_parts(self.spark, self.root, [Part(path, 0, "")], self.schema)))

    def add(self, part: Part) -> State:
        return self.log.commit(lambda state: replaced(state, [], [part]))[1]

    def verify(self, parts: list[Part] | None = None) -> None:
        """Raise unless the stored rows of some parts are those that were committed."""
        parts = self.parts() if parts is None else parts
        verify(self.rows(parts), parts)

    def compact(self, fan_in: int = FAN_IN) -> int:
        """Merge parts until no tier has ``fan_in`` of them; returns the number of merges.

        A row is rewritten once per tier, and n rows never lie in more than fan_in * log(n) parts. The old parts stay until
        they are removed by ``vacuum``, so who reads them goes on undisturbed.
        """
        merges = 0
        while True:
            tiers: dict[int, list[Part]] = {}
            for part in self.parts():
                tiers.setdefault(tier(part), []).append(part)
            crowded = [parts for parts in tiers.values() if len(parts) >= fan_in]
            if not crowded:
                return merges
            old = crowded[0]
            new = self.write(self.rows(old))
            if (new.rows, new.checksum) != (sum(p.rows for p in old), total([p.checksum for p in old])):
                raise LostRows(f"{new} does not hold what {old} held; nothing was committed")
            self.log.commit(lambda state: replaced(state, old, [new]))
            merges += 1

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the parts that none of the newest ``keep`` states names, and older states; returns the folders.

        No writer may be at work: a part is written before it is named.
        """
        named = {p.path for state in self.log.prune(keep) for p in parts_of(state)}
        return remove_unnamed(self.spark, self.root, "parts", named)


def facts_of(df: DataFrame) -> tuple[int, str]:
    """Number and checksum of rows."""
    return tuple(df.agg(F.count("*"), checksum(sorted(df.columns))).first())


def verify(rows: DataFrame, parts: list[Part]) -> None:
    wanted = sum(p.rows for p in parts), total([p.checksum for p in parts])
    found = facts_of(rows)
    if found != wanted:
        raise LostRows(f"{[p.path for p in parts]} hold {found} instead of {wanted}")


def read_parts(spark: SparkSession, root: str, parts: list[Part], schema: StructType) -> DataFrame:
    """The rows of some parts. Their folders are named, so only they are listed, and one that is gone raises."""
    if not parts:
        return empty(spark, schema)
    folders = sorted({p.path.rsplit("/", 1)[0] for p in parts})
    frames = []
    for folder in folders:
        paths = [f"{root}/{p.path}" for p in parts if p.path.rsplit("/", 1)[0] == folder]
        source = spark.read.schema(schema).option("basePath", f"{root}/{folder}")
        frames.append(source.parquet(*paths).select(*schema.names))
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def remove_unnamed(spark: SparkSession, root: str, folder: str, named: set[str]) -> list[str]:
    """Remove the parts below a folder that are not named; returns them."""
    there = [f"{folder}/{name}" for name in Folder(spark, f"{root}/{folder}").names()]
    return [f"{root}/{path}" for path in sorted(there) if path not in named and remove_folder(spark, f"{root}/{path}")]

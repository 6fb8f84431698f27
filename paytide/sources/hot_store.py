"""The hot table with its archive and manifest.

Hot data lies in parts: folders that are written once. A commit log names the parts that are live and the manifest of the
archive runs. Ingest adds a part. An archive run reads the parts of one state, writes an archive batch and a part with
what it kept, and commits them instead of exactly the parts it read, so whatever was ingested meanwhile stays live. Two runs
at once cannot both replace a part: the second is refused and made again. A run that dies half way leaves only folders nobody reads.

A live table kept elsewhere has no parts here; the manifest and the batches tell what of it is still live.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.checksum import checksum
from ..functions.clock import moment, typed_time
from ..model import ARCHIVED_FACT, FINGERPRINTS, MANIFEST, STORED_FACT
from ..operators.hot_cold import expired, nameless
from .commit_log import CommitLog, Conflict, Folder, State
from .parts import LostRows, Part, facts_of, parts_of, read_parts, remove_unnamed, replaced, tier, verify, FAN_IN
from .tables import Source, empty, remove_folder

Transform = Callable[[DataFrame], DataFrame]

# So many hours of an external table that differ from the archive go into its scan as literals.
SENT_HOURS = 10_000


@dataclass(frozen=True)
class Snapshot:
    """One state of a store. Everything read through it fits together, whatever is committed meanwhile."""

    generation: int
    parts: tuple[Part, ...]
    manifest: str | None


@dataclass(frozen=True)
class ArchiveRun:
    """What an archive run commits: its manifest row, and the part it kept, on top of the snapshot it read."""

    read: Snapshot
    row: DataFrame
    kept: Part | None


def snapshot_of(state: State) -> Snapshot:
    return Snapshot(state.get("generation", 0), tuple(parts_of(state)), state.get("manifest"))


class HotStore:
    def __init__(self, spark: SparkSession, root: str, origin: DataFrame | None = None):
        """``origin`` is a live table kept elsewhere, which others write to and this store never does.

        What is hot is then, at any time, what the origin holds less what was archived.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.origin = origin
        self.log = CommitLog(spark, f"{self.root}/log")

    @property
    def archive_root(self) -> str:
        return f"{self.root}/archive"

    def generation_path(self, generation: int) -> str:
        return f"{self.root}/hot/generation={generation}"

    def snapshot(self) -> Snapshot:
        return snapshot_of(self.log.newest()[1])

    def runs(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Committed archive runs, one row each."""
        manifest = (snapshot or self.snapshot()).manifest
        return empty(self.spark, MANIFEST) if manifest is None else Source(f"{self.root}/{manifest}").read(self.spark, MANIFEST)

    def generation(self) -> int:
        """The number of archive runs that moved the live table on."""
        return self.snapshot().generation

    def current(self, snapshot: Snapshot | None = None) -> DataFrame:
        """The live rows: an empty frame with the full schema when there are none."""
        snapshot = snapshot or self.snapshot()
        if self.origin is not None:
            return self._left_in_origin(snapshot)
        return read_parts(self.spark, self.root, list(snapshot.parts), STORED_FACT)

    def verify(self, snapshot: Snapshot | None = None) -> None:
        """Raise unless the live parts hold the rows that were committed."""
        snapshot = snapshot or self.snapshot()
        verify(read_parts(self.spark, self.root, list(snapshot.parts), STORED_FACT), list(snapshot.parts))

    def _left_in_origin(self, snapshot: Snapshot) -> DataFrame:
        """Rows of the origin that no run up to this snapshot archived.

        All at or after the last run's cutoff is live. Of what is older, hours whose rows are, by number and checksum, those
        that were archived have nothing live in them. That is told from one row per hour; only the rows of the other hours
        are looked up by id in the archive.
        """
        rows = typed_time(self.origin).select(*STORED_FACT.names)
        runs = self.runs(snapshot)
        known = runs.select("batch_id", "cutoff").collect()
        if not known:
            return rows
        cutoff = moment(max(known, key=lambda r: r.batch_id).cutoff)
        old = rows.where(expired("ts", cutoff))
        fresh = rows.where((F.col("ts") >= cutoff) & (F.col("txn_date") >= cutoff.cast("date")))
        inside = self._hours_that_differ(old, runs)
        if inside is None:
            return fresh
        key = F.coalesce("transaction_id", nameless(STORED_FACT.names))
        stored = inside(self.archived(runs)).select("txn_date", key.alias("archived")).distinct()
        late = inside(old).withColumn("identity", key).join(
            stored.withColumnRenamed("txn_date", "archived_day"),
            F.col("txn_date").eqNullSafe(F.col("archived_day")) & (F.col("identity") == F.col("archived")), "left_anti",
        )
        return fresh.unionByName(late.drop("identity"))

    def _hours_that_differ(self, old: DataFrame, runs: DataFrame) -> Transform | None:
        """A filter to the hours in which ``old`` is not what the runs archived; None if there is no such hour.

        Hours are compared in both directions: rows can be missing from the origin as well.
        """
        there = fingerprints(old).withColumnRenamed("hour", "there")
        before = added_up(self._run_fingerprints(runs)).withColumnRenamed("hour", "archived_hour")
        same = (
            F.col("there").eqNullSafe(F.col("archived_hour"))
            & (there["rows"] == before["rows"]) & (there["checksum"] == before["checksum"])
        )
        differ = there.join(before, same, "left_anti").select("there")
        hours = [r.there for r in differ.limit(SENT_HOURS + 1).collect()]
        if not hours:
            return None
        hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
        if len(hours) > SENT_HOURS:
            return lambda df: df.join(differ, hour.eqNullSafe(F.col("there")), "left_semi")
        days = sorted({h.date() for h in hours if h is not None})
        named = hour.isin([moment(h) for h in hours if h is not None]) if days else F.lit(False)
        # Days prune folders and row groups.
        timed = F.col("txn_date").isin(days) & named if days else F.lit(False)
        return lambda df: df.where(timed | F.col("ts").isNull() if None in hours else timed)

    def _run_fingerprints(self, runs: DataFrame) -> DataFrame:
        folders = sorted(r.folder for r in runs.select("folder").collect())
        paths = [f"{self.root}/fingerprints/{folder_name(f)}" for f in folders]
        return self.spark.read.schema(FINGERPRINTS).parquet(*paths)

    def archived(self, runs: DataFrame) -> DataFrame:
        """All rows of the batches of some runs, with their batch ids; a batch that is gone raises."""
        roots: dict[str, list[str]] = {}
        for r in runs.select("folder").collect():
            roots.setdefault(r.folder.rsplit("/", 1)[0], []).append(f"{self.root}/{r.folder}")
        frames = [
            self.spark.read.schema(ARCHIVED_FACT).option("basePath", f"{self.root}/{base}").parquet(*sorted(paths))
            .select(*ARCHIVED_FACT.names)
            for base, paths in sorted(roots.items())
        ]
        return reduce(DataFrame.unionByName, frames) if frames else empty(self.spark, ARCHIVED_FACT)

    def archive(self, snapshot: Snapshot | None = None) -> DataFrame:
        return self.archived(self.runs(snapshot))

    def verify_batches(self, runs: DataFrame) -> None:
        """Raise unless the batches of some runs hold the rows their manifest rows name."""
        names = STORED_FACT.names
        wanted = {r.batch_id: (r.stored, r.checksum) for r in runs.select("batch_id", "stored", "checksum").collect()}
        held = self.archived(runs).groupBy("batch_id").agg(F.count("*").alias("rows"), checksum(sorted(names)).alias("checksum"))
        found = {r.batch_id: (r.rows, r.checksum) for r in held.collect()}
        wrong = sorted(b for b, facts in wanted.items() if found.get(b, NOTHING) != facts)
        if wrong:
            raise LostRows(f"batches {wrong} do not hold the rows of the manifest")

    def ingest(self, df: DataFrame) -> None:
        """Append transactions to the live table, at any time, also while an archive run is at work."""
        if self.origin is not None:
            raise ValueError("the live table is kept elsewhere")
        part = self.write_part(typed_time(df), self.snapshot().generation)
        self.log.commit(lambda state: replaced(state, [], [part]))

    def replace_live(self, keep: Transform, leave_out: Transform, rejected: str) -> int:
        """Leave rows out of the live table, and store them below ``rejected``; returns their number.

        ``keep`` and ``leave_out`` part the live rows in two. The parts that were read are replaced in one commit; a run that
        overtakes it raises Conflict, and nothing is left out.
        """
        snapshot = self.snapshot()
        rows = self.current(snapshot)
        path = f"{rejected.rstrip('/')}/{uuid.uuid4().hex}"
        leave_out(rows).write.parquet(path)
        gone = self.spark.read.schema(leave_out(rows).schema).parquet(path).count()
        if gone:
            part = self.write_part(keep(rows), snapshot.generation)
            if part.rows + gone != sum(p.rows for p in snapshot.parts):
                raise LostRows(f"{part.rows} rows kept and {gone} left out; nothing was committed")
            self.log.commit(lambda state: replaced(state, list(snapshot.parts), [part] if part.rows else []))
        return gone

    def write_part(self, df: DataFrame, generation: int) -> Part:
        """Write a part of the live table that nobody sees yet, and take its facts from what lies on disk."""
        path = f"hot/generation={generation}/part={uuid.uuid4().hex}"
        df.select(*STORED_FACT.names).write.parquet(f"{self.root}/{path}")
        return Part(path, *facts_of(Source(f"{self.root}/{path}").read(self.spark, STORED_FACT)))

    def write_generation(self, df: DataFrame, generation: int) -> DataFrame:
        """Write a part and read it."""
        return read_parts(self.spark, self.root, [self.write_part(df, generation)], STORED_FACT)

    def batch_folder(self, batch_id: int) -> str:
        """Where an attempt to write a batch puts it. The first one claims the usual place, others never touch it."""
        usual = f"archive/batch_id={batch_id}"
        if Folder(self.spark, f"{self.root}/claims").put_new(f"batch_id={batch_id}", ""):
            return usual
        return f"archive_again/{uuid.uuid4().hex}/batch_id={batch_id}"

    def write_batch(self, df: DataFrame, batch_id: int, folder: str | None = None) -> DataFrame:
        """Write one archive batch by date and return it as stored.

        REBALANCE sizes the files at run time: small dates share a task, a date holding most of
        the batch is split over many.
        """
        path = f"{self.root}/{folder or self.batch_folder(batch_id)}"
        rows = df.select(*STORED_FACT.names).hint("rebalance", "txn_date")
        rows.write.partitionBy("txn_date").parquet(path)
        return Source(path).read(self.spark, STORED_FACT)

    def write_fingerprints(self, left: DataFrame, folder: str) -> None:
        """Store, per hour, what of a batch left the live table."""
        fingerprints(left).write.parquet(f"{self.root}/fingerprints/{folder_name(folder)}")

    def commit(self, run: ArchiveRun) -> None:
        """Make a run count; raises Conflict if another run or a merge replaced what it read."""
        manifest = f"manifest/{uuid.uuid4().hex}"
        rows = self.runs(run.read).unionByName(run.row.select(*MANIFEST.names))
        rows.coalesce(1).write.parquet(f"{self.root}/{manifest}")

        def change(state: State) -> State:
            if state.get("generation", 0) != run.read.generation:
                raise Conflict("another archive run was committed meanwhile")
            kept = [run.kept] if run.kept is not None and run.kept.rows else []
            return replaced(state, list(run.read.parts), kept, generation=run.read.generation + 1, manifest=manifest)

        self.log.commit(change)

    def compact(self, fan_in: int = FAN_IN) -> int:
        """Merge small live parts of about one size; returns the number of merges. Readers and archive runs go on meanwhile."""
        merges = 0
        while True:
            snapshot = self.snapshot()
            tiers: dict[int, list[Part]] = {}
            for part in snapshot.parts:
                tiers.setdefault(tier(part), []).append(part)
            old = next((parts for parts in tiers.values() if len(parts) >= fan_in), None)
            if old is None:
                return merges
            new = self.write_part(read_parts(self.spark, self.root, old, STORED_FACT), snapshot.generation)
            verify(read_parts(self.spark, self.root, [new], STORED_FACT), old)
            self.log.commit(lambda state: replaced(state, old, [new]))
            merges += 1

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove live parts, manifests and log entries that none of the newest ``keep`` states names; returns the folders.

        Archive batches are never removed. No writer may be at work: a part is written before it is named.
        """
        states = [snapshot_of(state) for state in self.log.prune(keep)]
        named = {p.path for s in states for p in s.parts}
        gone = []
        for folder in sorted(Folder(self.spark, f"{self.root}/hot").names()):
            if not any(path.startswith(f"hot/{folder}/") for path in named):
                gone += [f"{self.root}/hot/{folder}"] if remove_folder(self.spark, f"{self.root}/hot/{folder}") else []
            else:
                gone += remove_unnamed(self.spark, self.root, f"hot/{folder}", named)
        remove_unnamed(self.spark, self.root, "manifest", {s.manifest for s in states})
        return gone


NOTHING = (0, "0:0")


def folder_name(folder: str) -> str:
    """A batch's folder as one name."""
    return folder.replace("/", "-")


def fingerprints(rows: DataFrame) -> DataFrame:
    """Number and checksum of rows per hour; combined inside the map tasks, so a row per hour and task is shuffled."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    return rows.groupBy(hour).agg(F.count("*").alias("rows"), checksum(sorted(STORED_FACT.names)).alias("checksum"))


def added_up(parts: DataFrame) -> DataFrame:
    """Fingerprints of several sets of rows as those of all of them."""
    sums = [F.sum(F.split("checksum", ":")[i].cast("decimal(38,0)")) for i in range(2)]
    return parts.groupBy("hour").agg(F.sum("rows").alias("rows"), F.concat_ws(":", *sums).alias("checksum"))

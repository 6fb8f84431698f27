from .tables import Source, load_archive, load_dimension, load_hot, read_or_empty, register, remove_folder, has_rows
from .commit_log import CommitLog, Conflict
from .parts import LostRows, Part, PartTable
from .hot_store import ArchiveRun, HotStore, Snapshot

__all__ = ["Source", "load_archive", "load_dimension", "load_hot", "read_or_empty", "register", "remove_folder", "has_rows",
           "CommitLog", "Conflict", "LostRows", "Part", "PartTable", "ArchiveRun", "HotStore", "Snapshot"]

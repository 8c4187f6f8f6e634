"""Dumps, snapshots and change logs on storage."""

from daybook.sources.csv_dump import read_csv_dump
from daybook.sources.store import DumpStore
from daybook.sources.tables import (
    empty_frame,
    read_change_log,
    read_snapshot,
    write_change_log,
    write_snapshot,
)

__all__ = [
    "DumpStore",
    "empty_frame",
    "read_change_log",
    "read_csv_dump",
    "read_snapshot",
    "write_change_log",
    "write_snapshot",
]

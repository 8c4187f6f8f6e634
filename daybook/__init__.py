"""Daily dumps of a keyed table: change sets, a change log, and the table as of any day."""

from daybook.errors import (
    ClaimError,
    DayOrderError,
    KeyQualityError,
    MalformedRowsError,
    MissingColumnError,
    NoSnapshotError,
    UncomparableColumnError,
)
from daybook.spec import TableSpec

__all__ = [
    "ClaimError",
    "DayOrderError",
    "KeyQualityError",
    "MalformedRowsError",
    "MissingColumnError",
    "NoSnapshotError",
    "TableSpec",
    "UncomparableColumnError",
]

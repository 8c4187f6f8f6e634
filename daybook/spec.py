"""What the operators need to know about a table: its key and its change columns."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

INSERT = "I"
UPDATE = "U"
DELETE = "D"
UPSERTS = (INSERT, UPDATE)
OPS = (INSERT, UPDATE, DELETE)


def _names(value: str | Iterable[str]) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)


@dataclass(frozen=True)
class TableSpec:
    """Key columns, compared columns and the names of the two log columns.

    ``compared=None`` compares every non-key column of the newer snapshot.
    """

    keys: tuple[str, ...]
    compared: tuple[str, ...] | None = None
    op: str = "op"
    day: str = "day"

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", _names(self.keys))
        if self.compared is not None:
            object.__setattr__(self, "compared", _names(self.compared))
        if not self.keys:
            raise ValueError("a table needs at least one key column")
        if len(set(self.keys)) != len(self.keys):
            raise ValueError(f"key columns repeat: {list(self.keys)}")
        reserved = {self.op, self.day} & {*self.keys, *(self.compared or ())}
        if reserved or self.op == self.day:
            raise ValueError(f"op and day must be columns of their own, got {self.op!r}, {self.day!r}")

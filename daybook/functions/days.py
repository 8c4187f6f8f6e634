"""Days enter the library here, as real dates."""

from __future__ import annotations

import re
from datetime import date, datetime

_ISO_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def parse_day(value: str | date) -> date:
    """``YYYY-MM-DD`` or a date; anything else is refused before any data is read."""
    if isinstance(value, datetime):
        raise ValueError(f"expected a day, got a point in time: {value!r}")
    if isinstance(value, date):
        return value
    if not isinstance(value, str) or not _ISO_DAY.fullmatch(value):
        raise ValueError(f"expected a day as YYYY-MM-DD, got {value!r}")
    return date.fromisoformat(value)

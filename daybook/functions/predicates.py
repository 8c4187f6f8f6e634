"""Row predicates shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns: Iterable[Column]) -> Column:
    return reduce(or_, [c.isNull() for c in columns], F.lit(False))


def none_null(columns: Iterable[Column]) -> Column:
    return reduce(and_, [c.isNotNull() for c in columns], F.lit(True))


def rows_differ(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """True if some pair differs; null equals null, NaN equals NaN, 0.0 equals -0.0.

    Without any pair nothing can differ, so a key-only table has no updates.
    """
    return reduce(or_, [~a.eqNullSafe(b) for a, b in zip(left, right)], F.lit(False))

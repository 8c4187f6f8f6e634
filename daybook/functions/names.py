"""Column lookup by Spark's own case rule, and quoting for any column name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.errors import MissingColumnError, UncomparableColumnError
from daybook.spec import TableSpec


def quoted(name: str, side: str | None = None) -> str:
    """The name as Spark reads it back literally, dots and back-ticks included."""
    ticked = "`" + name.replace("`", "``") + "`"
    return f"{side}.{ticked}" if side else ticked


def col(name: str, side: str | None = None) -> Column:
    return F.col(quoted(name, side))


def cols(names: Iterable[str], side: str | None = None) -> list[Column]:
    return [col(n, side) for n in names]


def fold(spark: SparkSession, name: str) -> str:
    """What all spellings of one name have in common."""
    return name if spark.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def same_name(df: DataFrame, a: str, b: str) -> bool:
    return fold(df.sparkSession, a) == fold(df.sparkSession, b)


def spare_name(wish: str, *frames: DataFrame) -> str:
    """``wish``, lengthened until no frame has a column of that name, whatever its case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def find_column(df: DataFrame, name: str) -> str | None:
    """The frame's spelling of ``name``, or None if it has no such column."""
    if name in df.columns:
        return name
    return next((c for c in df.columns if same_name(df, c, name)), None)


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> list[str]:
    """The frame's spelling of each name; raises if one is missing."""
    names = list(names)
    found = [find_column(df, n) for n in names]
    missing = [n for n, f in zip(names, found) if f is None]
    if missing:
        raise MissingColumnError(f"{what} lacks {missing}; it has {df.columns}")
    return found


def spec_for(df: DataFrame, spec: TableSpec, what: str, *, log: bool = False) -> TableSpec:
    """The spec in the frame's own spelling, with its columns checked."""
    keys = tuple(require_columns(df, spec.keys, what))
    if not log:
        return TableSpec(keys, spec.compared, spec.op, spec.day)
    op, day = require_columns(df, [spec.op, spec.day], what)
    return TableSpec(keys, spec.compared, op, day)


# Types that Spark defines no order and no equality for.
_UNORDERED = tuple(
    t
    for t in (getattr(T, n, None) for n in ("MapType", "VariantType", "CalendarIntervalType"))
    if t is not None
)


def is_comparable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return is_comparable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(is_comparable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, _UNORDERED)


def require_comparable(df: DataFrame, names: Iterable[str], what: str) -> None:
    bad = [n for n in names if not is_comparable(df.schema[n].dataType)]
    if bad:
        raise UncomparableColumnError(
            f"{what}: {bad} cannot be compared; leave them out of TableSpec.compared"
        )

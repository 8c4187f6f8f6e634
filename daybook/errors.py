"""Errors raised where going on would give a wrong or silently empty result."""


class MissingColumnError(ValueError):
    """A column the operation needs is not in the frame."""


class UncomparableColumnError(ValueError):
    """A key or compared column has a type that Spark cannot compare."""


class KeyQualityError(ValueError):
    """Strict mode met null or duplicate keys."""


class MalformedRowsError(ValueError):
    """Strict mode met lines of a dump that do not fit its columns."""


class DayOrderError(ValueError):
    """A day earlier than the newest integrated day."""


class ClaimError(RuntimeError):
    """Another run is at work on the store, or took this one for dead."""


class NoSnapshotError(LookupError):
    """The store holds no integrated day yet."""

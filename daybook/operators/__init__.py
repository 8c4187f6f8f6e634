"""DataFrame in, DataFrame out. Nothing here runs a job."""

from daybook.operators.align import align_union
from daybook.operators.diff import (
    change_counts,
    change_set,
    change_set_by_digests,
    deleted,
    inserted,
    row_digests,
    touched_keys,
    updated,
)
from daybook.operators.quality import (
    clean_dump,
    dedupe_by_key,
    drop_null_keys,
    duplicate_keys,
    key_quality,
)
from daybook.operators.replay import (
    among_keys,
    apply_changes,
    history,
    log_day,
    log_days,
    net_changes,
    snapshot_as_of,
    snapshots_as_of,
    stamp_day,
)
from daybook.operators.report import group_changes, group_count, preview

__all__ = [
    "align_union",
    "among_keys",
    "apply_changes",
    "change_counts",
    "change_set",
    "change_set_by_digests",
    "clean_dump",
    "dedupe_by_key",
    "deleted",
    "drop_null_keys",
    "duplicate_keys",
    "group_changes",
    "group_count",
    "history",
    "inserted",
    "key_quality",
    "log_day",
    "log_days",
    "net_changes",
    "preview",
    "row_digests",
    "snapshot_as_of",
    "snapshots_as_of",
    "stamp_day",
    "touched_keys",
    "updated",
]

"""Jobs: operators put together with storage. These run Spark actions."""

from daybook.plans.compare import diff_snapshots
from daybook.plans.integrate import Integration, integrate_csv, integrate_day
from daybook.plans.latest import report_incremental, report_latest
from daybook.plans.recompute import fold_log, recompute_snapshot, stored_snapshot_as_of

__all__ = [
    "Integration",
    "diff_snapshots",
    "fold_log",
    "integrate_csv",
    "integrate_day",
    "recompute_snapshot",
    "report_incremental",
    "report_latest",
    "stored_snapshot_as_of",
]

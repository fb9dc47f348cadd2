from aprisco.operators.asof import asof_version_join
from aprisco.operators.history import (
    as_dimension,
    check_snapshot,
    current_versions,
    replay_snapshots,
    snapshot_step,
)
from aprisco.operators.joins import full_outer_merge, join_calendar, star_join
from aprisco.operators.rollup import daily_rollup

__all__ = [
    "as_dimension",
    "asof_version_join",
    "check_snapshot",
    "current_versions",
    "daily_rollup",
    "full_outer_merge",
    "join_calendar",
    "replay_snapshots",
    "snapshot_step",
    "star_join",
]

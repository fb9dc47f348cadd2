from aprisco.quality.anomaly import (
    column_metrics,
    daily_loads,
    freshness_metrics,
    score_anomalies,
    volume_metrics,
)
from aprisco.quality.checks import (
    accepted_values,
    count_reconciliation,
    freshness,
    judge_freshness,
    ledger_reconciliation,
    not_null,
    not_null_within,
    relationships,
    unique,
)
from aprisco.quality.runner import Check, CheckFailed, Verdict, run_checks, watch
from aprisco.quality.sketches import column_sketches, merged_profile, refresh_sketches, stored_sketches

__all__ = [
    "Check",
    "CheckFailed",
    "Verdict",
    "accepted_values",
    "column_metrics",
    "column_sketches",
    "count_reconciliation",
    "daily_loads",
    "freshness",
    "freshness_metrics",
    "judge_freshness",
    "ledger_reconciliation",
    "merged_profile",
    "not_null",
    "not_null_within",
    "refresh_sketches",
    "relationships",
    "run_checks",
    "score_anomalies",
    "stored_sketches",
    "unique",
    "volume_metrics",
    "watch",
]

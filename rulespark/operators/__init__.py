from .ledger import final_rows, latest_status, of_runs, started_rows, status_history, with_run_ids
from .selection import (
    approved_rules,
    has_feed_mapping,
    mapped_rules,
    rule_rows,
    rules_for_feed,
    rules_for_packages,
    rules_for_requests,
    select_rules,
    unmapped_rules,
)
from .verdict import (
    all_succeeded,
    categorize,
    exception_check,
    exceptions_applied,
    exceptions_in_time,
    exit_code,
    verdict,
    verdict_from_approvals,
    waiting_rules,
)

__all__ = [
    "all_succeeded", "approved_rules", "categorize", "exception_check", "exceptions_applied",
    "exceptions_in_time", "exit_code", "final_rows", "has_feed_mapping", "latest_status",
    "mapped_rules", "of_runs", "rule_rows", "rules_for_feed", "rules_for_packages", "rules_for_requests",
    "select_rules",
    "started_rows", "status_history", "unmapped_rules", "verdict", "verdict_from_approvals",
    "waiting_rules", "with_run_ids",
]

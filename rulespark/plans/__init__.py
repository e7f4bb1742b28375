from .programs import (
    handler_for,
    program_types,
    python_rule,
    register_program_type,
    run_program,
    run_python_rule,
    run_sql_rule,
)
from .runs import Outcome, RunSettings, by_approvals, by_latest_status, resume, run, run_over, run_rule, run_rules, stamp_results

__all__ = [
    "Outcome", "RunSettings", "by_approvals", "by_latest_status", "handler_for", "program_types", "python_rule", "register_program_type",
    "resume", "run", "run_over", "run_program", "run_python_rule", "run_rule", "run_rules", "run_sql_rule", "stamp_results",
]

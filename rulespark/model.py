"""Column layouts and fixed words of the rule tables."""

from pyspark.sql import types as T

# Column names of the four rule tables, in table order.
RULE_COLUMNS = (
    "rule_id", "rule_name", "rule_type", "rule_status", "module", "stage", "package",
    "slg", "program_type", "program_code", "created_dt", "created_by", "modified_dt",
    "modified_by",
)
RULE_TEXT_COLUMNS = RULE_COLUMNS[:10]
AUDIT_COLUMNS = RULE_COLUMNS[10:]
STATUS_COLUMNS = (
    "rule_run_id", *RULE_TEXT_COLUMNS, "rule_execution_status", "execution_date",
    "processing_date", "exception_applied", "action", "workflow_status",
)
RESULT_COLUMNS = ("RULE_RUN_ID", "RULE_ID", "HEADER_DATA", "COL1", "COL2", "COL3")
RESULT_DATA_COLUMNS = RESULT_COLUMNS[2:]

# Words stored in those tables.
SELECTED_STATUSES = ("Active", "Passive")
ACTIVE, PASSIVE = SELECTED_STATUSES
YES, NO = "Yes", "No"
APPROVED = "Approved"
STARTED, SUCCESS, FAILURE = "Started", "Success", "Failure"
IN_PROGRESS, COMPLETED, FAILED = "In Progress", "Completed", "Failed"

# Exit codes of a run.
EXIT_PASS, EXIT_FAIL = 0, 100


def _strings(names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# A selected rule as text, with the id of the run it is about to make.
RUNNABLE_RULE_SCHEMA = _strings(("rule_run_id", *RULE_COLUMNS))
LEDGER_SCHEMA = _strings(STATUS_COLUMNS).add("created_dt", T.TimestampType())
RESULT_SCHEMA = _strings(RESULT_COLUMNS)

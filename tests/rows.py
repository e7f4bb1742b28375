"""Small hand-made tables."""

from datetime import datetime

from rulespark.model import RULE_COLUMNS, RUNNABLE_RULE_SCHEMA

RULE_TYPES = ", ".join(f"{name} string" for name in RULE_COLUMNS)
MAP_TYPES = "rule_id string, feed_id string, rule_applicable_status string"
LEDGER_TYPES = ("rule_id string, rule_run_id string, rule_execution_status string, exception_applied string, "
                "rule_status string, created_dt timestamp_ntz")


def rule(rule_id, **changes):
    values = dict.fromkeys(RULE_COLUMNS, "v")
    values |= {"rule_id": rule_id, "rule_status": "Active", "module": "M", "stage": "S", "package": "P"}
    return tuple((values | changes).values())


def catalog(spark, *rules):
    return spark.createDataFrame(list(rules), RULE_TYPES)


def feed_map(spark, *rows):
    return spark.createDataFrame(list(rows), MAP_TYPES)


def at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def ledger(spark, *rows):
    """Rows of (rule, run, status, exception, rule status, time)."""
    return spark.createDataFrame(list(rows), LEDGER_TYPES)


def ids(df):
    return sorted(row.rule_id or "" for row in df.select("rule_id").collect())


def program(spark, name, path, **changes):
    values = dict.fromkeys(RUNNABLE_RULE_SCHEMA.names, "")
    values |= {"rule_run_id": f"run_{name}", "rule_id": name, "rule_status": "Active", "module": "M",
               "stage": "S", "package": "P", "program_type": "SQL", "program_code": str(path)}
    return values | changes

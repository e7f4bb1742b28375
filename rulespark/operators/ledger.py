"""The append-only status ledger: rows to write, and the state it holds."""

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import (
    COMPLETED,
    FAILED,
    FAILURE,
    IN_PROGRESS,
    LEDGER_SCHEMA,
    NO,
    RULE_TEXT_COLUMNS,
    STARTED,
    SUCCESS,
)
from .joins import KEY, id_frame, lookup_join, of_ids

LATEST_COLUMNS = ("rule_run_id", "created_dt", "rule_execution_status", "exception_applied", "rule_status")


def with_run_ids(rules, token=None, now=None):
    """Add ``rule_run_id``: ten hex digits, ``_``, seconds since 1970.

    The digits come from hashing the row with a token drawn once per run, not from
    ``uuid()`` per row, so a task that is run again gives its rows the same ids.
    """
    token = token or uuid.uuid4().hex
    seconds = int((now or datetime.now()).timestamp())
    digits = F.substring(F.sha2(F.to_json(F.struct(F.lit(token).alias("_token"), *rules.columns)), 256), 1, 10)
    return rules.withColumn("rule_run_id", F.concat(digits, F.lit(f"_{seconds}")))


def _ledger_rows(rules, now, status, workflow):
    now = now or datetime.now()
    today = F.lit(now.strftime("%Y-%m-%d"))
    values = {
        "rule_run_id": F.col("rule_run_id"),
        **{name: F.col(name) for name in RULE_TEXT_COLUMNS},
        "rule_execution_status": status,
        "execution_date": today,
        "processing_date": today,
        "exception_applied": F.lit(NO),
        "action": F.lit(""),
        "workflow_status": workflow,
        "created_dt": F.lit(now).cast("timestamp"),
    }
    return rules.select(*[values[name].alias(name) for name in LEDGER_SCHEMA.names])


def started_rows(rules, now=None):
    """One row per rule about to run."""
    return _ledger_rows(rules, now, F.lit(STARTED), F.lit(IN_PROGRESS))


def final_rows(outcomes, now=None):
    """One row per finished rule, by its boolean column ``succeeded``."""
    succeeded = F.coalesce("succeeded", F.lit(False))
    return _ledger_rows(
        outcomes,
        now,
        F.when(succeeded, SUCCESS).otherwise(FAILURE),
        F.when(succeeded, COMPLETED).otherwise(FAILED),
    )


def newest():
    """Aggregate: a rule's latest row, as a struct.

    Rows without a time come first, as they do where the ledger's database sorts
    times downwards; equal times go by run id, and a finished row beats the start of
    the same run. A maximum is combined before the shuffle, so a rule that holds a
    third of the ledger sends one row per task.
    """
    return F.max(ledger_order())


def ledger_order():
    """A ledger row as a struct that compares by age."""
    return F.struct(
        F.col("created_dt").isNull().alias("_undated"),
        F.col("created_dt"),
        F.col("rule_run_id"),
        (~F.col("rule_execution_status").eqNullSafe(STARTED)).alias("_finished"),
        F.col("rule_execution_status"),
        F.col("exception_applied"),
        F.col("rule_status"),
    )


def of_runs(ledger, run_ids):
    """The rows of some runs only, from a DataFrame with a rule_run_id column or any iterable."""
    if isinstance(run_ids, DataFrame):
        return ledger.join(run_ids.select("rule_run_id").distinct(), "rule_run_id", "left_semi").select(ledger.columns)
    return ledger.where(F.col("rule_run_id").isin(list(run_ids)))


def latest_status(ledger, ids=None, run_ids=None):
    """The latest row of each rule; of the given rules and runs only, if given.

    """
    if run_ids is not None:
        ledger = of_runs(ledger, run_ids)
    latest = ledger.groupBy(KEY).agg(newest().alias("_newest"))
    if ids is not None:
        latest = of_ids(latest, ids)
    return latest.select(KEY, *[F.col(f"_newest.{name}").alias(name) for name in LATEST_COLUMNS])


def status_history(ledger, ids):
    """Every row of the given rules, newest first.

    The run id and rule id follow the time in the sort, so that rows of one instant
    can still be spread over partitions.
    """
    ids = id_frame(ledger.sparkSession, ids)
    return lookup_join(ledger, ids, "left_semi").orderBy(
        F.desc_nulls_first("created_dt"), F.desc("rule_run_id"), F.asc(KEY)
    )

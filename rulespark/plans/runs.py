"""Running rules: one, a set of them, and a whole run with its verdict."""

import logging
import re
import time
import uuid
from collections import namedtuple
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import datetime
from itertools import islice

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from ..model import RESULT_COLUMNS, RESULT_DATA_COLUMNS, RUNNABLE_RULE_SCHEMA, STARTED, SUCCESS
from ..operators import (
    categorize,
    exit_code,
    final_rows,
    latest_status,
    of_runs,
    rule_rows,
    rules_for_packages,
    started_rows,
    verdict,
    verdict_from_approvals,
    waiting_rules,
    with_run_ids,
)
from ..session import rule_session, written
from ..sources import Tables, append_status, read_ledger, read_results, result_path, write_results
from ..sources.commits import commit, exists
from .programs import check_date, handler_for, run_program
from .shared import SharedRules, can_share, shared_path

logger = logging.getLogger(__name__)

Outcome = namedtuple("Outcome", "rule_run_id rule_id succeeded path error")

_OUTCOME_ARROW = pa.schema([*((name, pa.string()) for name in RUNNABLE_RULE_SCHEMA.names), ("succeeded", pa.bool_())])
_SUMMARY_ARROW = pa.schema([("rules", pa.int64()), ("succeeded", pa.int64()), ("passes", pa.bool_()),
                            ("exit_code", pa.int32()), ("error", pa.string())])


@dataclass
class RunSettings:
    """What every rule of a run shares.

    ``results`` and ``ledger`` are folders on a file system that all executors reach.
    ``parallel`` rules have Spark jobs at a time. ``batch`` rules get their ledger
    rows in one write, so that a long run does not leave a file per row; an ended rule
    waits for the others no longer than about ``flush_seconds``. Each rule has
    a session of its own; with ``share_session`` the SQL rules use one together, so
    that tables of very many files are listed once. The tables named in ``persist``
    are kept by the executors for as long as the rules run; worth it for a table that
    several rules read and that fits. ``export(rows, rule)`` is called with the saved
    rows of each rule before its final status; if it fails, the rule has failed.
    """

    data_config: dict
    dictionary: dict
    as_of_date: str
    results: str
    ledger: str
    on_bad_value: str = "fail"
    parallel: int = 5
    batch: int = 100
    flush_seconds: float = 60
    share_session: bool = False
    one_plan: bool = False
    persist: tuple = ()
    export: callable = None
    runs: str = None
    clock: callable = field(default=datetime.now)


def stamp_results(rows, run_id, rule_id):
    """The six result columns as text; others are dropped, also the rule's own RULE_ID."""
    return rows.select(
        F.lit(run_id).alias(RESULT_COLUMNS[0]),
        F.lit(rule_id).alias(RESULT_COLUMNS[1]),
        *[F.col(name).cast("string").alias(name) for name in RESULT_DATA_COLUMNS],
    )


class _Tables:
    """The configured tables, for one rule after the other; each is read when a rule asks for it.

    A schema is read once. If a table to keep can't be read, each rule that uses it
    finds out by itself, and fails.
    """

    def __init__(self, spark, settings):
        self._spark, self._settings = spark, settings
        self._schemas, self._shared, self._kept = {}, None, []
        try:
            if settings.share_session:
                session = rule_session(spark)
                self._shared = session, self._load(session)
            if settings.persist:
                loaded = self._load(spark)
                self._kept = [loaded[name].persist() for name in settings.persist]
        except Exception as error:
            logger.warning("tables not prepared: %s", error)

    def _load(self, session):
        settings = self._settings
        return Tables(session, settings.data_config, settings.dictionary, settings.on_bad_value, self._schemas)

    def release(self):
        for table in self._kept:
            table.unpersist()

    def for_rule(self, rule):
        """A session and its tables. Only SQL rules may share one."""
        if self._shared and rule["program_type"].lower() == "sql":
            return self._shared
        session = rule_session(self._spark)
        return session, self._load(session)


def _execute(tables, rules, settings):
    """The outcomes of one rule, or of several that share a plan."""
    return _execute_one(tables, rules[0], settings) if len(rules) == 1 else _execute_shared(tables, rules, settings)


def _execute_one(tables, rule, settings):
    """Load, run, stamp, save and export. Whatever goes wrong in it is the rule's failure.

    So is a rule that calls ``sys.exit``: it ends itself, not the run.
    """
    run_id, rule_id = rule["rule_run_id"], rule["rule_id"]
    try:
        rows = run_program(*_program_arguments(tables, rule), settings.as_of_date)
        path = write_results(stamp_results(rows, run_id, rule_id), settings.results, rule_id, run_id)
        if settings.export:
            settings.export(read_results(rows.sparkSession, [path]), rule)
        return [Outcome(run_id, rule_id, True, path, None)]
    except KeyboardInterrupt:
        raise
    except BaseException as error:
        return [_failed(rule, error)]


def _failed(rule, error):
    logger.error("rule %s failed: %r", rule["rule_id"], error)
    return Outcome(rule["rule_run_id"], rule["rule_id"], False, None, str(error) or repr(error))


def _execute_shared(tables, rules, settings):
    """SQL rules in one plan; those that can't be, or that make it fail, by themselves."""
    try:
        session, loaded = tables.for_rule(rules[0])
        shared = SharedRules(session, loaded, settings.as_of_date)
        taken = {rule["rule_run_id"]: rule for rule in rules if shared.add(rule)}
    except Exception as error:
        logger.warning("rules run by themselves: %s", error)
        taken = {}
    outcomes = [outcome for rule in rules if rule["rule_run_id"] not in taken for outcome in _execute_one(tables, rule, settings)]
    for run_id, has_rows, error in shared.write_each(taken, settings.results) if taken else ():
        outcomes.append(_saved(session, taken[run_id], has_rows, error, settings))
    return outcomes


def _saved(session, rule, has_rows, error, settings):
    run_id, rule_id = rule["rule_run_id"], rule["rule_id"]
    path = shared_path(settings.results, rule_id, run_id) if has_rows else None
    try:
        if error:
            raise error
        if settings.export:
            settings.export(read_results(session, [path] if path else []), rule)
        return Outcome(run_id, rule_id, True, path, None)
    except KeyboardInterrupt:
        raise
    except BaseException as failure:
        return _failed(rule, failure)


def _groups(batch, settings):
    """What runs together: all rules of the batch that can share a plan, and each other rule."""
    together = [rule for rule in batch if settings.one_plan and can_share(rule)]
    ids = {rule["rule_run_id"] for rule in together}
    if len(ids) < len(together):  # a run id given twice can't name two folders
        together, ids = [], set()
    return ([together] if together else []) + [[rule] for rule in batch if rule["rule_run_id"] not in ids]


def _program_arguments(tables, rule):
    handler_for(rule["program_type"])
    session, loaded = tables.for_rule(rule)
    return session, rule, loaded


def _record(spark, rows, make, settings):
    """Append ledger rows for rules that are dicts of the driver."""
    frame = spark.createDataFrame(pa.Table.from_pylist(list(rows), _OUTCOME_ARROW))
    append_status(make(frame, settings.clock()).coalesce(1), settings.ledger)


def run_rule(spark, rule, settings):
    """One rule from start to ledger. ``rule`` is a dict of its columns and run id."""
    [outcome] = _run_all(spark, iter([rule]), settings)
    return outcome


class _Given:
    """A session and its tables, as a caller has them."""

    def __init__(self, session, tables):
        self._both = session, tables

    def for_rule(self, rule):
        return self._both


def run_over(session, rule, tables, settings):
    """One rule from start to ledger over tables of the caller's, which belong to ``session``.

    A run id may come again: its rows are replaced, and a run that has succeeded before isn't
    recorded a second time.
    """
    repeated = exists(session, result_path(settings.results, rule["rule_id"], rule["rule_run_id"]))
    if repeated:
        ended = of_runs(read_ledger(session, settings.ledger), [rule["rule_run_id"]])
        repeated = not ended.where(F.col("rule_execution_status") == SUCCESS).isEmpty()
    if not repeated:
        _record(session, [rule], started_rows, settings)
    [outcome] = _execute_one(_Given(session, tables), rule, settings)
    if not (repeated and outcome.succeeded):
        _record(session, [rule | {"succeeded": outcome.succeeded}], final_rows, settings)
    return outcome


def run_rules(spark, rules, settings):
    """Run every rule of a DataFrame with ``rule_run_id``; yield each outcome.

    They run while the outcomes are taken, up to the last one.
    A rule that fails does not stop the others; a ledger that cannot be written does.
    Rules come to the driver a batch at a time, since each is a program to start.
    """
    rows = rules.select(*RUNNABLE_RULE_SCHEMA.names).toLocalIterator(prefetchPartitions=True)
    return _run_all(spark, (row.asDict() for row in rows), settings)


def _run_all(spark, rules, settings):
    """Start rules as others end, and write ledger rows for many at a time."""
    execute = inheritable_thread_target(spark)(_execute)
    pool, tables = ThreadPoolExecutor(settings.parallel), None
    running, ended, written_at = {}, [], time.monotonic()
    try:
        while True:
            if len(running) < settings.parallel and (batch := list(islice(rules, settings.batch))):
                tables = tables or _Tables(spark, settings)
                _record(spark, batch, started_rows, settings)
                running |= {pool.submit(execute, tables, group, settings): group for group in _groups(batch, settings)}
            if not running:
                return
            for future in wait(running, max(1, settings.flush_seconds), FIRST_COMPLETED).done:
                ended += _with_rules(future.result(), running.pop(future))
            due = time.monotonic() - written_at > settings.flush_seconds
            if ended and (due or not running or len(ended) >= settings.batch):
                outcomes, rows = zip(*ended)
                ended, written_at = [], time.monotonic()
                _record(spark, rows, final_rows, settings)
                yield from outcomes
    finally:
        pool.shutdown(cancel_futures=True)
        if tables:
            tables.release()
        # Left early, by the one who takes the outcomes or by an error: what has ended is still written.
        for future, rules in running.items():
            if future.done() and not future.cancelled() and future.exception() is None:
                ended += _with_rules(future.result(), rules)
        if ended:
            _record(spark, [row for _, row in ended], final_rows, settings)


def _with_rules(outcomes, rules):
    """Each outcome with its rule, as a row that says how it ended."""
    if len(rules) == 1:
        return [(outcome, rules[0] | {"succeeded": outcome.succeeded}) for outcome in outcomes]
    by_run = {rule["rule_run_id"]: rule for rule in rules}
    return [(outcome, by_run[outcome.rule_run_id] | {"succeeded": outcome.succeeded}) for outcome in outcomes]


def by_latest_status(feed_map, resolve=None):
    """Judge a run by the latest ledger row of each of its rules.

    ``resolve`` may turn the waiting rules into rows of (rule_id, resolved), for
    example with ``streaming.wait_for_exceptions``; otherwise their latest row decides.
    """

    def judge(rules, ledger, begun):
        # Each rule has a row since the run began, so an older one is never its latest.
        recent = read_ledger(rules.sparkSession, ledger, since=begun)
        categories = categorize(latest_status(recent, rules), feed_map, rules)
        if resolve is None:
            return verdict(rules, categories)
        categories = written(categories, "categories")
        return verdict(rules, categories, resolve(waiting_rules(categories)))

    return judge


def by_approvals(approvals, timeout=None, every=60, whole_history=False):
    """Judge a run by the history of its approved rules: all of the run's rows.

    ``whole_history`` takes their rows of other runs as well. With a ``timeout``, as
    long as the run does not pass, the ledger is looked at again every ``every``
    seconds; exceptions may come in as rows or be set in rows that are there.
    """

    def judge(rules, ledger, begun):
        spark = rules.sparkSession
        deadline = time.monotonic() + (timeout.total_seconds() if timeout else 0)
        while True:
            rows = read_ledger(spark, ledger, None if whole_history else begun)
            found = verdict_from_approvals(rules, approvals, rows if whole_history else of_runs(rows, rules))
            left = deadline - time.monotonic()
            if left <= 0 or found.first().passes:
                return found
            time.sleep(min(every, left))

    return judge


def run(spark, catalog, feed_map, settings, module, stage, packages, feed_id=None, unmapped="keep", judge=None,
        token=None):
    """A whole run: choose the rules, run them, judge the ledger.

    Returns one row. No rules to run pass; a failed rule fails the run before the
    ledger is judged, by ``by_latest_status`` unless ``judge(rules, ledger, begun)``
    says otherwise, from the ledger's folder and the time the run began. An
    as-of date that is none raises; errors after that fail the run, and are named in
    its row. With ``settings.runs`` a run that breaks off can be resumed by its ``token``.
    """
    check_date(settings.as_of_date)
    token, begun = token or uuid.uuid4().hex, settings.clock()
    path = _frozen_path(settings, token)
    if path and exists(spark, path):
        raise ValueError(f"there is a run {token!r} already; resume it")

    def choose():
        rules = rules_for_packages(catalog, feed_map, module, stage, packages, feed_id, unmapped)
        # Those that run are those that are judged, whatever happens to the catalog in between.
        rules = with_run_ids(rule_rows(rules), token, begun).withColumn("begun", F.lit(begun).cast("timestamp"))
        if path is None:
            return written(rules, "chosen-rules")
        commit(rules, settings.runs, lambda: f"{TOKEN}={token}")
        return _frozen(spark, path)

    return _finish(spark, choose, begun, settings, judge or by_latest_status(feed_map))


TOKEN = "token"


def _frozen_path(settings, token):
    if settings.runs is None:
        return None
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", token) or token in (".", ".."):
        raise ValueError(f"{token!r} cannot name a run's folder")
    return f"{settings.runs.rstrip('/')}/{TOKEN}={token}"


def _frozen(spark, path):
    """The rules of a run, as they were when it began; there are all or none."""
    return spark.read.parquet(path)


def resume(spark, feed_map, settings, token, judge=None):
    """Go on with a run that broke off: run what has no final ledger row, then judge it all.

    The rules are those that the run has frozen under ``settings.runs``, with their run ids,
    so a rule that had begun replaces what it may have saved, and each rule has one final
    row in the end. Final rows of the ledger stand, also those of failures. A run that came to
    its end is only judged again. No other process may be at work on the run.
    """
    check_date(settings.as_of_date)
    path = _frozen_path(settings, token)
    if path is None or not exists(spark, path):
        raise ValueError(f"no run {token!r} is frozen in {settings.runs!r}")
    rules = _frozen(spark, path)
    first = rules.select("begun").first()
    begun = first.begun if first else settings.clock()
    return _finish(spark, lambda: rules, begun, settings, judge or by_latest_status(feed_map), _final(spark, rules, begun, settings))


def _final(spark, rules, begun, settings):
    """Run ids with their final rows: whether each succeeded. The ledger is read as it is now."""
    if not exists(spark, settings.ledger):
        return None
    ledger = of_runs(read_ledger(spark, settings.ledger, begun), rules)
    ended = ledger.where(~F.col("rule_execution_status").eqNullSafe(STARTED))
    return written(ended.groupBy("rule_run_id").agg(F.bool_and(F.col("rule_execution_status") == SUCCESS).alias("ended_well")), "final-rows")


def _finish(spark, choose, begun, settings, judge, final=None):
    """Run the rules that have no final row, and judge those and the others: a row of summary."""
    total = succeeded = 0
    error = None
    try:
        rules = to_run = choose()
        if final is not None:
            ended = final.agg(F.count(F.lit(1)).alias("n"), F.count_if("ended_well").alias("well")).first()
            total, succeeded = ended.n, ended.well
            to_run = rules.join(final, "rule_run_id", "left_anti")
        for outcome in run_rules(spark, to_run, settings):
            total += 1
            succeeded += outcome.succeeded
        passes = total == succeeded
        if total and passes:
            passes = judge(rules.drop("begun"), settings.ledger, begun).first().passes
    except Exception as failure:
        logger.exception("run failed")
        passes, error = False, str(failure)
    summary = {"rules": [total], "succeeded": [succeeded], "passes": [passes], "exit_code": [exit_code(passes)],
               "error": [error]}
    return spark.createDataFrame(pa.table(summary, _SUMMARY_ARROW))

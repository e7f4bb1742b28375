from datetime import timedelta

import pytest
from rows import at, feed_map, ids, ledger

from rulespark import operators as op

LATEST = [
    ("ok", "r", "Success", "No", "Retired", at(1)),
    ("passive", "r", "Failure", "No", "Passive", at(1)),
    ("waits", "r", "Failure", "No", "Active", at(1)),
    ("excepted", "r", "Started", "Yes", "Active", at(1)),
    ("unflagged", "r", None, None, "Active", at(1)),
    ("unmapped", "r", "Failure", "No", "Active", at(1)),
    ("retired", "r", "Failure", "Yes", "Retired", at(1)),
    ("no status", "r", "Failure", "Yes", None, at(1)),
]
MAPPED = [(name, "F9", "Yes") for name in ("ok", "passive", "waits", "excepted", "unflagged", "retired")]


@pytest.fixture
def categories(spark):
    mappings = feed_map(spark, *MAPPED, ("waits", "F1", "Yes"), ("unmapped", "F1", "No"))
    return op.categorize(op.latest_status(ledger(spark, *LATEST)), mappings)


def given(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "rule_id string")


def passes(spark, categories, *names, **more):
    return op.verdict(given(spark, *names), categories, **more).first().passes


def test_categories(categories):
    assert {row.rule_id: row.category for row in categories.collect()} == {
        "ok": "success", "passive": "passive", "waits": "waiting", "excepted": "waiting", "unflagged": "waiting",
        "unmapped": "unmapped", "retired": "none", "no status": "none"}
    assert ids(op.waiting_rules(categories)) == ["excepted", "unflagged", "waits"]


def test_exception_check(categories):
    checked = op.exception_check(op.waiting_rules(categories)).collect()
    assert {row.rule_id: row.resolved for row in checked} == {"waits": False, "excepted": True, "unflagged": False}


def test_verdict(spark, categories):
    assert passes(spark, categories, "ok", "passive", "unmapped", "excepted", "ok")
    assert not passes(spark, categories, "ok", "waits")
    assert not passes(spark, categories, "retired")
    assert not passes(spark, categories, "ok", None)


def test_rule_without_a_ledger_row_fails_unless_none_has_one(spark, categories):
    assert not passes(spark, categories, "ok", "absent")
    assert passes(spark, categories, "absent", "absent too")
    assert passes(spark, categories)
    row = op.verdict(given(spark, "ok", "absent", "absent"), categories).first()
    assert (row.given, row.in_ledger, row.passing) == (2, 1, 1)


def test_verdict_with_resolved_rules(spark, categories):
    resolved = spark.createDataFrame([("waits", True), ("excepted", False)], "rule_id string, resolved boolean")
    assert passes(spark, categories, "waits", "ok", resolved=resolved)
    assert not passes(spark, categories, "excepted", resolved=resolved)
    assert not passes(spark, categories, "unflagged", resolved=resolved)


def test_many_verdicts_at_once(spark, categories):
    rows = [("g1", "ok"), ("g1", "passive"), ("g2", "ok"), ("g2", "waits"), ("g3", "absent"), (None, "excepted")]
    groups = spark.createDataFrame(rows, "g string, rule_id string")
    verdicts = op.verdict(groups, categories, group_by=["g"])
    coded = verdicts.select("g", "passes", op.exit_code("passes").alias("code")).collect()
    assert {row.g: (row.passes, row.code) for row in coded} == {
        "g1": (True, 0), "g2": (False, 100), "g3": (True, 0), None: (True, 0)}


def test_exit_codes():
    assert [op.exit_code(True), op.exit_code(False)] == [0, 100]


START, TIMEOUT = at(12), timedelta(minutes=60)


def waits(name, *later):
    """A rule that waits at the start, and rows that come after."""
    return [(name, "r1", "Failure", "No", "Active", at(11)),
            *[(name, f"r{n}", status, flag, "Active", when) for n, (status, flag, when) in enumerate(later, 2)]]


def resolved_at(spark, rows, **more):
    mappings = feed_map(spark, *[(row[0], "F", "Yes") for row in rows])
    found = op.exceptions_in_time(ledger(spark, *rows), mappings, START, TIMEOUT, **more).collect()
    assert len(found) == len({row.rule_id for row in found})
    return {row.rule_id: row.resolved for row in found}


TIMED = [
    *waits("in time", ("Failure", "Yes", at(12, 30))), *waits("last moment", ("Failure", "Yes", at(13))),
    *waits("too late", ("Failure", "Yes", at(13, 1))), *waits("never"), *waits("refused", ("Failure", "No", at(12, 1))),
    *waits("success", ("Success", "No", at(12, 1))), *waits("at start", ("Started", "Yes", at(12))),
    *waits("twice", ("Failure", "Yes", at(12, 1)), ("Failure", "No", at(12, 2))),
    ("fine", "r1", "Success", "No", "Active", at(11)), ("later only", "r1", "Failure", "Yes", "Active", at(12, 5)),
    ("undated", "r1", "Failure", "Yes", "Active", at(11)), ("undated", "r2", "Failure", None, "Active", None),
]


def test_exceptions_in_time(spark):
    assert resolved_at(spark, TIMED) == {
        "in time": True, "last moment": True, "too late": False, "never": False, "refused": False, "success": False,
        "at start": True, "twice": True, "undated": False}
    assert resolved_at(spark, TIMED, ids=["never", "fine", "in time"]) == {"never": False, "in time": True}


def test_late_success_may_count(spark):
    assert resolved_at(spark, TIMED, accept_success=True)["success"]


def test_exceptions_feed_the_verdict(spark):
    rows = ledger(spark, *TIMED)
    mappings = feed_map(spark, *[(row[0], "F", "Yes") for row in TIMED])
    at_start = op.categorize(op.latest_status(rows.where("created_dt <= TIMESTAMP_NTZ '2024-01-01 12:00:00'")), mappings)
    resolved = op.exceptions_in_time(rows, mappings, START, TIMEOUT)
    assert passes(spark, at_start, "in time", "fine", "twice", resolved=resolved)
    assert not passes(spark, at_start, "in time", "too late", resolved=resolved)


def approvals(spark, *names):
    return spark.createDataFrame([(name, "Approved") for name in names] + [("not", "Pending")],
                                 "rule_id string, approval_status string")


def test_verdict_from_approvals(spark):
    rows = ledger(
        spark,
        ("good", "r1", "Success", "No", "Active", at(1)),
        ("again", "r1", "Success", "No", "Active", at(1)), ("again", "r0", "Success", "No", "Active", at(0)),
        ("bad", "r1", "Failure", "No", "Active", at(1)), ("waived", "r1", "Failure", "Yes", "Active", at(1)),
        ("waived", "r1", "Started", "Yes", "Active", at(0)), ("unclear", "r1", None, None, "Active", at(1)),
    )

    def decide(approved, *names):
        return op.verdict_from_approvals(given(spark, *names), approved, rows).first().passes

    all_of_them = approvals(spark, "good", "again", "bad", "waived", "unclear", "absent")
    assert decide(all_of_them, "good")
    assert decide(all_of_them, "again")                     # no pending row
    assert decide(all_of_them, "good", "waived")
    assert not decide(all_of_them, "good", "bad")
    assert not decide(all_of_them, "unclear")
    assert decide(all_of_them, "again", "bad")              # two successes for two rules
    assert decide(all_of_them, "absent")                    # nothing pending
    assert decide(approvals(spark), "bad")                  # nothing approved
    assert decide(approvals(spark, "good"), "good", "bad")
    assert not decide(None, "good", "bad")                  # no approvals table: all count
    assert decide(None)


def test_history_checks(spark):
    rows = ledger(spark, ("a", "r1", "Success", "No", "Active", at(1)), ("a", "r0", "Success", "No", "Active", at(0)),
                  ("b", "r1", "Failure", "No", "Active", at(1)))
    assert op.all_succeeded(given(spark, "a"), rows).first().passes is False
    assert op.all_succeeded(given(spark, "a", "b"), rows).first().passes is True
    assert op.exceptions_applied(given(spark, "a"), rows).first().passes is True
    assert op.exceptions_applied(given(spark, "a", "b"), rows).first().passes is False

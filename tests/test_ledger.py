import random
import re
from datetime import datetime, timedelta

from rows import at, catalog, ids, ledger, rule

from rulespark import operators as op
from rulespark.model import LEDGER_SCHEMA


def test_latest_row_per_rule(spark):
    rows = ledger(
        spark,
        ("newer", "r1", "Success", "No", "Active", at(1)), ("newer", "r2", "Failure", "No", "Active", at(2)),
        ("undated", "r1", "Success", "No", "Active", at(3)), ("undated", "r2", "Failure", None, "Active", None),
        ("tie", "r1", "Success", "No", "Active", at(1)), ("tie", "r2", "Failure", "No", "Active", at(1)),
        ("same run", "r1", "Success", "No", "Active", at(1)), ("same run", "r1", "Started", "No", "Active", at(1)),
    )
    latest = {row.rule_id: (row.rule_run_id, row.rule_execution_status) for row in op.latest_status(rows).collect()}
    assert latest == {"newer": ("r2", "Failure"), "undated": ("r2", "Failure"), "tie": ("r2", "Failure"),
                      "same run": ("r1", "Success")}
    assert ids(op.latest_status(rows, ["tie", "absent", "tie"])) == ["tie"]
    assert ids(op.latest_status(rows, [])) == []
    assert op.latest_status(rows, ["newer"], run_ids=["r1"]).first().rule_run_id == "r1"
    assert op.latest_status(ledger(spark)).count() == 0


def test_latest_row_against_brute_force(spark):
    draw = random.Random(3)
    rows = [(draw.choice("abcdefgh"), f"r{draw.randrange(30):02}", draw.choice(["Success", "Failure"]),
             draw.choice(["Yes", "No", None]), "Active", draw.choice([None, at(1), at(2), at(3)]))
            for _ in range(300)]
    rows = list({(row[0], row[1], row[5]): row for row in rows}.values())

    def age(row):
        return (row[5] is None, row[5] or datetime.min, row[1])

    expected = {name: max((row for row in rows if row[0] == name), key=age) for name in {row[0] for row in rows}}
    found = op.latest_status(ledger(spark, *rows)).collect()
    assert {row.rule_id: (row.rule_run_id, row.created_dt) for row in found} == {
        name: (row[1], row[5]) for name, row in expected.items()}


def test_history_is_newest_first(spark):
    rows = ledger(spark, ("a", "r1", "Success", "No", "Active", at(1)), ("a", "r2", "Success", "No", "Active", None),
                  ("b", "r3", "Success", "No", "Active", at(2)), ("c", "r4", "Success", "No", "Active", at(3)),
                  ("a", "r5", "Success", "No", "Active", at(2)))
    assert [row.rule_run_id for row in op.status_history(rows, ["a", "b"]).collect()] == ["r2", "r5", "r3", "r1"]
    assert op.status_history(rows, []).count() == 0


def test_ledger_rows(spark):
    now = datetime(2024, 3, 1, 23, 59)
    rules = op.with_run_ids(op.rule_rows(catalog(spark, rule("a"), rule("b"))), token="t", now=now)
    started = op.started_rows(rules, now)
    assert started.schema.names == LEDGER_SCHEMA.names
    row = started.where("rule_id = 'a'").first()
    assert (row.rule_execution_status, row.workflow_status, row.exception_applied, row.action) == (
        "Started", "In Progress", "No", "")
    assert (row.execution_date, row.processing_date, row.created_dt) == ("2024-03-01", "2024-03-01", now)
    outcomes = rules.selectExpr("*", "CASE WHEN rule_id = 'a' THEN true END AS succeeded")
    final = {row.rule_id: (row.rule_execution_status, row.workflow_status)
             for row in op.final_rows(outcomes, now).collect()}
    assert final == {"a": ("Success", "Completed"), "b": ("Failure", "Failed")}
    today = datetime.now()
    assert abs(op.started_rows(rules).first().created_dt - today) < timedelta(minutes=5)


def test_run_ids(spark):
    rules = catalog(spark, *[rule(str(number)) for number in range(50)], rule("0", slg="w"))
    now = datetime(2024, 3, 1)

    def made(**arguments):
        return [row.rule_run_id for row in op.with_run_ids(rules, **arguments).orderBy("rule_id", "slg").collect()]

    first = made(token="t", now=now)
    assert len(set(first)) == 51
    assert all(re.fullmatch(rf"[0-9a-f]{{10}}_{int(now.timestamp())}", run_id) for run_id in first)
    assert made(token="t", now=now) == first
    assert not set(made(token="u", now=now)) & set(first)
    assert not set(made()) & set(made())

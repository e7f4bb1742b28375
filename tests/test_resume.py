"""Runs that break off and are resumed."""

import pytest
from pyspark.sql import functions as F
from rows import catalog, feed_map, program, rule
from test_rules import CONFIG, GOOD, TYPES, settings, write  # noqa: F401

from rulespark import plans, sources

NAMES = [f"r{n}" for n in range(7)]


@pytest.fixture
def rules(spark, write):  # noqa: F811
    path = write("good.sql", GOOD)
    return catalog(spark, *[rule(name, program_code=path, program_type="SQL") for name in NAMES])


def breaking(settings, after):  # noqa: F811
    """Settings whose export stops the process at a rule, and the rules that were exported."""
    seen = []

    def export(rows, of):
        seen.append(of["rule_id"])
        if len(seen) > after:
            raise KeyboardInterrupt

    settings.export, settings.parallel = export, 1
    return seen


def counted(spark, settings):  # noqa: F811
    ledger = sources.read_ledger(spark, settings.ledger)
    rows = ledger.groupBy("rule_id").agg(
        F.count_if(F.col("workflow_status") == "Completed").alias("completed"), F.count_if(F.col("workflow_status") == "Failed").alias("failed"),
        F.count_distinct("rule_run_id").alias("runs")).collect()
    return {row.rule_id: (row.completed, row.failed, row.runs) for row in rows}


def run(spark, rules, settings, token="t1", **options):  # noqa: F811
    chosen = rules.first()
    return plans.run(spark, rules, feed_map(spark), settings, chosen.module, chosen.stage, [chosen.package], token=token, **options)


@pytest.mark.parametrize("after", [0, 1, 4])
def test_the_rest_runs_and_each_rule_ends_once(spark, rules, settings, folder, after):  # noqa: F811
    settings.runs = folder("runs")
    seen = breaking(settings, after)
    with pytest.raises(KeyboardInterrupt):
        run(spark, rules, settings)
    before = {name for name, (completed, _, _) in counted(spark, settings).items() if completed}
    assert len(before) < len(NAMES)
    settings.export = lambda rows, of: seen.append(of["rule_id"])
    del seen[:]
    summary = plans.resume(spark, feed_map(spark), settings, "t1").first()
    assert (summary.rules, summary.succeeded, summary.passes, summary.error) == (7, 7, True, None)
    assert sorted(seen) == sorted(set(NAMES) - before)
    assert counted(spark, settings) == {name: (1, 0, 1) for name in NAMES}
    assert plans.resume(spark, feed_map(spark), settings, "t1").first() == summary  # nothing is left to run
    assert counted(spark, settings) == {name: (1, 0, 1) for name in NAMES}


def test_a_changed_catalog_makes_no_difference(spark, rules, settings, folder, write):  # noqa: F811
    settings.runs = folder("runs")
    breaking(settings, 2)
    with pytest.raises(KeyboardInterrupt):
        run(spark, rules, settings)
    settings.export = None
    assert plans.resume(spark, feed_map(spark, *[(name, "F", "No") for name in NAMES]), settings, "t1").first().rules == 7


def test_failures_stand(spark, settings, folder, write):  # noqa: F811
    settings.runs = folder("runs")
    good, bad = write("good.sql", GOOD), write("bad.sql", "SELECT nothing")
    rules = catalog(spark, *[rule(name, program_code=bad if name == "r0" else good, program_type="SQL") for name in NAMES])
    breaking(settings, 3)
    with pytest.raises(KeyboardInterrupt):
        run(spark, rules, settings)
    write("bad.sql", GOOD)
    settings.export = None
    was_final = counted(spark, settings)["r0"][1] == 1
    summary = plans.resume(spark, feed_map(spark), settings, "t1").first()
    assert (summary.rules, summary.succeeded, summary.exit_code) == ((7, 6, 100) if was_final else (7, 7, 0))


def test_tokens(spark, rules, settings, folder):  # noqa: F811
    with pytest.raises(ValueError, match="no run"):
        plans.resume(spark, feed_map(spark), settings, "t1")
    settings.runs = folder("runs")
    with pytest.raises(ValueError, match="no run"):
        plans.resume(spark, feed_map(spark), settings, "t1")
    with pytest.raises(ValueError, match="cannot name"):
        run(spark, rules, settings, token="a/b")
    assert run(spark, rules, settings).first().passes
    with pytest.raises(ValueError, match="already"):
        run(spark, rules, settings)
    assert run(spark, rules, settings, token=None).first().passes

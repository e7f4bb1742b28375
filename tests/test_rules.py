import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from rows import RULE_TYPES, feed_map, program, rule

from rulespark import find_table, operators as op
from rulespark import plans, rule_session, sources, stream_session, streaming
from rulespark.model import RUNNABLE_RULE_SCHEMA
from rulespark.plans import RunSettings

NATION = "/root/testdata/sf0.001/nation.parquet"
CONFIG = {"tables": [{"logicalName": "nation", "path": NATION, "kind": {"RAW": "parquet"}}]}
TYPES = {"tables": [{"logicalName": "nation", "schema": {"RAW": [{"name": "n_nationkey", "dataType": "string"}]}}]}
GOOD = "SELECT n_name AS HEADER_DATA, n_nationkey AS COL1, '${as_of_date}' AS COL2, 4.50 AS COL3, 1 AS extra, 'x' AS rule_id FROM nation;"


@pytest.fixture
def settings(folder):
    ticks = iter(range(10_000))
    return RunSettings(CONFIG, TYPES, "20240131", folder("results"), folder("ledger"), parallel=3, batch=2,
                       clock=lambda: datetime(2024, 2, 1) + timedelta(seconds=next(ticks)))


@pytest.fixture
def write(tmp_path):
    def save(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)
    return save


def run_sql(spark, text, date="20240131"):
    return plans.run_sql_rule(spark, text, date)


def test_date_is_put_in_both_ways(spark):
    row = run_sql(spark, "SELECT '${as_of_date}' AS a, to_date(:as_of_date, 'yyyyMMdd') AS b").first()
    assert (row.a, str(row.b)) == ("20240131", "2024-01-31")


@pytest.mark.parametrize("date", ["2024-01-31", "20240230", "'; x", "", "２０２４０１３１"])
def test_date_must_be_eight_digits_of_a_date(spark, date):
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT 1", date)


def test_other_marks_are_refused(spark):
    with pytest.raises(ValueError, match=r"\$\{as_of_date\}"):
        run_sql(spark, "SELECT '${run_date}'")


def test_one_statement_only(spark):
    assert run_sql(spark, "SELECT 1;").count() == 1
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        run_sql(spark, "SELECT 1; SELECT 2")


def test_views_and_settings_of_rule_sessions(spark, setting):
    setting(spark__sql__ansi__enabled="false")
    first, second = rule_session(spark), rule_session(spark)
    assert first.conf.get("spark.sql.ansi.enabled") == "false"
    assert first.conf.get("spark.sql.session.timeZone") == "UTC"
    first.range(1).createOrReplaceTempView("mine")
    assert not second.catalog.tableExists("mine") and not spark.catalog.tableExists("mine")
    first.conf.set("spark.sql.shuffle.partitions", "3")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_python_rule_sees_its_four_names(spark):
    text = "result_df = spark.createDataFrame([(rule_id, as_of_date, sorted(dataframes)[0])], 'a string, b string, c string')"
    rows = plans.run_python_rule(spark, text, {"t": spark.range(1)}, "20240131", "R7").collect()
    assert tuple(rows[0]) == ("R7", "20240131", "t")
    with pytest.raises(ValueError, match="result_df"):
        plans.run_python_rule(spark, "x = 1", {}, "20240131", "R7")


def test_registered_function_is_a_python_rule(spark):
    @plans.python_rule("test.count")
    def count(spark, dataframes, as_of_date, rule_id):
        return dataframes["t"].agg(F.count(F.lit(1)).alias("n"))

    assert plans.run_python_rule(spark, "test.count", {"t": spark.range(3)}, "20240131", "R").first().n == 3


def test_program_types(spark):
    assert plans.program_types()[:2] == ["python", "sql"]
    for name in ("JAVA", "", None):
        with pytest.raises(ValueError, match="unsupported program type"):
            plans.handler_for(name)
    plans.register_program_type("Table", lambda session, rule, tables, as_of_date: tables[rule["program_code"]])
    assert "table" in plans.program_types()
    rule_row = {"rule_id": "R", "program_type": "TABLE", "program_code": "t"}
    assert plans.run_program(spark, rule_row, {"t": spark.range(2)}, "20240131").count() == 2


def test_stamped_rows_are_six_text_columns(spark):
    rows = spark.sql("SELECT 1.5 AS col1, 'h' AS header_data, true AS Col2, NULL AS col3, 'mine' AS RULE_ID, 9 AS more")
    stamped = plans.stamp_results(rows, "run", "R")
    assert stamped.dtypes == [(name, "string") for name in
                              ("RULE_RUN_ID", "RULE_ID", "HEADER_DATA", "COL1", "COL2", "COL3")]
    assert tuple(stamped.first()) == ("run", "R", "h", "1.5", "true", None)
    with pytest.raises(AnalysisException):
        plans.stamp_results(rows.drop("col3"), "run", "R")


def ledger_states(spark, settings):
    rows = sources.read_ledger(spark, settings.ledger).collect()
    return sorted((row.rule_run_id, row.rule_execution_status, row.workflow_status) for row in rows)


def test_one_rule(spark, settings, write):
    outcome = plans.run_rule(spark, program(spark, "R", write("r.sql", GOOD)), settings)
    assert outcome.succeeded and outcome.path == f"{settings.results}/R/run_R"
    row = sources.read_results(spark, [outcome.path]).where("COL1 = '3'").first()
    assert tuple(row) == ("run_R", "R", "NATION_3", "3", "20240131", "4.50")
    assert ledger_states(spark, settings) == [("run_R", "Started", "In Progress"), ("run_R", "Success", "Completed")]


@pytest.mark.parametrize("share", [False, True])
def test_failures_of_all_kinds_stop_no_other_rule(spark, settings, write, share):
    settings.share_session = share
    rules = [
        program(spark, "parse", write("a.sql", "SELEC 1")),
        program(spark, "compute", write("b.sql", GOOD.replace("4.50", "CAST(n_name AS INT)"))),
        program(spark, "shape", write("c.sql", "SELECT 1 AS HEADER_DATA")),
        program(spark, "absent", "/nowhere/rule.sql"),
        program(spark, "java", write("d.sql", GOOD), program_type="JAVA"),
        program(spark, "raises", write("e.py", "raise KeyError('no')"), program_type="python"),
        program(spark, "a/b", write("f.sql", GOOD)),
        program(spark, "good", write("g.sql", GOOD), program_type="Sql"),
        program(spark, "good too", write("h.py", "result_df = spark.sql('SELECT n_name HEADER_DATA, 1 COL1, 2 COL2, 3 COL3 FROM nation')"),
                program_type="PYTHON"),
    ]
    frame = spark.createDataFrame([tuple(row.values()) for row in rules], RUNNABLE_RULE_SCHEMA)
    outcomes = {outcome.rule_id: outcome for outcome in plans.run_rules(spark, frame, settings)}
    assert {name for name, outcome in outcomes.items() if outcome.succeeded} == {"good", "good too"}
    assert all(outcome.error for outcome in outcomes.values() if not outcome.succeeded)
    states = ledger_states(spark, settings)
    assert len(states) == 18
    assert {state[0] for state in states if state[1] == "Failure"} == {
        f"run_{row['rule_id']}" for row in rules if not row["rule_id"].startswith("good")}
    latest = op.latest_status(sources.read_ledger(spark, settings.ledger)).collect()
    assert "Started" not in {row.rule_execution_status for row in latest}


@pytest.mark.parametrize("prepared", [{}, {"share_session": True}, {"persist": ("t",)}])
def test_missing_table_is_each_rules_failure(spark, settings, write, prepared):
    for name, value in prepared.items():
        setattr(settings, name, value)
    settings.data_config = {"tables": [{"logicalName": "t", "path": "/nowhere", "kind": {}}]}
    outcome = plans.run_rule(spark, program(spark, "R", write("r.sql", GOOD)), settings)
    assert not outcome.succeeded and "PATH_NOT_FOUND" in outcome.error


def test_slow_rule_holds_up_no_other(spark, settings, write):
    """Two of three slots go on while a rule sleeps; ended rules are in the ledger meanwhile."""
    settings.flush_seconds = 0
    seen = []

    @plans.python_rule("test.slow")
    def slow(spark, dataframes, as_of_date, rule_id):
        deadline = time.monotonic() + 60
        while len(seen) < 5 and time.monotonic() < deadline:
            time.sleep(0.2)
        return spark.sql("SELECT '' HEADER_DATA, '' COL1, '' COL2, '' COL3")

    rules = [program(spark, "slow", "test.slow", program_type="python")]
    rules += [program(spark, f"quick{n}", write("q.sql", GOOD)) for n in range(5)]
    frame = spark.createDataFrame([tuple(row.values()) for row in rules], RUNNABLE_RULE_SCHEMA).coalesce(1)
    for outcome in plans.run_rules(spark, frame, settings):
        seen.append(outcome.rule_id)
    assert len(seen) == 6 and seen[-1] == "slow"
    assert len(ledger_states(spark, settings)) == 12


def test_ledger_that_cannot_be_written_stops_the_run(spark, settings, write, tmp_path):
    settings.ledger = write("file", "not a folder") + "/ledger"
    with pytest.raises(Exception):
        plans.run_rule(spark, program(spark, "R", write("r.sql", GOOD)), settings)


def catalog_of(spark, *rows):
    return spark.createDataFrame(list(rows), RULE_TYPES)


def summary(spark, rules, settings, packages, mappings=(), **more):
    row = plans.run(spark, rules, feed_map(spark, *mappings), settings, "M", "S", packages, **more).first()
    return row.rules, row.succeeded, row.passes, row.exit_code


def test_run(spark, settings, write):
    good = {"program_type": "SQL", "program_code": write("r.sql", GOOD)}
    bad = {"program_type": "SQL", "program_code": "/nowhere"}
    rules = catalog_of(spark, rule("a", **good), rule("b", **good, package="Q"), rule("c", **bad, package="R"))
    assert summary(spark, rules, settings, ["P", "Q", "P"]) == (3, 3, True, 0)
    assert summary(spark, rules, settings, ["nothing"]) == (0, 0, True, 0)
    assert summary(spark, rules, settings, ["P", "R"]) == (2, 1, False, 100)
    assert sources.read_ledger(spark, settings.ledger).count() == 10
    with pytest.raises(ValueError):
        settings.as_of_date = "tomorrow"
        summary(spark, rules, settings, ["P"])


def test_run_with_a_feed(spark, settings, write):
    good = {"program_type": "SQL", "program_code": write("r.sql", GOOD)}
    rules = catalog_of(spark, rule("a", **good), rule("b", **good), rule("c", **good))
    mappings = [("a", "F1", "Yes"), ("b", "F2", "Yes")]
    assert summary(spark, rules, settings, ["P"], mappings, feed_id="F1") == (2, 2, True, 0)


def test_run_judges_the_latest_row_and_may_wait(spark, settings, write):
    """Another writer adds a newer failed row, which only an exception can cure."""
    good = {"program_type": "SQL", "program_code": write("r.sql", GOOD)}
    rules = catalog_of(spark, rule("a", **good))
    failed = op.with_run_ids(op.rule_rows(rules)).withColumn("succeeded", F.lit(False))
    sources.append_status(op.final_rows(failed, datetime(2024, 2, 2)), settings.ledger)
    mapped = [("a", "F1", "Yes")]
    assert summary(spark, rules, settings, ["P"], mapped) == (1, 1, False, 100)
    asked = []

    def resolve(waiting):
        asked.extend(row.rule_id for row in waiting.collect())
        return waiting.selectExpr("rule_id", "true AS resolved")

    assert summary(spark, rules, settings, ["P"], mapped,
                   judge=plans.by_latest_status(feed_map(spark, *mapped), resolve)) == (1, 1, True, 0)
    assert asked == ["a"]
    assert summary(spark, rules, settings, ["P"], []) == (1, 1, True, 0)      # nothing mapped: no wait


def test_run_waits_for_exceptions_on_the_ledgers_own_stream(spark, settings, write, folder):
    """While the run waits, an exception comes in for the rule that another writer failed."""
    rules = catalog_of(spark, rule("a", program_type="SQL", program_code=write("r.sql", GOOD)))
    rows = op.with_run_ids(op.rule_rows(rules), token="other").withColumn("succeeded", F.lit(False))
    sources.append_status(op.final_rows(rows, datetime(2024, 2, 2)), settings.ledger)

    def resolve(waiting):
        excepted = op.final_rows(rows, datetime(2024, 2, 3)).withColumn("exception_applied", F.lit("Yes"))
        sources.append_status(excepted, settings.ledger)
        ledger = sources.ledger_stream(stream_session(spark), settings.ledger)
        return streaming.wait_for_exceptions(waiting, ledger, folder("looks"), folder("state"), timedelta(minutes=2), 1)

    mapped = feed_map(spark, ("a", "F1", "Yes"))
    row = plans.run(spark, rules, mapped, settings, "M", "S", ["P"], judge=plans.by_latest_status(mapped, resolve)).first()
    assert (row.passes, row.error) == (True, None)


def test_run_judged_by_approvals(spark, settings, write):
    rules = catalog_of(spark, rule("a", program_type="SQL", program_code=write("r.sql", GOOD)))
    failed = op.with_run_ids(op.rule_rows(rules)).withColumn("succeeded", F.lit(False))
    for day in (2, 3):
        sources.append_status(op.final_rows(failed, datetime(2024, 2, day)), settings.ledger)

    def approved(*names, **options):
        frame = spark.createDataFrame([(name, "Approved") for name in names], "rule_id string, approval_status string")
        return plans.by_approvals(frame, **options)

    assert summary(spark, rules, settings, ["P"], judge=approved()) == (1, 1, True, 0)
    assert summary(spark, rules, settings, ["P"], judge=approved("a", whole_history=True)) == (1, 1, False, 100)
    for _ in range(2):  # a run is judged by its own rows
        assert summary(spark, rules, settings, ["P"], judge=approved("a")) == (1, 1, True, 0)


def test_approvals_are_waited_for(spark, settings, write, monkeypatch):
    """The history counts, and while the run waits an exception is set in the row that failed."""
    rules = catalog_of(spark, rule("a", program_type="SQL", program_code=write("r.sql", GOOD)))
    failed = op.with_run_ids(op.rule_rows(rules), token="t").withColumn("succeeded", F.lit(False))
    approvals = spark.createDataFrame([("a", "Approved")], "rule_id string, approval_status string")
    for name in ("before", "after"):
        sources.append_status(op.final_rows(failed, datetime(2024, 2, 2)).withColumn(
            "exception_applied", F.lit("No" if name == "before" else "Yes")), f"{settings.ledger}-{name}")
    given = failed.select("rule_id", "rule_run_id")
    from rulespark.plans import runs

    read, looks = runs.read_ledger, []

    def look(session, path, since=None):
        looks.append(1)
        return read(session, f"{settings.ledger}-{'before' if len(looks) < 3 else 'after'}", since)

    monkeypatch.setattr(runs, "read_ledger", look)
    judge = plans.by_approvals(approvals, timeout=timedelta(seconds=60), every=0.1, whole_history=True)
    assert judge(given, settings.ledger, datetime(2024, 2, 1)).first().passes and len(looks) >= 3


def test_no_rule_ends_the_run(spark, settings, write):
    """A rule that calls sys.exit has failed; the others, and the ledger, go on."""
    leaves = write("leaves.py", "import sys; sys.exit(0)")
    rules = catalog_of(
        spark, rule("a", program_type="SQL", program_code=write("r.sql", GOOD)), rule("b", program_type="Python", program_code=leaves))
    assert summary(spark, rules, settings, ["P"]) == (2, 1, False, 100)
    ended = {row.rule_id: row.rule_execution_status for row in sources.read_ledger(spark, settings.ledger).collect()
             if row.workflow_status != "In Progress"}
    assert ended == {"a": "Success", "b": "Failure"}


def test_ended_rules_are_written_when_a_run_is_left(spark, settings, write):
    good = program(spark, "a", write("r.sql", GOOD))
    settings.batch, settings.flush_seconds = 2, 0
    rules = spark.createDataFrame([tuple(good.values()), tuple((good | {"rule_id": "b", "rule_run_id": "run_b"}).values())], RUNNABLE_RULE_SCHEMA)
    outcomes = plans.run_rules(spark, rules.coalesce(1), settings)
    next(outcomes)
    outcomes.close()
    ended = [row.rule_id for row in sources.read_ledger(spark, settings.ledger).collect() if row.workflow_status == "Completed"]
    assert sorted(ended) == ["a", "b"]


def test_failing_export_fails_the_rule(spark, settings, write):
    seen = []

    def export(rows, rule_row):
        seen.append((rule_row["rule_id"], rows.count()))
        if rule_row["rule_id"] == "b":
            raise OSError("no way out")

    settings.export = export
    outcomes = [plans.run_rule(spark, program(spark, name, write("r.sql", GOOD)), settings) for name in ("a", "b")]
    assert [outcome.succeeded for outcome in outcomes] == [True, False] and "no way out" in outcomes[1].error
    assert [name for name, _ in seen] == ["a", "b"]


def test_only_tables_that_rules_name_are_read(spark, settings, write, monkeypatch):
    from rulespark.sources import files

    read, paths = files.read_table, []
    monkeypatch.setattr(files, "read_table", lambda session, kind, path, schema=None: paths.append(path) or read(session, kind, path, schema))
    tables = settings.data_config["tables"]
    many = [tables[0] | {"logicalName": f"unused{place}", "path": f"/nowhere/{place}"} for place in range(8)]
    settings.data_config = {"tables": [*tables, *many]}
    assert plans.run_rule(spark, program(spark, "a", write("r.sql", GOOD)), settings).succeeded
    python = write("r.py", f"result_df = dataframes['{tables[0]['logicalName']}'].selectExpr(\"'h' AS HEADER_DATA\", \"'1' AS COL1\", \"'2' AS COL2\", \"'3' AS COL3\")")
    assert plans.run_rule(spark, program(spark, "b", python, program_type="Python"), settings).succeeded
    assert paths and not any(path.startswith("/nowhere") for path in paths)


def test_kept_tables_are_read_from_memory_and_released(spark, settings, write):
    settings.persist = ("nation",)
    seen = []

    def look(session, rule_row, tables, as_of_date):
        rows = session.sql("SELECT n_name AS HEADER_DATA, n_nationkey AS COL1, '' AS COL2, '' AS COL3 FROM nation")
        seen.append("InMemoryTableScan" in rows._jdf.queryExecution().executedPlan().toString())
        return rows

    plans.register_program_type("look", look)
    assert plans.run_rule(spark, program(spark, "R", "", program_type="Look"), settings).succeeded
    settings.persist = ()
    assert plans.run_rule(spark, program(spark, "R", "", program_type="Look"), settings).succeeded
    assert seen == [True, False]


def test_run_reports_errors_of_its_tables(spark, settings):
    broken = spark.sql("SELECT 1 AS rule_id")
    row = plans.run(spark, broken, broken, settings, "M", "S", ["P"]).first()
    assert (row.passes, row.exit_code) == (False, 100) and row.error
    assert find_table(CONFIG, "nation")


def test_programs_of_any_file_system(spark, folder):
    path = folder("program")
    spark.createDataFrame([("SELECT 1 AS a,\n 2 AS b",)], "value string").coalesce(1).write.text(path)
    assert plans.programs.program_text(spark, f"file://{path}").split() == "SELECT 1 AS a, 2 AS b".split()

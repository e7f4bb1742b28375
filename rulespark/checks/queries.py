"""One query per operator, each over whole tables."""

import os
import sys
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from .. import functions as fn
from .. import operators as op
from .. import plans, sources, streaming
from ..model import FAILURE, LEDGER_SCHEMA, RESULT_COLUMNS, RULE_COLUMNS, RULE_TEXT_COLUMNS, RUNNABLE_RULE_SCHEMA, SUCCESS
from ..session import rule_session, stream_session, work_folder, written
from .fixtures import table, view

AS_OF_DATE = "20010701"
MODULE, STAGE, PACKAGE, FEED = "M1", "S2", "Brand#4", "F2"
PACKAGES = [f"Brand#{n}" for n in range(1, 26)] + ["Brand#4"]
NOW = datetime(2024, 3, 1, 12, 30)
START, TIMEOUT = datetime(1999, 1, 1), timedelta(days=60)
GROUPS = ("package", "slg")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

PROGRAMS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "programs")
SQL_RULES = ("neg_balance", "orphan_line", "stale_order", "region_total", "first_event", "key_overlap")
PYTHON_RULES = ("big_discount", "user_gap")


def program_path(name):
    return os.path.join(PROGRAMS, f"{name}.{'py' if name in PYTHON_RULES else 'sql'}")


def program(name):
    with open(program_path(name), encoding="utf-8") as source:
        return source.read()


def data_config(sf_dir, names=TABLES):
    return {"tables": [
        {"logicalName": name, "path": f"{sf_dir}/{name}.parquet", "kind": {"RAW": "PARQUET"}} for name in names
    ]}


def dictionary(name, **types):
    columns = [{"name": column, "dataType": type_name} for column, type_name in types.items()]
    return {"tables": [{"logicalName": name, "schema": {"RAW": columns}}]}


# Sources and casts


def a1_parquet(spark, sf_dir):
    return sources.read_table(spark, "PARQUET", f"{sf_dir}/orders.parquet")


def _round_trip(spark, df, file_format, path):
    df.write.format(file_format).option("header", "true").save(path)
    return sources.read_table(spark, file_format.upper(), path)


def a3_csv(spark, sf_dir):
    read = _round_trip(spark, table(spark, sf_dir, "customer"), "csv", work_folder(spark, "csv"))
    types = dictionary("customer", c_custkey="integer", c_nationkey="integer", c_acctbal="double")
    return sources.apply_dictionary(read, types["tables"][0]["schema"]["RAW"])


def a4_orc(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "orders"), "orc", work_folder(spark, "orc"))


def a4_json(spark, sf_dir):
    read = _round_trip(spark, table(spark, sf_dir, "customer"), "json", work_folder(spark, "json"))
    return read.select("c_custkey", "c_name", F.col("c_nationkey").cast("int"), "c_acctbal", "c_mktsegment")


def a6_load(spark, sf_dir):
    tables = sources.load_tables(spark, data_config(sf_dir), dictionary("customer", c_custkey="string"))
    counts = [
        loaded.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, loaded in tables.items()
    ]
    combined = counts[0]
    for count in counts[1:]:
        combined = combined.unionByName(count)
    return combined


_RAW_TYPES = [
    {"name": "custkey", "dataType": "Integer"}, {"name": "acctbal", "dataType": "double"},
    {"name": "asof", "dataType": "date"}, {"name": "segment"}, {"name": "absent", "dataType": "date"},
    {"name": "nationkey", "dataType": "decimal"},
]


def a7_cast(spark, sf_dir):
    return sources.apply_dictionary(view(spark, sf_dir, "fx_raw_csv"), _RAW_TYPES)


def a7_cast_bad_values(spark, sf_dir):
    types = [{"name": "nationkey", "dataType": "integer"}, {"name": "acctbal", "dataType": "double"}]
    return sources.apply_dictionary(view(spark, sf_dir, "fx_raw_csv"), types, on_bad_value="null")


def a7_count_bad_values(spark, sf_dir):
    types = [{"name": name, "dataType": "integer"} for name in ("custkey", "nationkey", "segment")]
    return sources.count_bad_values(view(spark, sf_dir, "fx_raw_csv"), types)


_CHECKED_TYPES = [{"name": name, "dataType": "integer"} for name in ("custkey", "nationkey", "segment")]


def a7_observed(spark, sf_dir):
    """The counts of a7_count_bad_values, as the one pass that casts and writes has seen them."""
    checked = sources.set_bad_rows_aside(view(spark, sf_dir, "fx_raw_csv"), _CHECKED_TYPES, work_folder(spark, "checked"))
    return spark.createDataFrame(list(checked.bad_values.items()), "column string, bad_values bigint")


def a7_set_aside(spark, sf_dir):
    """Rows that fit, cast, beside those that don't, as they were."""
    types = [{"name": "nationkey", "dataType": "integer"}, {"name": "acctbal", "dataType": "double"}]
    checked = sources.set_bad_rows_aside(view(spark, sf_dir, "fx_raw_csv"), types, work_folder(spark, "checked"))
    good = checked.good.select("custkey", F.col("nationkey").cast("string"), F.lit("").alias("bad_columns"))
    return good.unionByName(checked.set_aside.select("custkey", "nationkey", F.array_join("bad_columns", ",").alias("bad_columns")))


BOUND_QUERY = """
SELECT DISTINCT p_partkey, p_name, p_brand
FROM part JOIN lineitem ON p_partkey = l_partkey
WHERE l_returnflag = :flag AND p_size IN (:small, :large)"""
BOUND_VALUES = {"flag": "A", "small": 5, "large": 45}


def a10_bound_query(spark, sf_dir):
    return sources.execute_query(spark, BOUND_QUERY, BOUND_VALUES, data_config(sf_dir, ("part", "lineitem")))


# Rule selection


def _rules_and_map(spark, sf_dir):
    return view(spark, sf_dir, "fx_rules"), view(spark, sf_dir, "fx_feed_map")


def b1_select_rules(spark, sf_dir):
    return op.select_rules(view(spark, sf_dir, "fx_rules"), MODULE, STAGE, PACKAGE)


def b2_mapped_rules(spark, sf_dir):
    return op.mapped_rules(*_rules_and_map(spark, sf_dir), MODULE, STAGE, PACKAGE, FEED)


def b3_unmapped_rules(spark, sf_dir):
    return op.unmapped_rules(*_rules_and_map(spark, sf_dir), MODULE, STAGE, PACKAGE)


def b4_rules_for_feed(spark, sf_dir):
    return op.rules_for_feed(*_rules_and_map(spark, sf_dir), MODULE, STAGE, PACKAGE, FEED)


def _requests(spark, sf_dir):
    """Every module, stage and package of the catalog, for each of six feeds and for none."""
    feeds = F.array(*[F.lit(f"F{n}") for n in range(6)], F.lit(None).cast("string"))
    places = view(spark, sf_dir, "fx_rules").select("module", "stage", "package").distinct()
    requests = places.select("*", F.explode(feeds).alias("feed_id"))
    return requests.select(F.concat_ws("/", "module", "stage", "package", "feed_id").alias("request_id"), "*")


def b4_rules_for_requests(spark, sf_dir):
    return op.rules_for_requests(*_rules_and_map(spark, sf_dir), _requests(spark, sf_dir))


def b5_rules_for_packages(spark, sf_dir):
    return op.rules_for_packages(*_rules_and_map(spark, sf_dir), MODULE, STAGE, PACKAGES, FEED)


def b7_rule_rows(spark, sf_dir):
    return op.rule_rows(view(spark, sf_dir, "fx_rules").distinct())


def b8_has_feed_mapping(spark, sf_dir):
    rules, feed_map = _rules_and_map(spark, sf_dir)
    return op.has_feed_mapping(rules, feed_map)


def b9_approved_rules(spark, sf_dir):
    return op.approved_rules(_applicable(spark, sf_dir), view(spark, sf_dir, "fx_approvals"))


# Rule execution


def _sql_rule(name):
    def query(spark, sf_dir):
        rule = {"rule_id": name, "program_type": "SQL", "program_code": program_path(name)}
        session = rule_session(spark)
        return plans.run_program(session, rule, sources.load_tables(session, data_config(sf_dir), {}), AS_OF_DATE)
    return query


def _python_rule(name):
    def query(spark, sf_dir):
        tables = sources.load_tables(spark, data_config(sf_dir), {})
        return plans.run_python_rule(spark, program(name), tables, AS_OF_DATE, name)
    return query


DATED_QUERY = """
SELECT o_orderstatus, COUNT(*) AS orders_before FROM orders
WHERE CAST(o_orderdate AS DATE) < to_date(:as_of_date, 'yyyyMMdd') GROUP BY o_orderstatus"""


def c3_as_of_date(spark, sf_dir):
    session = rule_session(spark)
    table(session, sf_dir, "orders").createOrReplaceTempView("orders")
    return plans.run_sql_rule(session, DATED_QUERY, AS_OF_DATE)


def c5_program_types(spark, sf_dir):
    rules = view(spark, sf_dir, "fx_rules")
    counts = rules.groupBy("program_type").agg(F.count(F.lit(1)).alias("rules"))
    chosen = {kind: _handler_name(kind) for kind, in counts.select("program_type").collect()}
    handlers = spark.createDataFrame(list(chosen.items()), "program_type string, handler string")
    return counts.join(handlers, "program_type").groupBy("handler").agg(F.sum("rules").alias("rules"))


def _handler_name(kind):
    """The registered name whose handler is chosen for a kind of program."""
    try:
        handler = plans.handler_for(kind)
    except ValueError:
        return "rejected"
    [name] = [name for name in plans.program_types() if plans.handler_for(name) is handler]
    return name


def _stamped(spark, sf_dir, name):
    return plans.stamp_results(_sql_rule(name)(spark, sf_dir), f"run_{name}", name)


def c6_result_rows(spark, sf_dir):
    return _stamped(spark, sf_dir, "neg_balance")


def _settings(spark, sf_dir):
    return plans.RunSettings(
        data_config=data_config(sf_dir),
        dictionary={},
        as_of_date=AS_OF_DATE,
        results=work_folder(spark, "results"),
        ledger=work_folder(spark, "ledger"),
    )


def _program_rule(name, package="ours", **changes):
    rule = dict.fromkeys(RUNNABLE_RULE_SCHEMA.names, "")
    rule |= {
        "rule_run_id": f"run_{name}", "rule_id": name, "rule_name": name, "rule_status": "Active",
        "module": MODULE, "stage": STAGE, "package": package, "program_code": program_path(name),
        "program_type": "Python" if name in PYTHON_RULES else "SQL",
    }
    return rule | changes


def c7_run_rule(spark, sf_dir):
    settings = _settings(spark, sf_dir)
    outcome = plans.run_rule(spark, _program_rule("stale_order"), settings)
    saved = sources.read_results(spark, [outcome.path]).groupBy(F.col("RULE_ID").alias("rule_id")).agg(
        F.count(F.lit(1)).alias("result_rows")
    )
    ledger = sources.read_ledger(spark, settings.ledger)
    return ledger.join(saved, "rule_id", "left").select(
        "rule_run_id", "rule_id", "rule_execution_status", "workflow_status", "exception_applied", "result_rows"
    )


def c7_export(spark, sf_dir):
    """A rule whose saved rows are sent on to files before its final status."""
    settings, exported = _settings(spark, sf_dir), work_folder(spark, "exported")
    settings.export = lambda rows, rule: rows.write.parquet(f"{exported}/{rule['rule_id']}")
    plans.run_rule(spark, _program_rule("stale_order"), settings)
    return sources.read_results(spark, [f"{exported}/stale_order"])


def c8_run_rules(spark, sf_dir):
    rows = [_program_rule(name) for name in SQL_RULES + PYTHON_RULES]
    rules = spark.createDataFrame([tuple(row.values()) for row in rows], RUNNABLE_RULE_SCHEMA)
    outcomes = list(plans.run_rules(spark, rules, _settings(spark, sf_dir)))
    return sources.read_results(spark, [outcome.path for outcome in outcomes if outcome.succeeded])


def c8_shared(spark, sf_dir):
    """The rules of c8_run_rules, the SQL ones in one plan, with one that fails as it runs and one that can't be resolved."""
    bad = {"bad_text": "SELECT nothing FROM nowhere", "bad_value": (
        "SELECT o_orderstatus AS HEADER_DATA, CAST(CAST(o_orderstatus AS INT) AS STRING) AS COL1, '' AS COL2, '' AS COL3 FROM orders")}
    rows = [_program_rule(name) for name in SQL_RULES + PYTHON_RULES]
    for name, text in bad.items():
        path = f"{work_folder(spark, 'programs')}/{name}.sql"
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
        rows.append(_program_rule(name, program_code=path if "://" in path else f"file://{path}" if path.startswith("/") else path))
    rules = spark.createDataFrame([tuple(row.values()) for row in rows], RUNNABLE_RULE_SCHEMA)
    settings = _settings(spark, sf_dir)
    settings.one_plan = True
    outcomes = list(plans.run_rules(spark, rules, settings))
    if sorted(outcome.rule_id for outcome in outcomes if not outcome.succeeded) != sorted(bad):
        raise ValueError(f"other rules failed: {outcomes}")
    return sources.read_results(spark, [outcome.path for outcome in outcomes if outcome.succeeded])


# Sinks


def d1_result_files(spark, sf_dir):
    path = sources.write_results(_stamped(spark, sf_dir, "stale_order"), work_folder(spark, "results"),
                                 "stale_order", "run_stale_order")
    return sources.read_results(spark, [path])


def _applicable(spark, sf_dir):
    rules = view(spark, sf_dir, "fx_rules")
    return rules.where(F.col("rule_status").isin("Active", "Passive")).select("rule_id", *GROUPS).distinct()


def _runnable(spark, sf_dir):
    rules = op.rule_rows(op.rules_for_packages(*_rules_and_map(spark, sf_dir), MODULE, STAGE, PACKAGES, FEED))
    return rules.withColumn("rule_run_id", F.concat("rule_id", F.lit("_"), F.col("package_position")))


def _readable(ledger):
    return ledger.withColumn("created_dt", F.date_format("created_dt", "yyyy-MM-dd HH:mm:ss"))


def _finished(spark, sf_dir):
    supported = F.lower("program_type").isin(plans.program_types())
    return _runnable(spark, sf_dir).withColumn("succeeded", supported)


def d3_ledger_append(spark, sf_dir):
    path = work_folder(spark, "ledger")
    sources.append_status(op.started_rows(_runnable(spark, sf_dir), NOW), path)
    sources.append_status(op.final_rows(_finished(spark, sf_dir), NOW + timedelta(minutes=5)), path)
    return _readable(sources.read_ledger(spark, path))


def d3_appends_at_once(spark, sf_dir):
    """The ledger in parts, appended by several writers at a time."""
    parts, path, ledger = 12, work_folder(spark, "ledger"), _ledger_with_zone(spark, sf_dir)
    others = {name: F.lit("") for name in LEDGER_SCHEMA.names if name not in ledger.columns}
    rows = ledger.withColumns(others)

    def append(part):
        sources.append_status(rows.where(F.pmod(F.xxhash64("rule_run_id"), F.lit(parts)) == part), path)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(append, range(parts)))
    back = F.col("created_dt").cast("timestamp_ntz").alias("created_dt")
    return sources.read_ledger(spark, path).select(*(back if name == "created_dt" else name for name in ledger.columns))


def d4_result_append(spark, sf_dir):
    debt = F.create_map(F.lit("col3"), F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
    data = F.map_concat(
        F.create_map(F.lit("header_data"), F.lit("customer|segment"), F.lit("col1"), F.col("c_name")),
        F.when(F.col("c_acctbal") < 0, debt).otherwise(F.expr("cast(map() as map<string, string>)")),
    )
    entries = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("run_"), F.col("c_custkey")).alias("rule_run_id"),
        F.col("c_mktsegment").alias("rule_id"),
        data.alias("data"),
    )
    path = work_folder(spark, "result-rows")
    sources.append_results(entries, path)
    return sources.read_results(spark, [path])


# Status ledger


def e1_started_rows(spark, sf_dir):
    return _readable(op.started_rows(_runnable(spark, sf_dir), NOW))


def e2_final_rows(spark, sf_dir):
    return _readable(op.final_rows(_finished(spark, sf_dir), NOW))


def e4_latest_status(spark, sf_dir):
    return op.latest_status(view(spark, sf_dir, "fx_status"), _applicable(spark, sf_dir))


def e5_status_history(spark, sf_dir):
    history = op.status_history(view(spark, sf_dir, "fx_status"), _applicable(spark, sf_dir))
    return history.select("rule_id", "rule_run_id", "rule_execution_status", "exception_applied", "created_dt")


def e6_run_id(spark, sf_dir):
    rules = op.with_run_ids(_runnable(spark, sf_dir).drop("rule_run_id"), now=NOW)
    shaped = F.col("rule_run_id").rlike("^[0-9a-f]{10}_[0-9]{9,}$")
    return rules.agg(F.count(F.lit(1)).alias("rules"), F.count_if(shaped).alias("shaped"),
                     F.count_distinct("rule_run_id").alias("distinct_ids"))


#: Rows in a file that a stream reads, and rows that come in for each partition of its state.
FILE_ROWS, STATE_ROWS = 1_000_000, 4_000_000


def _many(rows, each, least):
    return max(least, -(-rows.count() // each))


def _stream_of(session, rows, purpose, files=4, batches=2):
    """The rows as a stream over files that Spark wrote, as many of them in each micro-batch.

    There are more than ``files`` of them if they would grow too large for a task.
    """
    path, files = work_folder(session, purpose), _many(rows, FILE_ROWS, files)
    rows.repartition(files).write.parquet(path)
    return path, session.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(path)


def _session_for(spark, rows):
    """A session for a stream of the rows whose partitions of state don't grow with them: as many for each core."""
    cores = spark.sparkContext.defaultParallelism
    return stream_session(spark, cores * _many(rows, STATE_ROWS * cores, 1))


def _ledger_with_zone(spark, sf_dir):
    return view(spark, sf_dir, "fx_status").withColumn("created_dt", F.col("created_dt").cast("timestamp"))


def e8_latest_stream(spark, sf_dir):
    rows = _ledger_with_zone(spark, sf_dir)
    _, ledger = _stream_of(_session_for(spark, rows), rows, "ledger-stream")
    folder = work_folder(spark, "latest")
    state, compacted = work_folder(spark, "latest-state"), work_folder(spark, "latest-compacted")
    streaming.write_latest(ledger, folder, state, availableNow=True).awaitTermination()
    streaming.compact_latest(spark, folder, compacted)
    # Nothing is new; the stream goes on in the compacted folder.
    streaming.write_latest(ledger, compacted, state, availableNow=True).awaitTermination()
    folder = compacted
    latest = streaming.read_latest(spark, folder)
    return latest.withColumn("created_dt", F.col("created_dt").cast("timestamp_ntz"))


# Run verdict


def _categories(spark, sf_dir):
    ids = _applicable(spark, sf_dir)
    return op.categorize(op.latest_status(view(spark, sf_dir, "fx_status"), ids), view(spark, sf_dir, "fx_feed_map"), ids)


def f2_categories(spark, sf_dir):
    return _categories(spark, sf_dir).select("rule_id", "category")


def f3_waiting_rules(spark, sf_dir):
    return op.waiting_rules(_categories(spark, sf_dir)).select("rule_id")


def f4_exception_check(spark, sf_dir):
    waiting = op.waiting_rules(_categories(spark, sf_dir))
    return op.exception_check(waiting).select("rule_id", "resolved")


def _verdicts(spark, sf_dir):
    return op.verdict(_applicable(spark, sf_dir), _categories(spark, sf_dir), group_by=GROUPS)


def f1_empty_ledger(spark, sf_dir):
    return _verdicts(spark, sf_dir).where("in_ledger = 0").select(*GROUPS, "given", "passes")


def f5_verdict(spark, sf_dir):
    return _verdicts(spark, sf_dir)


def f6_exceptions_in_time(spark, sf_dir):
    return op.exceptions_in_time(view(spark, sf_dir, "fx_status"), view(spark, sf_dir, "fx_feed_map"), START, TIMEOUT)


def f5_stream(spark, sf_dir):
    """The verdict followed over a ledger stream, which is broken off and goes on, and folded at every second batch."""
    rows = _ledger_with_zone(spark, sf_dir)
    _, ledger = _stream_of(_session_for(spark, rows), rows, "verdict-stream", files=6, batches=3)
    given, feed_map = _applicable(spark, sf_dir), view(spark, sf_dir, "fx_feed_map")
    folder, state = work_folder(spark, "verdicts"), work_folder(spark, "verdicts-state")
    for _ in range(2):
        streaming.write_verdicts(ledger, given, feed_map, folder, state, GROUPS, fold=2, availableNow=True).awaitTermination()
    return streaming.read_verdicts(spark, given, folder, GROUPS, fold=2)


def _waiting_at_start(spark, sf_dir):
    ledger, feed_map = view(spark, sf_dir, "fx_status"), view(spark, sf_dir, "fx_feed_map")
    seen = F.col("created_dt").isNull() | (F.col("created_dt") <= F.lit(str(START)).cast("timestamp_ntz"))
    waiting = op.waiting_rules(op.categorize(op.latest_status(ledger.where(seen)), feed_map))
    return written(streaming.waiting_at(waiting, START), "waiting")  # counted and read again


def _late_row(rows, **values):
    values = {name: F.lit(values.get(name)).cast(kind).alias(name) for name, kind in rows.dtypes}
    return rows.sparkSession.range(1).select(*values.values())


def f6_stream(spark, sf_dir):
    waiting = _waiting_at_start(spark, sf_dir)
    ledger = _ledger_with_zone(spark, sf_dir)
    session = stream_session(spark)
    waiting_path, waiting_stream = _stream_of(session, waiting, "waiting-stream", files=2)
    ledger_path, ledger_stream = _stream_of(session, ledger, "ledger-stream")
    folder, state = work_folder(spark, "matches"), work_folder(spark, "matches-state")
    ids = session.read.parquet(waiting_path)
    matches = streaming.exception_matches(waiting_stream, ledger_stream, TIMEOUT, ids=ids)

    def drain():
        streaming.write_matches(matches, folder, state, availableNow=True).awaitTermination()

    drain()
    # A later row on both inputs moves the watermark over every deadline; its own wait stays open.
    later = str(START + 40 * TIMEOUT)
    _late_row(waiting, rule_id="-", started_at=later, at_start=False).write.mode("append").parquet(waiting_path)
    _late_row(ledger, rule_id="-", rule_run_id="-", created_dt=later).write.mode("append").parquet(ledger_path)
    drain()
    return streaming.read_resolved(spark, folder).select("rule_id", "resolved")


def f6_timers(spark, sf_dir):
    """The same waits with a timer each; rows come in no order, ten years of them, so as late as that."""
    waiting, ledger = _waiting_at_start(spark, sf_dir), _ledger_with_zone(spark, sf_dir)
    session = _session_for(spark, ledger)
    waiting_path, waiting_stream = _stream_of(session, waiting, "waiting-stream", files=2)
    ledger_path, ledger_stream = _stream_of(session, ledger, "ledger-stream")
    folder, state = work_folder(spark, "decided"), work_folder(spark, "decided-state")
    ends = streaming.exception_timers(waiting_stream, ledger_stream, TIMEOUT, "4000 days", ids=session.read.parquet(waiting_path))

    def drain():
        streaming.write_matches(ends, folder, state, availableNow=True).awaitTermination()

    drain()
    later = str(START + timedelta(days=8000))  # the clock passes every deadline, by a row of the ledger alone
    _late_row(ledger, rule_id="-", rule_run_id="-", created_dt=later).write.mode("append").parquet(ledger_path)
    drain()
    return spark.read.schema(streaming.DECIDED).parquet(folder).select("rule_id", "resolved")


def f6_wait(spark, sf_dir):
    """A wait over a ledger that has rows up to the end of the time, in one look."""
    ledger, feed_map = view(spark, sf_dir, "fx_status"), view(spark, sf_dir, "fx_feed_map")
    begin, end = (F.lit(str(moment)).cast("timestamp_ntz") for moment in (START, START + TIMEOUT))
    undated = F.col("created_dt").isNull()
    latest = op.latest_status(ledger.where(undated | (F.col("created_dt") <= begin)))
    waiting = op.waiting_rules(op.categorize(latest, feed_map))
    rows = _ledger_with_zone(spark, sf_dir).where(undated | (F.col("created_dt") <= end.cast("timestamp")))
    path, session = work_folder(spark, "wait-stream"), stream_session(spark)
    rows.write.parquet(path)
    stream = session.readStream.schema(rows.schema).parquet(path)
    return streaming.wait_for_exceptions(waiting, stream, work_folder(spark, "looks"), work_folder(spark, "state"), timedelta(seconds=1))


def f7_all_succeeded_v1(spark, sf_dir):
    return op.all_succeeded(_applicable(spark, sf_dir), view(spark, sf_dir, "fx_status"), GROUPS)


def f8_exceptions_applied_v1(spark, sf_dir):
    return op.exceptions_applied(_applicable(spark, sf_dir), view(spark, sf_dir, "fx_status"), GROUPS)


def f9_verdict_v1(spark, sf_dir):
    return op.verdict_from_approvals(_applicable(spark, sf_dir), view(spark, sf_dir, "fx_approvals"),
                                     view(spark, sf_dir, "fx_status"), GROUPS)


def f9_verdict_of_run(spark, sf_dir):
    """Two runs with one ledger, each judged by its own rows of the approved rules."""
    rows = [_program_rule(name) for name in SQL_RULES + PYTHON_RULES]
    catalog = spark.createDataFrame([tuple(row.values()) for row in rows], RUNNABLE_RULE_SCHEMA).select(*RULE_COLUMNS)
    approved = catalog.select("rule_id", F.lit("Approved").alias("approval_status"))
    approvals = view(spark, sf_dir, "fx_approvals").unionByName(approved)
    settings, runs = _settings(spark, sf_dir), None
    for number in (1, 2):
        summary = plans.run(spark, catalog, view(spark, sf_dir, "fx_feed_map"), settings, MODULE, STAGE, ["ours"], FEED,
                            judge=plans.by_approvals(approvals))
        summary = summary.select(F.lit(number).alias("run"), "rules", "succeeded", "passes", "exit_code")
        runs = runs.unionByName(summary) if runs else summary
    saved = spark.read.parquet(f"{settings.results}/*/*").agg(F.count(F.lit(1)).alias("result_rows"))
    return runs.withColumn("result_rows", F.lit(saved.first()[0]))


def f10_exit_code(spark, sf_dir):
    return _verdicts(spark, sf_dir).select(*GROUPS, op.exit_code("passes").alias("exit_code"))


def f11_run(spark, sf_dir):
    """Runs over one catalog: all rules good, one bad, one that would end the process, and no rules."""
    bad = _program_rule("bad_cast", package="theirs", program_type="Python", program_code="rulespark.bad_cast")
    rows = [_program_rule(name) for name in SQL_RULES + PYTHON_RULES]
    leaving = _program_rule("leaves", package="leaving", program_type="Python", program_code="rulespark.leaves")
    rows += [_program_rule("neg_balance", package="theirs"), bad, _program_rule("neg_balance", package="leaving"), leaving]
    catalog = spark.createDataFrame([tuple(row.values()) for row in rows], RUNNABLE_RULE_SCHEMA)
    settings = _settings(spark, sf_dir)
    runs = None
    for package in ("ours", "theirs", "leaving", "nobody's"):
        summary = plans.run(spark, catalog.select(*RULE_COLUMNS), view(spark, sf_dir, "fx_feed_map"), settings,
                            MODULE, STAGE, [package], FEED)
        summary = summary.select(F.lit(package).alias("package"), "rules", "succeeded", "passes", "exit_code")
        runs = runs.unionByName(summary) if runs else summary
    ledger = sources.read_ledger(spark, settings.ledger)
    saved = spark.read.parquet(f"{settings.results}/*/*").groupBy(F.col("RULE_RUN_ID").alias("rule_run_id")).agg(
        F.count(F.lit(1)).alias("result_rows"))
    per_package = ledger.where(F.col("workflow_status") != "In Progress").join(saved, "rule_run_id", "left").groupBy(
        "package").agg(F.sum("result_rows").alias("result_rows"),
                       F.count_if(F.col("rule_execution_status") == FAILURE).alias("failures"))
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("result_rows", "failures")]
    return runs.join(per_package, "package", "left").select(*runs.columns, *counts)


def f11_resume(spark, sf_dir):
    """A run that is broken off after three rules and resumed: each rule's final and result rows."""
    rows = [_program_rule(name) for name in SQL_RULES + PYTHON_RULES]
    catalog = spark.createDataFrame([tuple(row.values()) for row in rows], RUNNABLE_RULE_SCHEMA).select(*RULE_COLUMNS)
    feed_map, settings, ended = view(spark, sf_dir, "fx_feed_map"), _settings(spark, sf_dir), []

    def break_off(rows, rule):
        ended.append(rule["rule_id"])
        if len(ended) > 3:
            raise KeyboardInterrupt

    settings.runs, settings.batch, settings.parallel, settings.export = work_folder(spark, "runs"), 2, 1, break_off
    try:
        plans.run(spark, catalog, feed_map, settings, MODULE, STAGE, ["ours"], FEED, token="broken-off")
    except KeyboardInterrupt:
        settings.export = None
    summary = plans.resume(spark, feed_map, settings, "broken-off").select("rules", "succeeded", "passes")
    final = sources.read_ledger(spark, settings.ledger).where("workflow_status <> 'In Progress'")
    final = final.groupBy("rule_id").agg(F.count(F.lit(1)).alias("final_rows"))
    saved = spark.read.parquet(f"{settings.results}/*/*").groupBy(F.col("RULE_ID").alias("rule_id")).agg(F.count(F.lit(1)).alias("result_rows"))
    values = summary.first().asDict()
    ids = catalog.select("rule_id", *[F.lit(value).alias(name) for name, value in values.items()])
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("final_rows", "result_rows")]
    return ids.join(final, "rule_id", "left").join(saved, "rule_id", "left").select(*ids.columns, *counts)


@plans.python_rule("rulespark.bad_cast")
def _bad_cast(spark, dataframes, as_of_date, rule_id):
    """A rule that fails only when its rows are computed."""
    name = F.col("c_name")
    return dataframes["customer"].select(
        name.alias("HEADER_DATA"), F.assert_true(name.isNull()).cast("string").alias("COL1"),
        name.alias("COL2"), name.alias("COL3"))


@plans.python_rule("rulespark.leaves")
def _leaves(spark, dataframes, as_of_date, rule_id):
    """A rule that tries to end the process, as a success."""
    sys.exit(0)


# Functions


def g1_case(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"))


def g2_replace(spark, sf_dir):
    replaced = F.replace(F.col("text"), F.lit("a"), F.lit("${b}"))
    return table(spark, sf_dir, "documents").select("doc_id", replaced.alias("replaced"))


def g5_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.date_text("o_orderdate").alias("as_text"),
        fn.text_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("as_date"),
        F.col("o_orderdate").cast("date").cast("string").alias("cast_text"),
    )


def g7_arithmetic(spark, sf_dir):
    huge = F.lit(9223372036854775000).alias("huge")
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", huge)
    return line.select(
        "l_orderkey",
        fn.add("l_orderkey", "l_partkey").alias("added"),
        fn.subtract("l_orderkey", "l_suppkey").alias("subtracted"),
        fn.multiply("l_partkey", "l_suppkey").alias("multiplied"),
        fn.add("huge", "l_partkey", on_overflow="null").cast("string").alias("added_or_null"),
    )


# Rules over streams


def h_stream_rule(spark, sf_dir):
    """A rule over the customers as they come in, some files at a time: its rows in the end."""
    session = stream_session(spark)
    settings, rule = _settings(spark, sf_dir), _program_rule("neg_balance")
    _, stream = _stream_of(session, table(spark, sf_dir, "customer"), "customer-stream", files=6)
    streaming.write_rule(rule, stream, "customer", settings, work_folder(spark, "rule-state"), availableNow=True).awaitTermination()
    ended = sources.read_ledger(spark, settings.ledger).where(F.col("rule_execution_status") == SUCCESS)
    paths = [sources.result_path(settings.results, row.rule_id, row.rule_run_id) for row in ended.select("rule_id", "rule_run_id").collect()]
    return sources.read_results(spark, paths).drop("RULE_RUN_ID")


def all_queries():
    """Every check by its key."""
    found = {name: query for name, query in globals().items()
             if len(name) > 2 and name[0] in "abcdefg" and name[1].isdigit() and callable(query)}
    found["h_stream_rule"] = h_stream_rule
    found |= {f"c1_{name}": _sql_rule(name) for name in SQL_RULES}
    found |= {f"c4_{name}": _python_rule(name) for name in PYTHON_RULES}
    return dict(sorted(found.items()))

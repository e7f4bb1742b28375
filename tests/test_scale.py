"""The shape of plans: what is pushed down, shuffled, split and read how often."""

import re

import pytest
from pyspark.sql import functions as F

from rulespark import operators as op
from rulespark.checks.fixtures import view
from rulespark.checks.queries import all_queries
from rulespark.model import RULE_COLUMNS

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")


@pytest.fixture
def splits_early(setting, no_broadcast):
    """Thresholds low enough for a test's data."""
    setting(spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
            spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
            spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Rule tables as files; one rule holds a third of the ledger, of the map and of the catalog."""
    base = str(tmp_path_factory.mktemp("skewed"))
    number = F.col("id")
    key = F.when(number % 3 == 0, "hot").otherwise((number % 3001).cast("string")).alias("rule_id")
    ledger = spark.range(0, 300_000, 1, 8).select(
        key, F.sha2(number.cast("string"), 256).alias("rule_run_id"),
        F.when(number % 5 == 0, "Success").otherwise("Failure").alias("rule_execution_status"),
        F.when(number % 7 == 0, "Yes").otherwise("No").alias("exception_applied"), F.lit("Active").alias("rule_status"),
        F.timestamp_seconds(1_700_000_000 + number % 5000).cast("timestamp_ntz").alias("created_dt"))
    feed_map = spark.range(0, 60_000, 1, 4).select(
        key, F.concat(F.lit("F"), number % 5).alias("feed_id"),
        F.when(number % 2 == 0, "Yes").otherwise("No").alias("rule_applicable_status"))
    fixed = {"rule_status": F.lit("Active"), "module": F.lit("M"), "stage": F.lit("S"), "package": F.lit("P"),
             "rule_id": key, "rule_name": F.sha2(number.cast("string"), 512)}
    catalog = spark.range(0, 60_000, 1, 8).select(
        *[fixed.get(name, F.lit("v")).alias(name) for name in RULE_COLUMNS])
    for name, table in {"ledger": ledger, "map": feed_map, "catalog": catalog}.items():
        table.write.parquet(f"{base}/{name}")
    return lambda name: spark.read.parquet(f"{base}/{name}")


def ids_of(files):
    return files("ledger").select("rule_id").where("rule_id <> '17'")


def test_history_of_a_hot_rule_is_split(files, splits_early):
    history = op.status_history(files("ledger"), ids_of(files))
    assert history.count() == files("ledger").where("rule_id <> '17'").count()
    unsorted = history.drop("created_dt")
    unsorted.collect()
    assert "skew=true" in plan(unsorted)


@pytest.mark.parametrize("choose", [
    lambda files: op.rules_for_feed(files("catalog"), files("map"), "M", "S", "P", "F1"),
    lambda files: op.mapped_rules(files("catalog"), files("map"), "M", "S", "P", "F1"),
    lambda files: op.rules_for_packages(files("catalog"), files("map"), "M", "S", ["P", "P"], "F1"),
])
def test_selection_of_a_hot_rule_is_split(files, splits_early, setting, choose):
    chosen = choose(files)
    split = sorted(map(tuple, chosen.collect()))
    assert "skew=true" in plan(chosen)
    setting(spark__sql__adaptive__skewJoin__enabled="false")
    whole = choose(files)
    assert sorted(map(tuple, whole.collect())) == split and "skew=true" not in plan(whole)


def test_latest_row_is_reduced_before_its_shuffle(files, no_broadcast):
    text = plan(op.latest_status(files("ledger"), ids_of(files)))
    assert text.index("LeftSemi") < text.index("Exchange") < text.index("partial_max")
    assert "Window" not in text and text.count("Exchange") == 2


def test_few_ids_filter_the_ledger_before_it_is_reduced(files, spark):
    text = plan(op.latest_status(files("ledger"), ["1", "2"]))
    assert text.index("partial_max") < text.index("BroadcastHashJoin")


def test_categories_shuffle_each_table_once(files, no_broadcast):
    text = plan(op.categorize(op.latest_status(files("ledger")), files("map")))
    assert text.count("Exchange") == 2 and text.count("FileScan") == 2


def test_exceptions_read_the_ledger_once(files, no_broadcast):
    from datetime import datetime, timedelta

    found = op.exceptions_in_time(files("ledger"), files("map"), datetime(2023, 11, 14, 23), timedelta(minutes=9))
    text = plan(found)
    assert text.count("FileScan") == 2 and text.count("Exchange") == 2
    assert "PushedFilters: [Or(" in text or "DataFilters: [(isnull(created_dt" in text


def test_catalog_filters_and_columns_reach_the_scan(files, setting):
    setting(spark__sql__maxMetadataStringLength="10000")
    text = plan(op.select_rules(files("catalog"), "M", "S", "P"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("EqualTo(module,M)", "EqualTo(stage,S)", "package", "rule_status"):
        assert part in pushed
    assert "ReadSchema: struct<rule_id:string>" in plan(ids_of(files).distinct())
    text = plan(op.has_feed_mapping(["1"], files("map")))
    assert "ReadSchema: struct<rule_id:string,rule_applicable_status:string>" in text


def test_hot_rule_in_every_answer(files):
    """The hot rule's answers, against plain counting."""
    latest = op.latest_status(files("ledger"), ["hot"]).first()
    hot = files("ledger").where("rule_id = 'hot'")
    newest = hot.orderBy(F.desc("created_dt"), F.desc("rule_run_id")).first()
    assert latest.rule_run_id == newest.rule_run_id
    assert op.status_history(files("ledger"), ["hot"]).count() == hot.count() == 100_000
    categories = op.categorize(op.latest_status(files("ledger")), files("map"))
    verdict = op.verdict(ids_of(files), categories).first()
    assert verdict.given == verdict.in_ledger == files("ledger").select("rule_id").distinct().count() - 1


RUN_IN_PLACE = ("a3", "a4", "c7", "c8", "d", "e8", "f11", "f6_stream", "f6_wait", "f9_verdict_of_run")


@pytest.mark.parametrize("name", [name for name in all_queries() if not name.startswith(RUN_IN_PLACE)])
def test_no_query_pairs_all_rows(spark, no_broadcast, name):
    text = plan(all_queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "PythonUDF" not in text and "EvalPython" not in text


def test_rules_never_cross_the_driver(spark):
    """A chain of operators is one plan, without a job until its action."""
    tracker = spark.sparkContext.statusTracker()
    rules, mappings = view(spark, SMALL, "fx_rules"), view(spark, SMALL, "fx_feed_map")
    ledger = view(spark, SMALL, "fx_status")
    spark.sparkContext.setJobGroup("lazy", "no job")
    chosen = op.with_run_ids(op.rule_rows(op.rules_for_packages(rules, mappings, "M1", "S2", ["Brand#4"], "F2")))
    op.verdict(chosen, op.categorize(op.latest_status(ledger, chosen), mappings))
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

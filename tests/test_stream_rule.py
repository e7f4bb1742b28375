"""A rule over a table that grows."""

import os

import pytest
from rows import program
from test_rules import CONFIG, TYPES, settings, write  # noqa: F401

from rulespark import sources, streaming

TEXT = """SELECT 'item' AS HEADER_DATA, CAST(id AS STRING) AS COL1, n_name AS COL2, '${as_of_date}' AS COL3
FROM items JOIN nation ON nation = CAST(n_nationkey AS INT) WHERE id % 2 = 0"""


@pytest.fixture
def items(spark, folder):
    path, state = folder("items"), folder("state")

    def add(*ids):
        spark.createDataFrame([(number, number % 3) for number in ids], "id int, nation int").coalesce(1).write.mode("append").parquet(path)

    def follow(rule, settings):  # noqa: F811
        stream = spark.readStream.schema("id int, nation int").option("maxFilesPerTrigger", 1).parquet(path)
        streaming.write_rule(rule, stream, "items", settings, state, availableNow=True).awaitTermination()
        ledger = sources.read_ledger(spark, settings.ledger).collect()
        ended = sorted((row.rule_run_id, row.rule_execution_status) for row in ledger if row.rule_execution_status != "Started")
        paths = [sources.result_path(settings.results, rule["rule_id"], run) for run, status in ended if status == "Success"]
        return ended, sorted((row.RULE_RUN_ID, int(row.COL1)) for row in sources.read_results(spark, paths).collect())

    add.state, add.follow = state, follow
    return add


def test_each_batch_is_a_run(spark, items, settings, write):  # noqa: F811
    rule = program(spark, "even", write("even.sql", TEXT))
    items(1, 2, 3, 4)
    assert items.follow(rule, settings) == ([("run_even-0", "Success")], [("run_even-0", 2), ("run_even-0", 4)])
    items(6)
    items(8)
    ended, rows = items.follow(rule, settings)
    assert [status for _, status in ended] == ["Success"] * 3 and [number for _, number in rows] == [2, 4, 6, 8]
    commits = items.state.removeprefix("file:") + "/commits"
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")  # the last batch is tried again
    assert items.follow(rule, settings) == (ended, rows)


def test_a_batch_that_fails_stands_alone(spark, items, settings, write):  # noqa: F811
    rule = program(spark, "even", write("even.sql", TEXT.replace("id % 2 = 0", "10 / (id - 3) > 0")))
    items(1, 2, 4, 5)
    items(3)
    items(7)
    ended, rows = items.follow(rule, settings)
    assert [status for _, status in ended] == ["Success", "Failure", "Success"] and [number for _, number in rows] == [4, 5, 7]

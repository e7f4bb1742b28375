"""Verdicts and latest rows that follow a ledger, batch by batch."""

import glob

import pytest
from pyspark.sql import functions as F
from rows import at, feed_map, ledger

from rulespark import operators as op
from rulespark import streaming

RULES = [(f"g{n % 3}" if n < 9 else None, f"r{n}") for n in range(12)] + [("g0", "r1"), ("empty", "never")]


def dated(rows):
    return rows.withColumn("created_dt", F.col("created_dt").cast("timestamp"))


def part(spark, number):
    """Rows that change what rules count for: failures, exceptions, successes, and an older row that changes nothing."""
    statuses = ["Failure", "Success", "Started", "Failure"]
    return ledger(spark, *[
        (f"r{(n * 5 + number) % 14}", f"b{number}_{n}", statuses[(n + number) % 4], "Yes" if (n * number) % 3 == 1 else "No",
         "Passive" if n == 3 else "Active", at(10 + number, n) if (n, number) != (2, 4) else None) for n in range(7)])


@pytest.fixture
def grown(spark, folder):
    path = folder("ledger")

    def grow(number):
        dated(part(spark, number)).coalesce(1).write.mode("append").parquet(path)
        return spark.read.parquet(path), spark.readStream.schema(dated(part(spark, 0)).schema).parquet(path)

    return grow


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("group_by", [("grp",), ()])
def test_verdict_after_every_batch(spark, grown, folder, group_by):
    """And after a restart: each batch is a query of its own; folded at every third."""
    given = spark.createDataFrame(RULES, "grp string, rule_id string")
    mappings = feed_map(spark, *[(f"r{n}", "F", "Yes" if n % 2 else "No") for n in range(10)])
    verdicts, state = folder("verdicts"), folder("state")
    assert streaming.read_verdicts(spark, given, verdicts, group_by).where("NOT passes").count() == 0
    seen = set()
    for number in range(6):
        whole, stream = grown(number)
        streaming.write_verdicts(stream, given, mappings, verdicts, state, group_by, fold=3, availableNow=True).awaitTermination()
        expected = op.verdict(given, op.categorize(op.latest_status(whole), mappings), group_by=group_by)
        found = streaming.read_verdicts(spark, given, verdicts, group_by, fold=3)
        assert rows(found.select(expected.columns)) == rows(expected)
        seen.add(tuple(rows(expected)))
    assert len(seen) > 3
    kept = [name for name in glob.glob(f"{verdicts.removeprefix('file:')}/changes/batch=*")]
    assert len(kept) < 6


def test_a_batch_tried_again_gives_the_same(spark, folder):
    """Its files are there, its commit is not: the stream runs it again."""
    import os

    given = spark.createDataFrame(RULES, "grp string, rule_id string")
    path, verdicts, state = folder("ledger"), folder("verdicts"), folder("state")
    for number in range(3):
        dated(part(spark, number)).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(dated(part(spark, 0)).schema).parquet(path)
        streaming.write_verdicts(stream, given, feed_map(spark), verdicts, state, ("grp",), fold=2, availableNow=True).awaitTermination()
    before = rows(streaming.read_verdicts(spark, given, verdicts, ("grp",), fold=2))
    commits = state.removeprefix("file:") + "/commits"
    for name in ("2", ".2.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    streaming.write_verdicts(stream, given, feed_map(spark), verdicts, state, ("grp",), fold=2, availableNow=True).awaitTermination()
    assert rows(streaming.read_verdicts(spark, given, verdicts, ("grp",), fold=2)) == before


def test_latest_rows_are_folded(spark, grown, folder):
    latest, state = folder("latest"), folder("state")
    for number in range(6):
        whole, stream = grown(number)
        streaming.write_latest(stream, latest, state, fold=2, availableNow=True).awaitTermination()
        found = streaming.read_latest(spark, latest, fold=2)
        assert rows(found) == rows(op.latest_status(whole).select(found.columns))
    assert len(glob.glob(f"{latest.removeprefix('file:')}/batch=*")) <= 4

"""Column expressions beside those that Spark has."""

import itertools

from pyspark.sql import functions as F

from rulespark import functions as fn

LONGS = [0, 1, -1, None, 2**63 - 1, -(2**63), 2**63 - 2, 1 - 2**63, 2**62, 3_037_000_500]
PAIRS = {
    "bigint": LONGS, "int": [0, 1, -1, None, 2**31 - 1, -(2**31)], "tinyint": [0, 1, None, 127, -128],
    "double": [0.0, 1e300, -1e308, 1.5, None, 1e308],
}


def test_overflow_as_null_is_what_spark_tries(spark):
    for one, other in itertools.product(PAIRS, PAIRS):
        rows = spark.createDataFrame(list(itertools.product(PAIRS[one], PAIRS[other])), f"a {one}, b {other}")
        tried = rows.select(*[of("a", "b") for of in (F.try_add, F.try_subtract, F.try_multiply)])
        found = rows.select(*[of("a", "b", on_overflow="null") for of in (fn.add, fn.subtract, fn.multiply)])
        assert [kind for _, kind in found.dtypes] == [kind for _, kind in tried.dtypes]
        assert [tuple(row) for row in found.collect()] == [tuple(row) for row in tried.collect()]


def test_no_try_for_a_sum_that_overflows(spark):
    """Whether it fits is known before it is tried, as an error for each row takes most of the time."""
    plan = spark.range(9).select(F.col("id"), F.lit(2**63 - 1).alias("huge")).repartition(2).select(fn.add("huge", "id", on_overflow="null").alias("sum"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in text and "decimal(19,0)" in text and "typeof" not in text


def test_dates_are_only_tried(spark):
    row = spark.sql("SELECT DATE '2024-01-31' AS day, 1 AS n").select(fn.add("day", "n", on_overflow="null").cast("string")).first()
    assert row[0] == "2024-02-01"

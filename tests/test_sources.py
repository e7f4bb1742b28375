import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rulespark import find_table, read_config, table_columns, table_format, work_folder
from rulespark import sources
from rulespark.model import STATUS_COLUMNS


def test_format_defaults_to_parquet_and_is_upper_cased():
    assert table_format({"kind": {}}) == "PARQUET"
    assert table_format({"kind": {"RAW": "csv"}}) == "CSV"


@pytest.mark.parametrize("name", ["DELTA", "AVRO", "nonsense"])
def test_missing_format_package_is_named(spark, name):
    with pytest.raises(RuntimeError, match=f"'{name}' needs its package"):
        sources.read_table(spark, name, "/nowhere")


def test_missing_path_is_sparks_own_error(spark):
    for name in ("PARQUET", "ORC"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            sources.read_table(spark, name, "/nowhere")


def test_first_table_of_a_name_wins():
    config = {"tables": [{"logicalName": "t", "path": "1"}, {"logicalName": "t", "path": "2"}]}
    assert find_table(config, "t")["path"] == "1"
    assert find_table(config, "u") is None
    assert find_table({}, "t") is None


def test_dictionary_columns():
    columns = [{"name": "a", "dataType": "date"}]
    dictionary = {"tables": [{"logicalName": "t", "schema": {"RAW": columns}}, {"logicalName": "bare"}]}
    assert table_columns(dictionary, "t") == columns
    assert table_columns(dictionary, "bare") == []
    assert table_columns(dictionary, "other") == []
    with pytest.raises(ValueError, match="without a name"):
        table_columns({"tables": [{"logicalName": "t", "schema": {"RAW": [{"dataType": "date"}]}}]}, "t")


def test_read_config(tmp_path):
    path = tmp_path / "data.json"
    path.write_text(json.dumps({"tables": []}))
    assert read_config(path) == {"tables": []}
    path.write_text("{")
    with pytest.raises(json.JSONDecodeError):
        read_config(path)
    with pytest.raises(FileNotFoundError):
        read_config(tmp_path / "absent.json")


def test_csv_columns_are_strings_until_cast(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Key,amount,day\n1,2.5,2024-01-31\n,,\n")
    raw = sources.read_table(spark, "CSV", str(path))
    assert [kind for _, kind in raw.dtypes] == ["string"] * 3
    cast = sources.apply_dictionary(
        raw, [{"name": "Key", "dataType": "INTEGER"}, {"name": "amount", "dataType": "double"},
              {"name": "day", "dataType": "date"}])
    assert cast.dtypes == [("Key", "int"), ("amount", "double"), ("day", "date")]
    assert [tuple(map(str, row)) for row in cast.collect()] == [("1", "2.5", "2024-01-31"), ("None",) * 3]


def test_dictionary_skips_what_it_does_not_know(spark):
    df = spark.range(1).select(F.col("id"), F.lit("x").alias("dotted.name"), F.array("id").alias("nested"))
    columns = [{"name": "absent", "dataType": "date"}, {"name": "id", "dataType": "decimal"},
               {"name": "dotted.name", "dataType": "string"}]
    assert sources.apply_dictionary(df, columns).dtypes == df.dtypes
    assert sources.apply_dictionary(df, [{"name": "id"}]).dtypes[0] == ("id", "string")


def test_casts_of_one_column_follow_each_other(spark):
    df = spark.sql("SELECT '2.9' AS v")
    columns = [{"name": "v", "dataType": "double"}, {"name": "v", "dataType": "integer"}]
    assert sources.apply_dictionary(df, columns).first().v == 2


def test_column_that_differs_in_case_is_left_with_a_warning(spark):
    df = spark.sql("SELECT '1' AS Key")
    with pytest.warns(UserWarning, match="in case"):
        result = sources.apply_dictionary(df, [{"name": "key", "dataType": "integer"}])
    assert result.dtypes == [("Key", "string")]


def test_bad_values_fail_become_null_or_are_counted(spark):
    df = spark.sql("SELECT * FROM VALUES ('1', 'x'), ('n/a', '2'), (NULL, NULL) t(a, b)")
    columns = [{"name": "a", "dataType": "integer"}, {"name": "b", "dataType": "double"}]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.apply_dictionary(df, columns).collect()
    kept = sources.apply_dictionary(df, columns, on_bad_value="null").collect()
    assert [tuple(row) for row in kept] == [(1, None), (None, 2.0), (None, None)]
    counts = {row["column"]: row.bad_values for row in sources.count_bad_values(df, columns).collect()}
    assert counts == {"a": 1, "b": 1}
    assert sources.count_bad_values(df, []).count() == 0
    with pytest.raises(ValueError):
        sources.apply_dictionary(df, columns, on_bad_value="skip")


def test_casts_are_one_projection_and_prune_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    cast = sources.apply_dictionary(df, [{"name": name, "dataType": "string"} for name in df.columns])
    plan = cast.select("c_name")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") <= 1
    assert "ReadSchema: struct<c_name:string>" in plan


def test_first_table_that_cannot_be_read_stops_loading(spark):
    config = {"tables": [{"logicalName": "t", "path": "/nowhere", "kind": {}}]}
    with pytest.raises(AnalysisException):
        sources.load_tables(spark, config, {})


def test_known_schemas_give_the_same_tables(spark, folder):
    path = folder("csv")
    spark.range(5).select(F.col("id").cast("string"), F.lit("x").alias("v")).write.option("header", True).csv(path)
    config = {"tables": [{"logicalName": "t", "path": path, "kind": {"RAW": "csv"}}]}
    known = {}
    sources.load_tables(spark, config, {}, schemas=known)
    first, second = (sources.load_tables(spark, config, {}, schemas=schemas)["t"] for schemas in (None, known))
    assert first.schema == second.schema
    assert sorted(first.collect()) == sorted(second.collect())


def test_bound_names(spark):
    row = sources.execute_query(spark, "SELECT :a AS a, ':a' AS quoted", {"a": "it's"}).first()
    assert tuple(row) == ("it's", ":a")
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        sources.execute_query(spark, "SELECT :a").collect()


def test_bound_query_leaves_no_views(spark):
    config = {"tables": [{"logicalName": "only_there", "path": "/root/testdata/sf0.001/nation.parquet", "kind": {}}]}
    result = sources.execute_query(spark, "SELECT * FROM only_there WHERE n_nationkey = :k", {"k": 3}, config)
    assert result.count() == 1
    assert sources.optional_table(spark, "only_there") is None


def test_database_without_a_driver_says_so(spark):
    with pytest.raises(Exception, match="No suitable driver"):
        sources.read_database(spark, "jdbc:nosuch:x", "t")
    with pytest.raises(Exception, match="No suitable driver"):
        sources.write_database(spark.range(1), "jdbc:nosuch:x", "t")


def test_result_path_needs_plain_names():
    assert sources.result_path("/base/", "R1", "run_1") == "/base/R1/run_1"
    for bad in ("", "a/b", "..", "."):
        with pytest.raises(ValueError):
            sources.result_path("/base", bad, "run_1")
        with pytest.raises(ValueError):
            sources.result_path("/base", "R1", bad)


def test_results_are_replaced_by_a_second_attempt(spark, folder):
    base = folder("results")
    rows = spark.sql("SELECT 'r' RULE_RUN_ID, 'i' RULE_ID, 'h' HEADER_DATA, 'a' COL1, 'b' COL2, 'c' COL3")
    for _ in range(2):
        path = sources.write_results(rows, base, "i", "r")
    assert sources.read_results(spark, [path]).count() == 1
    assert sources.read_results(spark, []).count() == 0


def test_result_rows_from_maps(spark, folder):
    path = folder("rows")
    entries = spark.createDataFrame(
        [("r1", "i", {"header_data": "h", "col1": None}), ("r2", "i", {})],
        "rule_run_id string, rule_id string, data map<string,string>")
    sources.append_results(entries, path)
    sources.append_results(entries, path)
    rows = sorted(tuple(map(str, row)) for row in sources.read_results(spark, [path]).collect())
    assert rows == [("r1", "i", "h", "None", "", "")] * 2 + [("r2", "i", "", "", "", "")] * 2


def test_shared_folder_comes_from_the_session(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark, "x") != work_folder(spark, "x")


def _dated(spark, *times):
    rows = spark.createDataFrame([(str(n), time) for n, time in enumerate(times)], "rule_id string, created_dt timestamp")
    return rows.select("*", *[F.lit("").alias(name) for name in STATUS_COLUMNS if name != "rule_id"])


def test_ledger_is_read_from_a_time_on(spark, folder):
    path, far = folder("ledger"), datetime(2100, 1, 1)
    for times in ([datetime(2024, 3, 1, 23, 59), datetime(2024, 3, 2), far], [datetime(2024, 3, 5)], [None, datetime(2024, 3, 1)]):
        sources.append_status(_dated(spark, *times).coalesce(2), path)
    assert sources.read_ledger(spark, path).count() == 6
    recent = sources.read_ledger(spark, path, since=datetime(2024, 3, 2, 0, 0, 1))
    assert sorted(map(str, (row.created_dt for row in recent.collect()))) == ["2024-03-05 00:00:00", "2100-01-01 00:00:00", "None"]
    later = sources.read_ledger(spark, path, since=datetime(2099, 1, 1))
    assert sorted(str(row.created_dt) for row in later.collect()) == ["2100-01-01 00:00:00", "None"]
    opened = later.inputFiles()
    assert 0 < len(opened) <= 4 and all("last_day=2100-01-01" in name or "last_day=__HIVE" in name for name in opened)
    assert len(sources.read_ledger(spark, path).inputFiles()) > len(opened)
    assert sources.read_ledger(spark, path).schema == recent.schema
    empty = folder("ledger")
    sources.append_status(_dated(spark, far).limit(0), empty)
    assert sources.read_ledger(spark, empty, far).schema.names == recent.schema.names


def test_an_append_is_a_file_per_task(spark, folder):
    """However many days its rows are of; the day's folder is that of the append or later."""
    from datetime import timedelta

    path = folder("ledger")
    rows = _dated(spark, *(datetime(2001, 1, 1) + timedelta(days=day) for day in range(1000))).repartition(3)
    sources.append_status(rows, path)
    assert len(sources.read_ledger(spark, path).inputFiles()) == 3
    assert sources.read_ledger(spark, path, since=datetime(2003, 9, 26)).count() == 2


def test_an_append_is_seen_whole_or_not(spark, folder):
    """A reader in the middle of an append, and after one that fails."""
    import glob

    path = folder("ledger")
    rows = _dated(spark, datetime(2024, 1, 1))
    sources.append_status(rows, path)
    halfway = f"file:{path}" if path.startswith("/") else path
    staged = f"{halfway.removeprefix('file:')}/_staging/other"
    rows.write.parquet(staged)
    assert sources.read_ledger(spark, path).count() == 1
    bad = rows.withColumn("rule_id", F.raise_error(F.lit("breaks off")))
    with pytest.raises(Exception, match="breaks off"):
        sources.append_status(rows.union(bad).repartition(2, "rule_name"), path)
    assert sources.read_ledger(spark, path).count() == 1
    assert [name.rpartition("/")[2] for name in glob.glob(f"{path.removeprefix('file:')}/_staging/*")] == ["other"]


def test_appends_at_once(spark, folder):
    """Overlapping appends keep all rows, and a compacted ledger has them too."""
    from concurrent.futures import ThreadPoolExecutor
    from datetime import datetime

    from rulespark import operators as op
    from rulespark.model import LEDGER_SCHEMA

    path, compacted = folder("ledger"), folder("compacted")
    others = {name: F.lit("") for name in LEDGER_SCHEMA.names if name not in ("rule_id", "rule_run_id", "created_dt")}

    def append(number):
        for part in range(6):
            rows = spark.range(50).select(F.lit(str(number)).alias("rule_id"), F.concat(F.lit(f"{part}_"), "id").alias("rule_run_id"))
            sources.append_status(rows.withColumns(others).withColumn("created_dt", F.lit(datetime(2024, 1, 1 + part))), path)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(append, range(4)))
    ledger = sources.read_ledger(spark, path)
    assert ledger.select("rule_id", "rule_run_id").distinct().count() == ledger.count() == 4 * 6 * 50
    assert sources.read_ledger(spark, path, datetime(2024, 1, 5)).count() == 4 * 2 * 50
    sources.compact_ledger(spark, path, compacted)
    assert sorted(sources.read_ledger(spark, compacted).collect()) == sorted(ledger.collect())
    assert op.latest_status(ledger, run_ids=["0_1", "5_2"]).count() == 4


def test_bad_rows_are_set_aside_in_one_pass(spark, folder):
    rows = [("1", "2.5", "2024-01-31", "a"), ("x", "y", "2024-02-30", "b"), (None, None, None, None), ("3", "z", "2024-02-01", "c"), ("x", "1", None, "b")]
    frame = spark.createDataFrame(rows, "n string, amount string, day string, bad_columns string")
    types = [{"name": "n", "dataType": "integer"}, {"name": "amount", "dataType": "double"}, {"name": "day", "dataType": "date"},
             {"name": "n", "dataType": "integer"}, {"name": "absent", "dataType": "date"}]
    checked = sources.set_bad_rows_aside(frame.withColumnRenamed("bad_columns", "part"), types, folder("checked"))
    assert checked.bad_values == {"n": 2, "amount": 2, "day": 1}
    assert checked.rows == 5 == checked.rows_set_aside + checked.good.count() and checked.set_aside.count() == 3
    assert [kind for _, kind in checked.good.dtypes] == ["int", "double", "date", "string"]
    assert sorted((row.part or "", row.bad_columns) for row in checked.set_aside.collect()) == [
        ("b", ["n"]), ("b", ["n", "amount", "day"]), ("c", ["amount"])]
    assert checked.set_aside.where("part = 'c'").first()[:3] == ("3", "z", "2024-02-01")
    counted = {row.column: row.bad_values for row in sources.count_bad_values(frame, types[:3]).collect()}
    assert counted == checked.bad_values


def test_checked_tables_are_scanned_once(spark, folder, monkeypatch):
    """One job reads the table's file, that of the write."""
    path = folder("raw")
    spark.range(100).selectExpr("CASE WHEN id % 10 = 0 THEN 'x' ELSE CAST(id AS STRING) END AS n").write.parquet(path)
    frame = spark.read.parquet(path)
    tracker, before = spark.sparkContext.statusTracker(), set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    checked = sources.set_bad_rows_aside(frame, [{"name": "n", "dataType": "integer"}], folder("checked"))
    assert len(set(tracker.getJobIdsForGroup(None)) - before) == 1
    assert (checked.bad_values, checked.rows, checked.rows_set_aside, checked.good.count()) == ({"n": 10}, 100, 10, 90)


def test_nothing_to_cast_or_to_check(spark, folder):
    frame = spark.createDataFrame([("1",)], "n string")
    checked = sources.set_bad_rows_aside(frame, [], folder("checked"))
    assert (checked.bad_values, checked.rows, checked.rows_set_aside) == ({}, 1, 0) and checked.good.collect() == frame.collect()
    empty = sources.set_bad_rows_aside(frame.limit(0), [{"name": "n", "dataType": "integer"}], folder("checked"))
    assert (empty.bad_values, empty.rows, empty.good.count(), empty.set_aside.count()) == ({"n": 0}, 0, 0, 0)

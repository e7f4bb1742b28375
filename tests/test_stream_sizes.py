"""Files, batches and state of a stream grow with its rows, not what one task holds of them."""

import os

from rulespark.checks import queries


def test_files_and_batches_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    for rows, files, batches, expected in ((1000, 4, 2, 10), (1001, 6, 3, 11), (150, 4, 2, 4)):
        table = spark.range(rows)
        path, stream = queries._stream_of(spark, table, "sized", files, batches)
        written = [name for name in os.listdir(path) if name.endswith(".parquet")]
        assert len(written) == expected
        assert max(spark.read.parquet(f"{path}/{name}").count() for name in written) <= max(100, -(-rows // files)) + 8
        seen, state = [], queries.work_folder(spark, "sized-state")
        query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()
        assert len(seen) == batches and sum(seen) == rows


def test_partitions_of_state_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "STATE_ROWS", 50)
    cores = spark.sparkContext.defaultParallelism
    for rows, expected in ((100 * cores, 2 * cores), (101 * cores, 3 * cores), (50 * cores, cores), (3, cores)):
        assert int(queries._session_for(spark, spark.range(rows)).conf.get("spark.sql.shuffle.partitions")) == expected


def test_a_task_of_a_stream_takes_few_bytes(spark, setting):
    assert queries.stream_session(spark).conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    setting(spark__sql__files__maxPartitionBytes="8m")
    assert queries.stream_session(spark).conf.get("spark.sql.files.maxPartitionBytes") == "8m"

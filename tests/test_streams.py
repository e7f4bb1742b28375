import threading
import time
from datetime import timedelta

from pyspark.sql import functions as F
from rows import at, feed_map, ledger

from rulespark import operators as op
from rulespark import sources, streaming

MAPPED = [(name, "F", "Yes") for name in ("a", "b", "c")]
FIRST = [("a", "r1", "Failure", "No", "Active", at(11)), ("b", "r1", "Failure", "No", "Active", at(11)),
         ("c", "r1", "Success", "No", "Active", at(11))]


def dated(df):
    return df.withColumn("created_dt", F.col("created_dt").cast("timestamp"))


def append(spark, path, *rows):
    dated(ledger(spark, *rows)).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(dated(ledger(spark)).schema).option("maxFilesPerTrigger", 1).parquet(path)


def states(df):
    return {row.rule_id: (row.rule_run_id, row.rule_execution_status) for row in df.collect()}


def test_latest_stream_follows_the_ledger_over_restarts(spark, folder):
    path, latest, state = folder("ledger"), folder("latest"), folder("state")

    def drain():
        streaming.write_latest(stream(spark, path), latest, state, availableNow=True).awaitTermination()
        return states(streaming.read_latest(spark, latest))

    append(spark, path, *FIRST)
    append(spark, path, ("a", "r2", "Success", "No", "Active", at(10)))       # older, comes later
    assert drain()["a"] == ("r1", "Failure")
    append(spark, path, ("a", "r3", "Started", "No", "Active", at(12)), ("d", "r1", "Started", "No", "Active", None))
    assert drain() == {"a": ("r3", "Started"), "b": ("r1", "Failure"), "c": ("r1", "Success"), "d": ("r1", "Started")}
    assert drain() == states(op.latest_status(spark.read.parquet(path)))


def test_exception_stream_equals_the_batch_form_with_one_hot_rule(spark, folder):
    """A third of the ledger is one rule's."""
    start, timeout = at(12), timedelta(minutes=60)
    rows = [*FIRST, *[("a", f"h{n}", "Failure", "No" if n % 7 else "Yes", "Active", at(12, n % 60)) for n in range(1, 90)],
            *[(f"x{n}", "r1", "Failure", "No", "Active", at(11)) for n in range(60)],
            *[(f"x{n}", "r2", "Failure", "Yes", "Active", at(11 + n % 4, 30)) for n in range(60)]]
    mappings = feed_map(spark, *MAPPED, *[(f"x{n}", "F", "Yes") for n in range(60)])
    whole = ledger(spark, *rows)
    batch = {row.rule_id: row.resolved for row in op.exceptions_in_time(whole, mappings, start, timeout).collect()}

    seen = whole.where(F.col("created_dt") <= F.lit(str(start)).cast("timestamp_ntz"))
    waiting = streaming.waiting_at(op.waiting_rules(op.categorize(op.latest_status(seen), mappings)), start)
    waiting_path, path = folder("waiting"), folder("ledger")
    matches, state = folder("matches"), folder("state")
    waiting.repartition(3).write.parquet(waiting_path)
    dated(whole).repartition(3).write.parquet(path)
    waiting_rows = spark.readStream.schema(waiting.schema).option("maxFilesPerTrigger", 1).parquet(waiting_path)
    joined = streaming.exception_matches(waiting_rows, stream(spark, path), timeout)

    def drain():
        streaming.write_matches(joined, matches, state, availableNow=True).awaitTermination()
        return {row.rule_id: row.resolved for row in streaming.read_resolved(spark, matches).collect()}

    early = drain()
    assert early.items() <= batch.items() and len(early) < len(batch)
    # Rows that resolve nothing move the watermark as well.
    append(spark, path, ("z", "r9", "Success", "No", "Active", at(23)))
    spark.createDataFrame([("z", at(23), False)], waiting.schema).write.mode("append").parquet(waiting_path)
    assert drain() == batch and True in batch.values() and False in batch.values()


def test_waiting_on_a_growing_ledger(spark, folder):
    path = folder("ledger")
    append(spark, path, *FIRST)
    waiting = op.waiting_rules(op.categorize(op.latest_status(spark.read.parquet(path)), feed_map(spark, *MAPPED)))
    waiting = spark.createDataFrame([(row.rule_id,) for row in waiting.collect()], "rule_id string")

    def later():
        time.sleep(2)
        append(spark, path, ("a", "r2", "Failure", "Yes", "Active", at(12)), ("b", "r0", "Failure", "Yes", "Active", at(9)))
        time.sleep(4)
        append(spark, path, ("b", "r2", "Failure", "Yes", "Active", at(12)))

    writer = threading.Thread(target=later)
    writer.start()
    begun = time.monotonic()
    done = streaming.wait_for_exceptions(
        waiting, stream(spark, path), folder("looks"), folder("state"), timedelta(seconds=120), every=1)
    assert {row.rule_id: row.resolved for row in done.collect()} == {"a": True, "b": True}
    assert time.monotonic() - begun < 100
    writer.join()


def test_waiting_ends_at_the_timeout(spark, folder):
    path = folder("ledger")
    append(spark, path, *FIRST, ("b", "r2", "Failure", "Yes", "Active", at(12)))
    waiting = spark.createDataFrame([("a",), ("b",)], "rule_id string")
    done = streaming.wait_for_exceptions(
        waiting, stream(spark, path), folder("looks"), folder("state"), timedelta(seconds=12), every=1)
    assert {row.rule_id: row.resolved for row in done.collect()} == {"a": False, "b": True}


def test_nothing_to_wait_for(spark, folder):
    """No stream is started if no rule waits, or all have their exception already."""
    path = folder("ledger")
    append(spark, path, *FIRST)
    for rows, answer in ([], {}), ([("a", "Yes"), ("b", "Yes")], {"a": True, "b": True}):
        waiting = spark.createDataFrame(rows, "rule_id string, exception_applied string")
        begun = time.monotonic()
        done = streaming.wait_for_exceptions(
            waiting, stream(spark, path), folder("looks"), folder("state"), timedelta(hours=1), every=60)
        assert {row.rule_id: row.resolved for row in done.collect()} == answer
        assert time.monotonic() - begun < 20


def test_exception_just_before_the_end(spark, folder):
    """It comes in after the last look that the interval gives."""
    path = folder("ledger")
    append(spark, path, *FIRST)
    waiting = spark.createDataFrame([("a", "No"), ("b", "Yes"), ("c", None)], "rule_id string, exception_applied string")

    def later():
        time.sleep(12)
        append(spark, path, ("a", "r2", "Failure", "Yes", "Active", at(12)))

    writer = threading.Thread(target=later)
    writer.start()
    done = streaming.wait_for_exceptions(
        waiting, stream(spark, path), folder("looks"), folder("state"), timedelta(seconds=25), every=600)
    assert {row.rule_id: row.resolved for row in done.collect()} == {"a": True, "b": True, "c": False}
    writer.join()


def test_compacted_latest(spark, folder):
    path, latest, state, compacted = (folder(name) for name in ("ledger", "latest", "state", "compacted"))
    append(spark, path, *FIRST)
    streaming.write_latest(stream(spark, path), latest, state, availableNow=True).awaitTermination()
    streaming.compact_latest(spark, latest, compacted)
    append(spark, path, ("a", "r3", "Started", "No", "Active", at(12)))
    streaming.write_latest(stream(spark, path), compacted, state, availableNow=True).awaitTermination()
    assert states(streaming.read_latest(spark, compacted)) == {"a": ("r3", "Started"), "b": ("r1", "Failure"), "c": ("r1", "Success")}


def test_ledger_files_as_a_stream(spark, folder):
    from datetime import datetime

    from rows import catalog, rule

    path = folder("ledger")
    rules = op.with_run_ids(op.rule_rows(catalog(spark, rule("a"), rule("b"))))
    for day in (1, 2):
        sources.append_status(op.started_rows(rules, datetime(2024, 3, day)), path)
    counts = []
    for since in (None, datetime(2024, 3, 1, 23)):
        rows = sources.ledger_stream(spark, path, since)
        latest = folder("latest")
        streaming.write_latest(rows, latest, folder("state"), availableNow=True).awaitTermination()
        counts.append(states(streaming.read_latest(spark, latest)))
    assert counts[0] == counts[1] and set(counts[0]) == {"a", "b"}

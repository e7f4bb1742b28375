"""Waiting rules joined to the exceptions that come in for them."""

import time
from datetime import datetime

from pyspark.sql import functions as F

from ..model import SUCCESS, YES
from ..operators.joins import KEY
from ..session import written
from .latest import latest_updates


def waiting_at(waiting, start):
    """Waiting rules as rows for the stream: since when, and if already resolved."""
    return waiting.select(
        KEY,
        F.lit(start.isoformat(" ")).cast("timestamp").alias("started_at"),
        F.col("exception_applied").eqNullSafe(YES).alias("at_start"),
    )


def exception_matches(waiting, ledger, timeout, delay="10 minutes", salts=None, accept_success=False, ids=None):
    """Join a stream of waiting rules to the ledger's stream.

    Gives a row per exception in time, and a row without one once the watermark of
    both streams has passed a rule's deadline. ``delay`` is how late rows may come; it
    must be above zero, as a row on the watermark itself is dropped.

    The watermark is that of the slower stream. Rows that come later than ``delay``
    behind it may be dropped: exceptions of a rule that already waits, if rules that
    started much later come in before them. Where old rows may still come in, give a
    ``delay`` as long as they may be behind, or use the batch form.

    ``salts`` spreads the exceptions of one rule over that many tasks and state
    partitions, as many as the session has unless given; each waiting rule is looked
    for in all of them, so ``read_resolved`` takes a rule's rows together. With ``ids``,
    a table of the rules that wait, the state holds no exceptions of others.
    """
    salts = salts or int(ledger.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    resolving = F.col("exception_applied").eqNullSafe(YES)
    if accept_success:
        resolving = resolving | F.col("rule_execution_status").eqNullSafe(SUCCESS)
    # Every dated row moves the watermark, also those that resolve nothing. As two
    # predicates, the first would be pushed below it; a sum stays where it is.
    counts = resolving.cast("int") + F.col("created_dt").isNotNull().cast("int") == 2
    seconds = int(timeout.total_seconds())
    left = (
        waiting.withWatermark("started_at", delay)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    right = ledger.withWatermark("created_dt", delay).where(counts)
    if ids is not None:
        right = right.join(ids.select(KEY).distinct(), KEY, "left_semi")
    right = (
        right.select(
            F.col(KEY).alias("exception_rule_id"),
            F.col("created_dt").alias("excepted_at"),
            F.pmod(F.xxhash64("rule_run_id"), F.lit(salts)).cast("int").alias("exception_salt"),
        )
    )
    in_time = (
        (F.col(KEY) == F.col("exception_rule_id"))
        & (F.col("salt") == F.col("exception_salt"))
        & (F.col("excepted_at") > F.col("started_at"))
        & (F.col("excepted_at") <= F.col("started_at") + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    return left.join(right, in_time, "left_outer").select(KEY, "started_at", "at_start", "excepted_at")


def write_matches(matches, folder, checkpoint, **trigger):
    """Append the matches to files, each once; returns the running query."""
    return (
        matches.writeStream.outputMode("append")
        .format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_resolved(spark, folder):
    """One row per waiting rule that is decided so far."""
    resolved = F.bool_or(F.col("at_start") | F.col("excepted_at").isNotNull())
    return spark.read.parquet(folder).groupBy(KEY, "started_at").agg(resolved.alias("resolved"))


def wait_for_exceptions(waiting, ledger, folder, checkpoint, timeout, every=60):
    """Follow a ledger stream until all waiting rules are resolved, at most for ``timeout``.

    ``waiting`` may say by ``exception_applied`` that a rule is resolved already, as
    ``waiting_rules`` does; only for others is there a stream. It looks at once, then
    every ``every`` seconds, and a last time after the timeout, over rows dated up to
    its end. A rule is resolved once a look finds the exception on its latest row, and
    stays so. State is kept for waiting rules only.
    """
    spark = waiting.sparkSession
    flag = F.col("exception_applied").eqNullSafe(YES) if "exception_applied" in waiting.columns else F.lit(False)
    rules = written(waiting.groupBy(KEY).agg(F.bool_or(flag).alias("at_start")), "waiting-rules")
    ids = rules.where("NOT at_start").select(KEY)
    if ids.isEmpty():
        return rules.select(KEY, F.lit(True).alias("resolved"))
    looks = []

    def save(updates, batch_id):
        excepted = updates.where(F.col("newest.exception_applied") == YES)
        excepted.select(KEY).write.mode("overwrite").parquet(f"{folder}/look={batch_id}")
        looks.append(batch_id)

    def resolved():
        return spark.read.schema(f"{KEY} string").parquet(folder).select(KEY) if looks else ids.where(F.lit(False))

    end = F.lit(datetime.now() + timeout).cast(dict(ledger.dtypes)["created_dt"])
    in_time = ledger.where(F.col("created_dt").isNull() | (F.col("created_dt") <= end))

    def follow(**trigger):
        return (
            latest_updates(in_time.join(ids, KEY, "left_semi"))
            .writeStream.outputMode("update")
            .foreachBatch(save)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    def all_resolved():
        return ids.join(resolved(), KEY, "left_anti").isEmpty()

    deadline = time.monotonic() + timeout.total_seconds()
    query = follow(processingTime=f"{every} seconds")
    try:
        while not (done := bool(looks) and all_resolved()) and (left := deadline - time.monotonic()) > 0:
            seen = len(looks)
            until = time.monotonic() + min(every, left)
            while len(looks) == seen and (left := until - time.monotonic()) > 0:
                if query.awaitTermination(max(0.1, min(1, left))):
                    break
    finally:
        while query.isActive and query.status["isTriggerActive"]:  # a look that began is not broken off
            query.awaitTermination(0.2)
        query.stop()
    if not done:
        follow(availableNow=True).awaitTermination()
    flags = resolved().distinct().withColumn("found", F.lit(True))
    found = F.col("at_start") | F.coalesce("found", F.lit(False))
    return rules.join(flags, KEY, "left").select(KEY, found.alias("resolved"))

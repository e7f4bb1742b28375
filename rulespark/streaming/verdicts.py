"""The verdict over groups of rules, kept current while the ledger grows.

Each micro-batch holds the rules whose latest row has changed. What such a rule counted for
before is taken back and what it counts for now is added, group by group; so a batch costs
what has changed, and the verdict is a sum of few rows, not a pass over all rules.
"""

from pyspark.sql import functions as F

from ..operators.joins import KEY, lookup_join
from ..operators.ledger import LATEST_COLUMNS
from ..operators.verdict import categorize, counts_as_passing
from . import batches
from .latest import latest_updates

_RULES = f"{KEY} string, passing boolean, number long"


def _newest_flags(rows):
    return rows.groupBy(KEY).agg(F.max(F.struct("number", "passing")).alias("last")).select(KEY, "last.passing", "last.number")


def _summed(group_by):
    return lambda rows: rows.groupBy(*group_by).agg(F.sum("in_ledger").alias("in_ledger"), F.sum("passing").alias("passing"))


def write_verdicts(ledger, given, feed_map, folder, checkpoint, group_by=(), fold=batches.FOLD, **trigger):
    """Follow a ledger stream with the counts of each group of ``given`` rules; returns the running query.

    ``given`` and ``feed_map`` are tables that stay as they are. A batch that is tried again
    gives the same: it looks only at batches before its own, and replaces its files.
    """
    given = given.select(*group_by, KEY).distinct()

    def save(updates, batch_id):
        spark = updates.sparkSession
        latest = updates.select(KEY, *[F.col(f"newest.{name}").alias(name) for name in LATEST_COLUMNS])
        flags = categorize(latest, feed_map, latest).select(KEY, counts_as_passing().alias("passing"))
        flags = flags.withColumn("number", F.lit(batch_id).cast("long"))
        before = batches.current(spark, f"{folder}/rules", _RULES, batch_id, fold)
        if before is None:
            before = spark.createDataFrame([], _RULES)
        flags = flags.persist()
        try:
            before = _newest_flags(before.join(flags.select(KEY), KEY, "left_semi")).select(KEY, F.col("passing").alias("was"))
            change = flags.join(before, KEY, "left")
            changes = lookup_join(given, change, "inner").groupBy(*group_by).agg(
                F.count_if(F.col("was").isNull()).alias("in_ledger"),
                F.sum(F.col("passing").cast("long") - F.coalesce(F.col("was").cast("long"), F.lit(0))).alias("passing"))
            batches.save(changes.na.fill(0, ["passing"]), f"{folder}/changes", batch_id, _summed(group_by), fold)
            batches.save(flags, f"{folder}/rules", batch_id, _newest_flags, fold)
        finally:
            flags.unpersist()

    return (
        latest_updates(ledger)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_verdicts(spark, given, folder, group_by=(), fold=batches.FOLD):
    """The verdict as it is now, with the columns of ``operators.verdict``."""
    rules = given.select(*group_by, KEY).distinct()
    none = F.lit(0).cast("long")
    counts = rules.groupBy(*group_by).agg(F.count(F.lit(1)).alias("given")).select(
        *group_by, "given", none.alias("in_ledger"), none.alias("passing"))
    changes = batches.current(spark, f"{folder}/changes", counts.drop("given").schema, fold=fold)
    if changes is not None:
        counts = counts.unionByName(changes.withColumn("given", none))
    counts = counts.groupBy(*group_by).agg(*[F.sum(name).alias(name) for name in ("given", "in_ledger", "passing")])
    return counts.withColumn("passes", (F.col("in_ledger") == 0) | (F.col("passing") == F.col("given")))

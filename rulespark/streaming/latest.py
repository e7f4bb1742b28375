"""The latest status of every rule, kept current while the ledger grows."""

from pyspark.sql import functions as F

from ..operators.joins import KEY
from ..operators.ledger import LATEST_COLUMNS, newest
from . import batches


def latest_updates(ledger):
    """A stream of each rule's latest row whenever it changes (update mode).

    State is one row per rule. Each micro-batch is reduced before its shuffle.
    """
    return ledger.groupBy(KEY).agg(newest().alias("newest"))


def write_latest(ledger, folder, checkpoint, fold=batches.FOLD, **trigger):
    """Follow a ledger stream into ``folder``; returns the running query.

    A micro-batch that is tried again replaces its own files. Each ``fold``-th holds the
    newest row of every rule, and files before the last but one of those are taken away.
    """

    def save(updates, batch_id):
        batches.save(updates, folder, batch_id, _reduced, fold)

    return (
        latest_updates(ledger)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_latest(spark, folder, fold=batches.FOLD):
    """The current latest row of every rule: the newest of its updates."""
    return _reduced(_updates(spark, folder, fold)).select(
        KEY, *[F.col(f"newest.{name}").alias(name) for name in LATEST_COLUMNS]
    )


def compact_latest(spark, folder, into, fold=batches.FOLD):
    """Write one update per rule, its newest, to a new folder that a stream may go on in.

    Micro-batches that the stream writes there later come beside it. The old folder may
    go once no reader uses it.
    """
    _reduced(_updates(spark, folder, fold)).write.parquet(f"{into}/{batches.BATCH}=-1")


def _updates(spark, folder, fold):
    return batches.current(spark, folder, spark.read.parquet(folder).drop(batches.BATCH).schema, fold=fold)


def _reduced(updates):
    return updates.groupBy(KEY).agg(F.max("newest").alias("newest"))

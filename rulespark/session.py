"""Sessions: one for a user's script, one per rule, and the folder they share."""

import uuid

from pyspark.sql import SparkSession


def build_session(app_name="rulespark", master=None, **settings):
    """A session with the settings the ledger's timestamps rely on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def rule_session(spark):
    """A session whose views no other rule sees, with the same settings.

    ``newSession`` starts again from the context's settings, so those changed at
    run time (time zone, ANSI mode, shuffle partitions) are carried over.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.get(key, None) != value and session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def stream_session(spark, partitions=None):
    """A session for streams with state in as many partitions as there are cores.

    A stream keeps the number it began with, and opens every partition's state in
    every micro-batch; the number for large batch shuffles would be too many. Where the
    ledger is large, give one that keeps a partition's rows few. A task takes 32 MB of files
    unless the session says otherwise: it sorts what it reads for each rule's latest row.
    """
    session = rule_session(spark)
    if "spark.sql.files.maxPartitionBytes" not in spark.conf.getAll:
        session.conf.set("spark.sql.files.maxPartitionBytes", "32m")
    session.conf.set("spark.sql.shuffle.partitions", partitions or spark.sparkContext.defaultParallelism)
    return session


def work_folder(spark, purpose):
    """A fresh path, not yet made, in the folder that all executors share.

    It is in ``spark.checkpoint.dir``, or else beside the tables of the warehouse, unless
    that is a folder of the driver's machine which the executors of a cluster don't see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and ":" not in base.removeprefix("file:"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {base!r} is the driver's own")
    return f"{base.rstrip('/')}/rulespark/{purpose}-{uuid.uuid4().hex}"


def written(rows, purpose):
    """The rows as a table in the shared folder: computed once, and as they are now."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

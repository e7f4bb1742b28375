"""Databases over JDBC, and catalog queries with bind names."""

from ..session import rule_session
from .files import load_tables


def execute_query(spark, sql, params=None, data_config=None, dictionary=None):
    """Run a query whose ``:name`` marks are bound from ``params``.

    Names in the query are tables the session knows, or those of ``data_config``,
    which are then loaded in a session of their own.
    """
    if data_config is not None:
        spark = rule_session(spark)
        for name, table in load_tables(spark, data_config, dictionary or {}).items():
            table.createOrReplaceTempView(name)
    return spark.sql(sql, args=params or {})


def optional_table(spark, name):
    """The table, or ``None`` if there is no such table."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_database(spark, url, table, properties=None, partition_column=None, bounds=None, partitions=None,
                  fetch_size=10_000):
    """Read a table, or a query in parentheses with an alias.

    Without ``partition_column`` the database is read over one connection. With it,
    ``bounds`` and ``partitions`` split the read over executors.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_size, **(properties or {}))
    if partition_column:
        lower, upper = bounds
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                                numPartitions=partitions)
    return reader.load()


def write_database(df, url, table, properties=None, connections=16, batch_size=10_000):
    """Append rows to a table over at most ``connections`` connections.

    Each task commits its rows at once. A job that is run again appends them again, so
    load a run's saved results, by their run id, and not the program's rows.
    """
    (df.write.format("jdbc").mode("append")
       .options(url=url, dbtable=table, numPartitions=connections, batchsize=batch_size, **(properties or {}))
       .save())

"""Joining rows to a table that holds each rule id once."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "rule_id"


def id_frame(spark, ids):
    """Rule ids, each once, from a DataFrame with a rule_id column or any iterable.

    An iterable goes in as Arrow data, whose size Spark knows when it plans: few ids
    are then broadcast to the scan.
    """
    if not isinstance(ids, DataFrame):
        ids = spark.createDataFrame(pa.table({KEY: pa.array(ids, pa.string())}))
    return ids.select(KEY).distinct()


def of_ids(per_rule, ids):
    """Rows with one of the ids, of a table that was just reduced to a row per rule.

    Right above an aggregate Spark moves the ids below it if they can be broadcast; if
    not, the table is reduced before it meets them.
    """
    return per_rule.join(id_frame(per_rule.sparkSession, ids), KEY, "left_semi")


def lookup_join(rows, lookup, how):
    """Join ``rows``, where one rule may hold a large share, to ``lookup``, unique by rule.

    Adaptive execution splits an overfull partition of ``rows`` only if both inputs
    of the join are plain shuffles. A lookup fresh from a groupBy is already
    partitioned by the key, gets no shuffle of its own, and so rules the split out.
    Deriving the key again gives it one; the lookup is the smaller side. Spark still
    broadcasts it instead when its size is under the threshold.
    """
    key = F.concat(F.col(KEY), F.lit("")).cast(lookup.schema[KEY].dataType).alias(KEY)
    rest = [name for name in lookup.columns if name != KEY]
    return rows.join(lookup.select(key, *rest), KEY, how)

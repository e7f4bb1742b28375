"""The most frequent keys of a table of counts, as many as a bound allows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counts are told apart by a sixteenth of a power of two.
STEPS = 16


def _step(count):
    return F.floor(F.log2(F.col(count).cast("double")) * STEPS).cast("int")


def split(counts: DataFrame, most, count="n"):
    """The rows of the highest counts, at most ``most`` of them, and a condition for them.

    The cut is the lowest step of counts above which no more than ``most`` keys lie. The
    driver sees one row per step, about a thousand; a key below the cut has less than one in
    ``most`` of all counts, or it shares its step with keys that would be too many.
    """
    sizes = {row.step: row.keys for row in counts.groupBy(_step(count).alias("step")).agg(F.count(F.lit(1)).alias("keys")).collect()}
    total, cut = 0, max(sizes, default=0) + 1
    for step in sorted(sizes, reverse=True):
        total += sizes[step]
        if total > most:
            break
        cut = step
    condition = _step(count) >= cut
    return counts.where(condition), condition

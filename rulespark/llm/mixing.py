"""Mixing sources to target weights.

Documents get hash-random keys. Within each source they are sorted by key, in ranges of
the key space, and prefix sums of their sizes say where the source's budget ends: sums
per range first, then from range to range, then within each range. A budget above the
source's size repeats the source, whole first and then up to the cut. The document at
the cut gives the words that are left, so that a source's words equal its budget.
``mixed`` says how often and how far each document is taken; ``corpus`` gives the texts.

Ranges are leading digits of the key, so a source with a third of all rows is sorted
in as many tasks as there are ranges, and the same in every run. Only sources and
ranges, never documents, meet in one task.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import WORD_END, same, words

WEIGHTS, CAP, SEED = (1, 2, 3), 3, "mix-1"
#: Hexadecimal digits of the key that name a range: 4096 ranges for each source.
DIGITS = 3


def targets(sizes: DataFrame, weights=WEIGHTS, cap=CAP) -> DataFrame:
    """For each ``source`` with its ``source_size``: the ``target``, a share of all sizes.

    Weights go round the sources by code point, null last. No target is above ``cap``
    times its source; what is cut off is shared by weight among the others. Sources in
    order of cap to weight are filled until the next one's cap would not be reached.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    rows = rows.withColumn("most", cap * F.col("source_size"))
    filled = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum("source_size").over(everything) - before) / left)
    full = F.col("level") * F.col("weight") >= F.col("most")
    level = F.first(F.when(~full, F.col("level")), ignorenulls=True).over(everything)
    return rows.withColumn("common", level).select(
        "source", "source_size",
        F.when(full, F.col("most").cast("double")).otherwise(F.col("common") * F.col("weight")).alias("target"))


def mixed(docs: DataFrame, weights=WEIGHTS, cap=CAP, seed=SEED, digits=DIGITS, text="text", source="source",
          doc_id="doc_id") -> DataFrame:
    """Each row as the struct ``row``, with source, size, source_size, target and taken.

    Size is the number of words; null texts have none. Null is a source of its own.
    ``taken`` is the words of ``repeats`` whole copies and of the ``cut``, the first
    words of one more; it is at most ``cap`` times the size. Rows that are alike
    in id and text share a key: which of them the cut meets makes no difference.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col(doc_id).cast("string"), F.col(text)).cast("binary"))
    rows = docs.select(F.struct("*").alias("row"), F.col(source).cast("string").alias("source"),
                       F.size(words(text)).cast("long").alias("size"), key.alias("key"))
    rows = rows.withColumn("range", F.substring("key", 1, digits))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    shares = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, cap)
    ranges = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("range_size").over(ranges), F.lit(0)))
    sums = sums.alias("sums").join(shares.alias("shares"), same(F.col("sums.source"), F.col("shares.source"))).select(
        F.col("sums.source").alias("of"), F.col("range").alias("of_range"), "before", "source_size", "target")
    rows = rows.join(sums, same(F.col("source"), F.col("of")) & (F.col("range") == F.col("of_range")))
    within = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("before") + F.sum("size").over(within) - F.col("size")
    budget = F.round("target").cast("long")
    repeats = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.select("row", "source", "size", "source_size", "target", start.alias("start"), repeats.alias("repeats"),
                       (budget - repeats * F.col("source_size")).alias("rest"))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    rows = rows.withColumn("cut", cut)
    return rows.select("row", "source", "size", "source_size", "target",
                       (F.col("repeats") * F.col("size") + F.col("cut")).alias("taken"), "repeats", "cut")


def first_words(text, count):
    """The text up to the end of that many words, with its white space."""
    return F.array_join(F.slice(F.split(text, WORD_END), F.lit(1), count.cast("int")), "")


def corpus(rows: DataFrame, text="text") -> DataFrame:
    """The mix itself: from rows of ``mixed``, each copy that is taken as a row.

    ``row`` has the text of the copy, whole or its first words; ``epoch`` counts the
    copies of a row from 1. Documents of which nothing is taken, and those without
    words, give no row.
    """
    copies = F.col("repeats") + (F.col("cut") > 0).cast("long")
    copies = F.when(F.col("taken") > 0, F.sequence(F.lit(1).cast("long"), copies))
    rows = rows.select("*", F.explode(copies).alias("epoch"))
    own = F.col("row").getField(text)
    short = (F.col("epoch") > F.col("repeats")) & (F.col("cut") < F.col("size"))
    return rows.withColumn("row", F.col("row").withField(text, F.when(short, first_words(own, F.col("cut"))).otherwise(own)))

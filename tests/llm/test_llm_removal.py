"""Removal of keys that are in a later table of a filter."""

import numpy as np

from rulespark.llm import line_dedup
from rulespark.llm.cuckoo import CuckooFilter


def test_removal_takes_no_other_key():
    """Keys of one mark and bucket in two tables: either may go, the other stays."""
    numbers = np.random.default_rng(7)
    high, low = (numbers.integers(0, 1 << 63, 40_000).astype("u8") for _ in range(2))
    high &= np.uint64((15 << 48) | (1 << 48) - 1)  # few marks, so that many are shared
    held = CuckooFilter()
    for at in range(0, 40_000, 4000):
        held.insert(high[at : at + 4000], low[at : at + 4000])
    assert len(held.tables) > 1
    gone = numbers.permutation(40_000)[:20_000]
    for part in np.array_split(gone, 4):
        held.remove(high[part], low[part])
    left = np.setdiff1d(np.arange(40_000), gone)
    assert held.contains(high[left], low[left]).all()


def test_index_lets_all_frequent_lines_through(spark):
    """After many additions and removals, in shards whose filters have several tables."""
    def docs(*numbers):
        text = "\n".join(f"line {number}" for number in numbers)
        return spark.createDataFrame([(0, text), (1, text)], "doc_id long, text string")

    index = line_dedup.built(docs(*range(200)), min_docs=2, shards=2)
    for more in (range(200, 1000), range(1000, 4000)):
        index = line_dedup.changed(index, docs(*more))
    assert spark.read.parquet(index.filters).where(line_dedup._has_tables()).count() == 2
    for _ in range(2):
        less = line_dedup.changed(index, docs(*range(100, 3000, 2)), -1)
        assert spark.read.parquet(less.filters).where(line_dedup._has_tables()).count() == 0
        index = line_dedup.changed(less, docs(*range(100, 3000, 2)))
    kept = line_dedup.line_counts(docs(*range(100), *range(101, 3000, 2), *range(3000, 4000)))
    frequent = {(row.high, row.low) for row in kept.collect()}
    assert {(row.high, row.low) for row in line_dedup.frequent(spark, less).collect()} == frequent
    for row in spark.read.parquet(less.filters).collect():
        own = [key for key in frequent if key[1] % 2 == row.shard]
        high, low = (np.array([key[place] for key in own], "i8").astype("u8") for place in (0, 1))
        held = CuckooFilter.loads(bytes(row.filter))
        assert held.contains(high, low).all() and sum((table > 0).sum() for table in held.tables) == len(own)

"""Line dedup that can be added to and taken back.

What is known of lines is an index of two tables in the shared folder. ``counts`` has,
for each line key (a 128-bit hash of the stripped, lower-cased line), the exact number
of documents that hold it. ``filters`` has a cuckoo filter per shard of the keys that
enough documents hold. Adding documents counts up and puts keys that reach the bound
into their shard's filter; removing documents counts down and takes keys out again, so
an index after adding and removing equals the one before. A filter that has grown to
several tables doesn't tell which of them a key is in: on removal it is built anew from
the exact counts. Each change writes a new
version of both tables and leaves the old.

To drop lines, the keys of each document meet the filter of their shard, which lets
through the frequent ones and few others; those are checked against the exact counts.
The keys a document loses are joined to it by id. As each is frequent in itself, a
repeated or null id does no harm: every row loses just its own frequent lines.

A line in a third of all documents is one hot key. Counts are combined in each task
before the shuffle; for the filter, keys of a shard are dealt to ``SALTS`` tasks, each
with its copy; the exact check is a plain join, which Spark splits.

Null and empty texts are one empty line. Every row counts as a document.
"""

import hashlib
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..session import work_folder
from .cuckoo import SLOTS, CuckooFilter
from .text import SPACES, same

MIN_CHARS, MIN_DOCS, SHARDS, SALTS = 1, 10, 64, 16
_STRIPPED = SPACES.encode()


class LineIndex(NamedTuple):
    counts: str | None
    filters: str | None
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS
    shards: int = SHARDS


def line_keys(text, min_chars=MIN_CHARS):
    """The key of each line of UTF-8 bytes; None for lines too short to be dropped."""
    keys = []
    for line in text.lower().split(b"\n"):
        line = line.strip(_STRIPPED)
        long_enough = len(line) >= min_chars and (min_chars <= 1 or len(line.decode()) >= min_chars)
        keys.append(hashlib.blake2b(line, digest_size=16).digest() if long_enough and line else None)
    return keys


def _distinct(text, min_chars):
    return {key for key in line_keys(text or b"", min_chars) if key is not None}


def _halves(keys):
    """Keys as two columns of signed longs."""
    pairs = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _counted(min_chars):
    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            docs = {}
            for text in batch.column("body"):
                for key in _distinct(text.as_py(), min_chars):
                    docs[key] = docs.get(key, 0) + 1
            if docs:
                high, low = _halves(docs)
                yield pa.RecordBatch.from_pydict({"high": high, "low": low, "docs": np.fromiter(docs.values(), "i8")})

    return counted


def line_counts(docs: DataFrame, text="text", min_chars=MIN_CHARS) -> DataFrame:
    """Each line key as ``high`` and ``low`` with the number of ``docs`` that hold it."""
    bodies = docs.select(F.col(text).cast("binary").alias("body"))
    rows = bodies.mapInArrow(_counted(min_chars), "high long, low long, docs long")
    return rows.groupBy("high", "low").agg(F.sum("docs").alias("docs"))


def _shard(shards):
    return F.pmod(F.col("low"), F.lit(shards)).cast("int")


def _changed_filter(rows: pd.DataFrame) -> pd.DataFrame:
    held = rows["filter"].dropna()
    filter_ = CuckooFilter.loads(held.iloc[0] if len(held) else b"")
    keys = rows[rows["enters"].notna()].sort_values(["high", "low"])
    for enters, change in ((False, filter_.remove), (True, filter_.insert)):
        of = keys[keys["enters"] == enters]
        change(of["high"].to_numpy("i8").astype("u8"), of["low"].to_numpy("i8").astype("u8"))
    return pd.DataFrame({"shard": rows["shard"].iloc[:1].to_numpy(), "filter": [filter_.dumps()]})


def _has_tables():
    """Whether a filter has more than one table; its first eight bytes are the first one's buckets."""
    digits = F.concat(*(F.hex(F.substring("filter", at, 1)) for at in range(8, 0, -1)))
    return F.length("filter") > 8 + F.conv(digits, 16, 10).cast("long") * SLOTS * 2


def changed(index: LineIndex, docs: DataFrame, sign=1, text="text") -> LineIndex:
    """The index after adding the documents, or removing them where ``sign`` is -1."""
    spark = docs.sparkSession
    rows = line_counts(docs, text, index.min_chars).select(
        "high", "low", (F.col("docs") * sign).alias("docs"), F.lit(0).cast("long").alias("before"))
    if index.counts:
        old = spark.read.parquet(index.counts).where("docs > 0")
        rows = rows.unionByName(old.select("high", "low", "docs", F.col("docs").alias("before")))
        rows = rows.groupBy("high", "low").agg(F.sum("docs").alias("docs"), F.sum("before").alias("before"))
    counts, filters = work_folder(spark, "line-counts"), work_folder(spark, "line-filters")
    rows.where(f"docs > 0 OR before >= {index.min_docs}").write.parquet(counts)

    enters, was = F.col("docs") >= index.min_docs, F.col("before") >= index.min_docs
    keys = spark.read.parquet(counts).where(enters | was).withColumn("shard", _shard(index.shards))
    moves = enters != was
    if index.filters:
        held = spark.read.parquet(index.filters)
        if sign < 0:
            anew = F.broadcast(held.where(_has_tables()).select("shard", F.lit(True).alias("anew")))
            keys, held = keys.join(anew, "shard", "left"), held.join(anew, "shard", "left_anti")
            moves = F.when(F.col("anew"), enters).otherwise(moves)
    keys = keys.where(moves).select("shard", F.lit(None).cast("binary").alias("filter"), "high", "low", enters.alias("enters"))
    if index.filters:
        # no null among the hashes: pandas would turn the column into floats
        zero = F.lit(0).cast("long")
        keys = keys.unionByName(held.withColumns({"high": zero, "low": zero}), allowMissingColumns=True)
    keys.groupBy("shard").applyInPandas(_changed_filter, "shard int, filter binary").write.parquet(filters)
    return index._replace(counts=counts, filters=filters)


def built(docs: DataFrame, text="text", **options) -> LineIndex:
    """An index of the documents alone."""
    return changed(LineIndex(None, None, **options), docs, 1, text)


def frequent(spark, index: LineIndex) -> DataFrame:
    """The keys that enough documents hold, from the exact counts."""
    return spark.read.parquet(index.counts).where(F.col("docs") >= index.min_docs).select("high", "low")


def _held(min_chars):
    def held(batches):
        import pyarrow as pa

        for batch in batches:
            places, keys = [], []
            for place, text in enumerate(batch.column("body")):
                own = _distinct(text.as_py(), min_chars)
                places.extend([place] * len(own))
                keys.extend(own)
            if keys:
                high, low = _halves(keys)
                ids = batch.column("id").take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_pydict({"id": ids, "high": high, "low": low})

    return held


def _probed(batches):
    """Rows in the order of their shard, each shard led by its filter where it has one."""
    import pyarrow as pa

    shard, filter_ = None, CuckooFilter()
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        led = np.flatnonzero(batch.column("filter").is_valid().to_numpy(zero_copy_only=False))
        edges = sorted({0, len(shards), *led.tolist(), *(np.flatnonzero(np.diff(shards)) + 1).tolist()})
        kept = np.zeros(len(shards), bool)
        high = batch.column("high").fill_null(0).to_numpy().astype("u8")
        low = batch.column("low").fill_null(0).to_numpy().astype("u8")
        for begin, end in zip(edges, edges[1:]):
            if shards[begin] != shard:
                shard, filter_ = shards[begin], CuckooFilter()
            if batch.column("filter")[begin].is_valid:
                filter_ = CuckooFilter.loads(batch.column("filter")[begin].as_py())
                begin += 1
            kept[begin:end] = filter_.contains(high[begin:end], low[begin:end])
        yield batch.select(["id", "high", "low"]).filter(pa.array(kept))


def held_frequent(docs: DataFrame, index: LineIndex, doc_id="doc_id", text="text") -> DataFrame:
    """The ids with the ``keys`` of frequent lines that rows of that id hold."""
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType
    key = [StructField("high", LongType()), StructField("low", LongType())]
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("body"))
    rows = rows.mapInArrow(_held(index.min_chars), StructType([StructField("id", id_type), *key]))
    rows = rows.select(_shard(index.shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"),
                       F.lit(None).cast(BinaryType()).alias("filter"), "id", "high", "low")
    filters = spark.read.parquet(index.filters).select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "filter")
    rows = rows.unionByName(filters, allowMissingColumns=True)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "shard", "salt").sortWithinPartitions("shard", F.col("filter").isNull())
    rows = rows.mapInArrow(_probed, StructType([StructField("id", id_type), *key]))
    rows = rows.join(frequent(spark, index), ["high", "low"], "left_semi")
    return rows.groupBy("id").agg(F.collect_set(F.struct("high", "low")).alias("keys"))


def _rewritten(min_chars):
    def rewritten(batches):
        import pyarrow as pa

        for batch in batches:
            texts, lines_of, dropped_of = [], [], []
            for text, keys in zip(batch.column("body"), batch.column("keys")):
                text = text.as_py() or b""
                dropped = [(key["high"], key["low"]) for key in keys.as_py() or ()]
                dropped = {np.array(pair, "<i8").tobytes() for pair in dropped}
                lines = text.split(b"\n")
                kept = lines
                if dropped:
                    kept = [line for line, key in zip(lines, line_keys(text, min_chars)) if key not in dropped]
                texts.append(b"\n".join(kept))
                lines_of.append(len(lines))
                dropped_of.append(len(lines) - len(kept))
            columns = {name: batch.column(name) for name in batch.schema.names if name not in ("body", "keys")}
            columns |= {"body": pa.array(texts, pa.binary()), "n_lines": pa.array(lines_of, pa.int64()),
                        "n_dropped": pa.array(dropped_of, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return rewritten


def without_frequent(docs: DataFrame, index: LineIndex, carry=("doc_id",), doc_id="doc_id", text="text") -> DataFrame:
    """The carried columns, the text that is left as ``kept``, ``n_lines`` and ``n_dropped``."""
    lost = held_frequent(docs, index, doc_id, text)
    kept = [F.col(name).alias(f"kept_{place}") for place, name in enumerate(carry)]
    rows = docs.select(*kept, F.col(doc_id).alias("own_id"), F.col(text).cast("binary").alias("body"))
    rows = rows.join(lost, same(F.col("own_id"), F.col("id")), "left").drop("own_id", "id")
    fields = [field for field in rows.schema.fields if field.name not in ("body", "keys")]
    rows = rows.mapInArrow(_rewritten(index.min_chars), StructType([
        *fields, StructField("body", BinaryType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]))
    names = [F.col(f"kept_{place}").alias(name) for place, name in enumerate(carry)]
    return rows.select(*names, F.col("body").cast("string").alias("kept"), "n_lines", "n_dropped")


def deduplicated(docs: DataFrame, index: LineIndex, doc_id="doc_id", text="text") -> DataFrame:
    """The documents without their frequent lines, with all their columns."""
    others = [name for name in docs.columns if name != text]
    plain = docs.select(F.col(doc_id).alias("own_doc"), F.col(text).alias("own_text"),
                        *(F.col(name).alias(f"own_{place}") for place, name in enumerate(others)))
    carry = [name for name in plain.columns if name not in ("own_doc", "own_text")]
    rows = without_frequent(plain, index, carry, "own_doc", "own_text")
    names = dict(zip(others, carry)) | {text: "kept"}
    return rows.select(*(F.col(names[name]).alias(name) for name in docs.columns))

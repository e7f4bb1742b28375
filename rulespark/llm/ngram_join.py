"""Join of texts with equal word n-grams, by Jaccard similarity.

Texts with the same shingle set are one class representative with its number of copies.
Each representative has a label in every tree of a MinHash forest. Matched prefixes of
labels are shortened from the longest until the expected share of pairs at the threshold
that agree in some tree reaches the target recall. Prefixes that several representatives
share link them to candidate components; these are compared exactly, on whole shingle
sets, in blocks of representatives, so that no pair is ever a row.

A representative that a block links is counted there and hung on the least one it is
linked with; counts add up over blocks, and these stars give the classes. Links between
different texts are all those in a candidate component, so recall over pairs is at least
that of the forest.

Copies are collapsed before anything else, so a group of copies is one row. A prefix in
a third of all rows is combined before its shuffle and joined back by a join that Spark
splits. A component of n representatives takes n / BLOCK times n rows to compare, dealt
to as many tasks, each with two blocks.

Texts without words, null ones too, have no class and no links. Texts of fewer words
than a shingle have one shingle of them all.
"""

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from ..session import written
from .components import components
from .shingles import WORDS, min_hashes, prefix_hashes, set_digest, shingle_sets
from .text import same

THRESHOLD, TARGET_RECALL = 0.8, 0.995
TREES, LONGEST = 32, 12
BLOCK = 256


class Joined(NamedTuple):
    """Documents with the digest of their set, and its class and links by digest."""

    documents: DataFrame
    classes: DataFrame


def expected_recall(depth, trees=TREES, threshold=THRESHOLD):
    """The share of pairs at the threshold that agree on a prefix in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def prefix_depth(trees=TREES, longest=LONGEST, threshold=THRESHOLD, target=TARGET_RECALL):
    """The longest prefix that reaches the target recall."""
    depth = longest
    while depth > 1 and expected_recall(depth, trees, threshold) < target:
        depth -= 1
    return depth


def _signed(trees, depth, words):
    def signed(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets([text.as_py() or b"" for text in batch.column("body")], words)
            digests = [set_digest(hashes) for hashes in sets]
            prefixes = [prefix_hashes(min_hashes(hashes, trees * depth), trees, depth) if len(hashes) else None for hashes in sets]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "high": pa.array([digest and digest[0] for digest in digests], pa.int64()),
                "low": pa.array([digest and digest[1] for digest in digests], pa.int64()),
                "prefixes": pa.array(prefixes, pa.list_(pa.int64()))})

    return signed


def _digested(words):
    def digested(batches):
        import pyarrow as pa

        for batch in batches:
            digests = [set_digest(hashes) for hashes in shingle_sets([text.as_py() or b"" for text in batch.column("body")], words)]
            columns = {name: batch.column(name) for name in batch.schema.names}
            for place, name in enumerate(("high", "low")):
                columns[name] = pa.array([digest and digest[place] for digest in digests], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return digested


_DIGEST = [StructField("high", LongType()), StructField("low", LongType())]


def digests(docs: DataFrame, words=WORDS) -> DataFrame:
    """The rows, whose text is the binary ``body``, with ``high`` and ``low`` of their set."""
    return docs.mapInArrow(_digested(words), StructType([*docs.schema.fields, *_DIGEST]))


def _shingled(words):
    def shingled(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets([text.as_py() or b"" for text in batch.column("body")], words)
            columns = {name: batch.column(name) for name in batch.schema.names if name != "body"}
            yield pa.RecordBatch.from_pydict(columns | {"shingles": pa.array([hashes.tobytes() for hashes in sets], pa.binary())})

    return shingled


def _agreeing(sets, block, threshold):
    """For sets in two blocks, or one, a matrix of who is linked with whom."""
    sizes = np.array([len(hashes) for hashes in sets])
    owners, hashes = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    place = np.cumsum(fresh) - 1
    shared = np.bincount(place)[place] > 1
    owners, place = owners[shared], place[shared]
    place = np.cumsum(np.concatenate(([True], place[1:] != place[:-1]))) - 1 if len(place) else place
    common = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        low, high = np.searchsorted(place, (begin, begin + 4096))
        held = np.zeros((len(sets), 4096), np.float32)
        held[owners[low:high], place[low:high] - begin] = 1
        common += held @ held.T
    linked = common + 1e-6 >= threshold * (sizes[:, None] + sizes[None, :] - common)
    linked &= (block[:, None] != block[None, :]) | (len(set(block.tolist())) == 1)
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked):
    """The least place that each place is connected with."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        fresh = np.minimum(root, least)
        fresh = fresh[fresh]
        if (fresh == root).all():
            return root
        root = fresh


def _compared(threshold):
    def result(rows):
        reps, at = np.unique(np.array([row[0] for row in rows], np.int64), return_index=True)
        block = np.array([rows[place][2] for place in at])
        linked = _agreeing([np.frombuffer(rows[place][3], np.uint64) for place in at], block, threshold)
        copies = np.array([rows[place][1] for place in at], np.int64)
        some = linked.any(axis=1)
        return reps[some], (linked @ copies)[some], reps[_roots(linked)][some]

    def compared(batches):
        import pyarrow as pa

        unit, rows = None, []
        for batch in batches:
            out = []
            columns = (batch.column(name).to_pylist() for name in ("component", "one", "other", "rep", "copies", "block", "shingles"))
            for *of, rep, copies, block, shingles in zip(*columns):
                if of != unit:
                    if len(rows) > 1:
                        out.append(result(rows))
                    unit, rows = of, []
                rows.append((rep, copies, block, shingles))
            yield from _tables(pa, out)
        yield from _tables(pa, [result(rows)] if len(rows) > 1 else [])

    return compared


def _tables(pa, out):
    if out:
        names = ("rep", "links", "root")
        yield pa.RecordBatch.from_pydict({name: np.concatenate(columns) for name, columns in zip(names, zip(*out))})


def joined(docs: DataFrame, doc_id="doc_id", text="text", threshold=THRESHOLD, words=WORDS, trees=TREES, longest=LONGEST,
           target=TARGET_RECALL) -> Joined:
    """Classes of texts that links of at least ``threshold`` connect, and links per text.

    ``documents``: id, high, low for every row, null digests without words. ``classes``:
    for each digest its number of ``copies``, the ``links`` to documents with other
    texts, the least id that has it as ``first_id``, the least of its class as
    ``class_id``, and whether it is its class's ``keeper``.
    """
    spark = docs.sparkSession
    depth = prefix_depth(trees, longest, threshold, target)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("body"))
    id_field = rows.schema["id"]
    signed = written(rows.mapInArrow(_signed(trees, depth, words), StructType([
        id_field, *_DIGEST, StructField("prefixes", ArrayType(LongType()))])), "signed")
    reps = signed.where("high IS NOT NULL").groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"), F.first("prefixes").alias("prefixes"))
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")

    matched = reps.select("rep", F.explode("prefixes").alias("prefix"))
    shared = matched.groupBy("prefix").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("held")).where("held > 1")
    stars = matched.join(shared.select("prefix", "least"), "prefix").where("rep <> least").select("rep", "least")
    hung = components(stars)
    hung = hung.unionByName(hung.select(F.col("label").alias("node"), "label").distinct())
    sizes = hung.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    candidates = written(hung.join(sizes, "label").select(
        F.col("node").alias("rep"), F.col("label").alias("component"), "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")), "candidates")

    wanted = reps.select("rep", "high", "low", "first_id", "copies").join(candidates, "rep")
    bodies = digests(rows, words).alias("docs").join(wanted.alias("wanted"), (F.col("docs.high") == F.col("wanted.high")) & (
        F.col("docs.low") == F.col("wanted.low")) & same(F.col("docs.id"), F.col("wanted.first_id")))
    bodies = bodies.select("component", "blocks", "block", "rep", "copies", "body")
    fields = [field for field in bodies.schema.fields if field.name != "body"]
    sets = bodies.mapInArrow(_shingled(words), StructType([*fields, StructField("shingles", BinaryType())]))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = sets.select("component", "block", "rep", "copies", "shingles", others.alias("with"))
    units = units.select("component", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"),
                         "rep", "copies", "block", "shingles")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartition(partitions, "component", "one", "other").sortWithinPartitions("component", "one", "other")
    found = written(units.mapInArrow(_compared(threshold), "rep long, links long, root long"), "links")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(found.select("rep", "root")).select(F.col("node").alias("rep"), "label")
    classes = reps.select("rep", "high", "low", "copies", "first_id").join(links, "rep", "left").join(labels, "rep", "left")
    classes = classes.withColumn("label", F.coalesce("label", "rep")).withColumn("links", F.coalesce("links", F.lit(0)))
    keepers = classes.groupBy("label").agg(
        F.min("first_id").alias("class_id"),
        F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "rep")).alias("keeper"))
    classes = classes.join(keepers, "label").select(
        "high", "low", "copies", "links", "first_id", "class_id", (F.col("rep") == F.col("keeper.rep")).alias("keeper"))
    return Joined(signed.select("id", "high", "low"), written(classes, "classes"))


def memberships(found: Joined) -> DataFrame:
    """One row per document: ``id``, ``class_id`` and ``n_links``, copies included.

    The class id is the least id in the class, the document's own if it has no words.
    """
    rows = found.documents.join(found.classes, ["high", "low"], "left")
    own = F.col("high").isNull()
    return rows.select("id", F.when(own, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                       F.when(own, 0).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, doc_id="doc_id", text="text", **options) -> DataFrame:
    """The documents with all their columns, one for each class: that of the least id.

    Documents without words all stay.
    """
    keepers = joined(docs, doc_id, text, **options).classes.where("keeper").select(
        F.col("high").alias("of_high"), F.col("low").alias("of_low"), "first_id")
    names = [f"kept_{place}" for place in range(len(docs.columns))]
    rows = docs.select(*(F.col(name).alias(kept) for name, kept in zip(docs.columns, names)),
                       F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("body"))
    body = names[docs.columns.index(text)]
    rows = digests(rows.drop(body), options.get("words", WORDS))
    wordless = rows.where("high IS NULL")
    kept = rows.join(keepers, (F.col("high") == F.col("of_high")) & (F.col("low") == F.col("of_low")) & same(
        F.col("id"), F.col("first_id"))).dropDuplicates(["high", "low", "id"]).select(wordless.columns)
    rows = kept.unionByName(wordless).withColumn(body, F.col("body").cast("string"))
    return rows.select(*(F.col(kept).alias(name) for name, kept in zip(docs.columns, names)))

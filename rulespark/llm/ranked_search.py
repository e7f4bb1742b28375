"""Ranked lexical search by classes of equal bags of words.

Only terms that items ask for can score. Documents are reduced to those, as a vector of
term numbers with their counts, and to ``m``, which stands for their length. Documents
that agree in both score alike for every item: they are one class, found by a hash and
kept apart by the bytes of the vector. Each class is scored once against all items, tasks
keep their best classes per item, and what wins is expanded to its documents in order of
their id.

An item's best ``top`` rows lie in its best ``top`` classes, those by score and then by
their least id: every class ahead has a row ahead. And of a class at most its ``top``
least ids are wanted, which tasks select before they shuffle. So a class with a third of
all documents is scored as one row and gives each task's first few ids.

Documents are never compared with each other. What is broadcast are blocks of items, of at
most ``block_bytes`` of text each or one item; the documents pass once for each block, and
numbers over all documents are the same in each.

Null and empty texts have no terms, score nowhere and count nowhere. An item without terms
has no rows. Rows of one item id are one item, with the terms of all; null is an id. Ids
of documents are whole numbers; a null id comes after all others, and each of several rows
with one id has a rank of its own. A vocabulary that no document holds gives no rows.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .decontaminate import normalised

TOP = 50
BLOCK_BYTES = 1 << 20
#: Cells of a table of classes by items that a task holds at a time.
CELLS = 1 << 20
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Scoring:
    """The whole numbers of the formula; see ``length_norm`` and ``impacts``."""

    slope: int = 50
    unit: int = 1000
    scale: int = 1_000_000_000
    norm: int = 20

    def weight(self, n_docs, holding):
        """A term's weight, from the documents that hold it."""
        return math.floor(self.unit * math.log((2 * n_docs + 2) / (2 * holding + 1)))

    def length_norm(self, n, n_docs, n_terms):
        """A document's ``m``, as an expression of its terms and the corpus's."""
        return F.lit(100 - self.slope) + F.expr(f"({self.slope} * {n} * {n_docs}L) div {max(1, n_terms)}L")

    def impacts(self, counts, norms):
        return (self.scale * counts) // (self.unit * counts + self.norm * norms)


def _packed(words, vocabulary):
    numbers = [number for number in map(vocabulary.get, words) if number is not None]
    if not numbers:
        return None
    held, counts = np.unique(np.array(numbers, np.uint32), return_counts=True)
    return np.concatenate((held, counts.astype(np.uint32))).tobytes()


def _unpacked(vectors):
    """Row, term and count of every entry of a list of vectors."""
    if not vectors:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(vector) // 8 for vector in vectors])
    flat = [np.frombuffer(vector, np.uint32) for vector in vectors]
    terms = np.concatenate([part[: len(part) // 2] for part in flat]).astype(np.int64)
    counts = np.concatenate([part[len(part) // 2 :] for part in flat]).astype(np.int64)
    return np.repeat(np.arange(len(vectors)), sizes), terms, counts


def item_blocks(items: DataFrame, text="text", item_id="item_id", block_bytes=BLOCK_BYTES):
    """Item ids with their terms, in lists of at most ``block_bytes`` of text or of one item."""
    rows = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.col(text).alias("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    count = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    block = F.pmod(F.xxhash64("item"), F.lit(count))
    for number in range(count):
        found = {}
        for row in rows.where(block == number).collect():
            found.setdefault(row.item, set()).update(normalised(row.body.encode()))
        if any(found.values()):
            yield [(item, sorted(terms)) for item, terms in found.items() if terms]


def bags(docs: DataFrame, vocabulary, text="text", doc_id="doc_id") -> DataFrame:
    """``id``, ``n`` terms of the whole text and the ``vector`` of those in the vocabulary."""

    def reduce(batches):
        known = vocabulary.value
        for batch in batches:
            lengths, vectors = [], []
            for body in batch.column("body"):
                words = normalised((body.as_py() or "").encode())
                lengths.append(len(words))
                vectors.append(_packed(words, known))
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "n": pa.array(lengths, pa.int64()), "vector": pa.array(vectors, pa.binary())})

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("body"))
    return rows.mapInArrow(reduce, "id long, n long, vector binary")


def holding(rows: DataFrame, size) -> DataFrame:
    """For each ``term`` number below ``size`` the documents that hold it."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column("vector").drop_null().to_pylist())[1], minlength=size)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.int64()), "n": pa.array(total[terms], pa.int64())})

    rows = rows.select("vector").mapInArrow(count, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def classes(rows: DataFrame, norm) -> DataFrame:
    """Documents of equal vector and ``m`` as one row: ``number``, ``hash`` and least id."""
    rows = rows.where(F.col("vector").isNotNull()).select("id", "vector", norm.alias("m"))
    rows = rows.withColumn("hash", F.xxhash64("vector", "m"))
    # grouping compares the vectors themselves: equal hashes alone put nothing together
    found = rows.groupBy("hash", "m", "vector").agg(F.min("id").alias("least"))
    return found.select(F.monotonically_increasing_id().alias("number"), "*")


class _Best:
    """For each item the best classes so far: by score, then by the least id."""

    def __init__(self, n_items, top):
        self.top = top
        self.floor = np.ones(n_items)
        self.held = [np.zeros((3, 0), np.int64) for _ in range(n_items)]

    def add(self, scores, numbers, least):
        rows, items = np.nonzero(scores >= self.floor)
        order = np.argsort(items, kind="stable")
        rows, items = rows[order], items[order]
        for begin, end in zip(*_runs(items)):
            item, own = items[begin], rows[begin:end]
            found = np.stack((scores[own, item].astype(np.int64), least[own], numbers[own]))
            found = np.concatenate((self.held[item], found), axis=1)
            found = found[:, np.lexsort((found[2], found[1], -found[0]))[: self.top]]
            self.held[item] = found
            if found.shape[1] == self.top:
                self.floor[item] = found[0, -1]


def _runs(values):
    edges = np.flatnonzero(np.diff(values)) + 1
    starts = np.concatenate(([0], edges)) if len(values) else np.zeros(0, int)
    return starts, np.concatenate((edges, [len(values)])) if len(values) else starts


def _scores(vectors, norms, weights, postings, n_items, scoring):
    """Scores of classes by items; sums of whole numbers, exact as doubles below 2 ** 53."""
    rows, terms, counts = _unpacked(vectors)
    values = weights[terms] * scoring.impacts(counts, norms[rows])
    starts, asking = postings
    times = starts[terms + 1] - starts[terms]
    first = np.repeat(starts[terms] - np.concatenate(([0], np.cumsum(times)[:-1])), times)
    cells = np.repeat(rows, times) * n_items + asking[first + np.arange(len(first))]
    return np.bincount(cells, np.repeat(values, times), len(vectors) * n_items).reshape(len(vectors), n_items)


def best_classes(found: DataFrame, items, weights, top=TOP, scoring=Scoring()) -> DataFrame:
    """``item`` places with their best classes: ``number``, ``score``, ``least``.

    ``items`` are lists of term numbers. Each task hands on its best ``top`` for each item.
    """
    size = len(weights)
    asked = np.array([(term, item) for item, terms in enumerate(items) for term in terms], np.int64).reshape(-1, 2)
    asked = asked[np.argsort(asked[:, 0], kind="stable")]
    postings = np.searchsorted(asked[:, 0], np.arange(size + 1)), asked[:, 1]
    shared = found.sparkSession.sparkContext.broadcast((weights, postings))

    def score(batches):
        of_terms, asking = shared.value
        best, step = _Best(len(items), top), max(1, CELLS // len(items))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                least = part.column("least").fill_null(LAST).to_numpy()
                scores = _scores(part.column("vector").to_pylist(), part.column("m").to_numpy(), of_terms, asking, len(items), scoring)
                best.add(scores, part.column("number").to_numpy(), least)
        columns = np.concatenate(best.held, axis=1)
        places = np.repeat(np.arange(len(items)), [held.shape[1] for held in best.held])
        yield pa.RecordBatch.from_pydict(
            {"item": pa.array(places, pa.int64())} | {name: pa.array(column, pa.int64()) for name, column in zip(("score", "least", "number"), columns)})

    rows = found.select("number", "m", "vector", "least").mapInArrow(score, "item long, score long, least long, number long")
    return _first(rows, ["item"], [F.desc("score"), F.asc("least"), F.asc("number")], top)


def _first(rows, keys, order, top):
    """The first rows of each key. Spark selects them in each task before it shuffles."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)


def _searched(docs, block, text, doc_id, item_type, top, scoring):
    spark = docs.sparkSession
    vocabulary = {term: number for number, term in enumerate(sorted({term for _, terms in block for term in terms}))}
    rows = written(bags(docs, spark.sparkContext.broadcast(vocabulary), text, doc_id), "bags")
    corpus = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, count in holding(rows, len(vocabulary)).collect():
        weights[term] = scoring.weight(corpus.docs, count)
    norm = scoring.length_norm("n", corpus.docs, corpus.terms)
    found = written(classes(rows, norm), "bag-classes")
    best = written(best_classes(found, [[vocabulary[term] for term in terms] for _, terms in block], weights, top, scoring), "best-classes")
    wanted = found.join(best.select("number").distinct(), "number").select("number", "hash", "m", "vector")
    members = rows.where(F.col("vector").isNotNull()).select("id", "vector", norm.alias("m"))
    members = members.withColumn("hash", F.xxhash64("vector", "m")).join(wanted, ["hash", "m", "vector"])
    by_id = F.asc_nulls_last("id")
    members = _first(members.select("number", "id"), ["number"], [by_id], top).drop("rank")
    rows = best.select("item", "score", "number").join(members, "number").where(F.col("score") > 0)
    rows = _first(rows, ["item"], [F.desc("score"), by_id], top)
    names = pa.table({"place": pa.array(range(len(block)), pa.int64()), "item_id": pa.array([item for item, _ in block])})
    names = spark.createDataFrame(names).withColumn("item_id", F.col("item_id").cast(item_type))
    return rows.join(names, rows.item == names.place).select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, text="text", doc_id="doc_id", item_text="text", item_id="item_id", top=TOP,
           scoring=Scoring(), block_bytes=BLOCK_BYTES) -> DataFrame:
    """Each item's ``top`` documents of highest score: item_id, rank from 1, doc_id, score."""
    kind = items.schema[item_id].dataType.simpleString()
    blocks = item_blocks(items, item_text, item_id, block_bytes)
    found = [_searched(docs, block, text, doc_id, kind, top, scoring) for block in blocks]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows

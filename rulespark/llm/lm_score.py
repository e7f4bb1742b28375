"""Scores of whole documents by a gated recurrent language model.

Training documents are all but those that ``held_out`` names. Their words are counted
exactly, over the whole corpus. The most frequent ones are the model's words; all others,
known or not, fall into classes by their last two characters. The network (``gru``) gives
the class of each next word, and the word itself where it is a frequent one; within the
other classes words have the share of their counts plus one, with one more for a word that
training has not seen. So the probabilities of all words, and of one unseen word per class,
sum to one.

The network learns from every training document, in rounds: a round's documents are dealt
by hash, each task learns from its own, beginning with what the round before ended with,
and the models are averaged by the words they learned from. What tasks send is a model, in
blocks that are averaged by other tasks; the driver holds one model, whose size is fixed.

Counts are looked up without a hot key: the ``HOT`` most frequent words, where the mass is,
are broadcast, and of a document's other words each goes through one join, by word; none is
more frequent than one word in ``HOT``. A word of more than ``LONGEST`` characters stands in
tables by a hash of 128 bits.

Null and empty texts are the end of a text alone. A null id is the empty text to the
division into training and held out; rows are told apart by their place, so repeated ids
are rows of their own. Without training documents every word is unseen and the network
stays as it began. A document is scored in one go: state passes from its first window to
its last, so one very long text takes one task as long as it needs.
"""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..session import written
from . import frequent, gru

HOT, LONGEST = 1 << 18, 64
ROUNDS, RATES = 2, (0.01, 0.003)
#: Words that a task learns from in a round, at least; a smaller corpus is gone through again.
TASK_WORDS, LEAST_WORDS = 500_000, 300_000
#: Words that a task lays out in lanes at a time, and the lanes.
GROUP, LANES = 1 << 22, 256
BLOCKS = 64
#: Distinct words that a task counts before it hands them on.
HELD = 500_000
END = ""

#: A to Z in lower case, and every white space as a line's end.
_LOWER = bytes(byte + 32 if 0x41 <= byte <= 0x5A else 0x0A if byte == 0x20 or 0x09 <= byte <= 0x0D else byte for byte in range(256))


def words_of(text):
    """The words of a text, A to Z in lower case, with the end as an empty one."""
    words = [word for word in (text or "").encode().translate(_LOWER).decode().split("\n") if word]
    words.append(END)
    return words


def key_of(word):
    """The word, or for long ones a hash; a space tells them apart."""
    return word if len(word) <= LONGEST else f" {hashlib.blake2b(word.encode(), digest_size=16).hexdigest()}"


def tail_of(word, tails):
    return zlib.crc32(word[-2:].encode()) % tails


def held_out(doc_id="doc_id", of=7, part=2):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % of == part


def word_counts(docs: DataFrame, tails, text="text") -> DataFrame:
    """Each ``word`` of all the documents with its class among the tails and its count ``n``."""

    def handed(counts):
        return pa.RecordBatch.from_pydict({
            "word": pa.array(list(map(key_of, counts)), pa.string()), "n": pa.array(list(counts.values()), pa.int64()),
            "tail": pa.array([tail_of(word, tails) for word in counts], pa.int32())})

    def count(batches):
        counts = Counter()
        for batch in batches:
            for body in batch.column("body"):
                counts.update(words_of(body.as_py()))
                if len(counts) > HELD:
                    yield handed(counts)
                    counts = Counter()
        yield handed(counts)

    rows = docs.select(F.col(text).alias("body")).mapInArrow(count, "word string, n long, tail int")
    return rows.groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


class Words:
    """What tasks know of the corpus: the hot words in order, their counts, and the classes' sums."""

    def __init__(self, shape, hot, tail_counts, total, distinct):
        rest = hot[hot["word"] != END].sort_values(["n", "word"], ascending=[False, True])
        self.shape, self.total, self.distinct = shape, total, distinct
        self.words = [END, *rest["word"]]
        self.counts = np.concatenate((hot.loc[hot["word"] == END, "n"].to_numpy("i8")[:1], rest["n"].to_numpy("i8")))
        if len(self.counts) < len(self.words):  # no end without training documents
            self.counts = np.concatenate(([0], self.counts))
        tails = np.concatenate(([0], rest["tail"].to_numpy("i8")))
        heads = min(shape.words, len(self.words))
        self.tokens = np.where(np.arange(len(self.words)) < heads, np.arange(len(self.words)), shape.words + tails)
        of_heads = pd.DataFrame({"tail": tails[1:heads], "n": self.counts[1:heads]}).groupby("tail")["n"].agg(["sum", "count"])
        sums = tail_counts.copy()
        sums[of_heads.index, 0] -= of_heads["sum"].to_numpy("i8")
        sums[of_heads.index, 1] -= of_heads["count"].to_numpy("i8")
        #: By token, how often it occurs in training; and by tail, what a share of it is a share of.
        self.frequencies = np.concatenate((np.pad(self.counts[:heads], (0, shape.words - heads)), sums[:, 0]))
        self.tail_logs = np.log10(sums.sum(axis=1) + 1.0)

    def prepared(self):
        """The same for a task's loop: places of words, and per hot word its logarithms."""
        own = np.log10(self.counts + 1.0)
        in_tail = self.tokens >= self.shape.words
        within = np.where(in_tail, own - self.tail_logs[np.maximum(0, self.tokens - self.shape.words)], 0.0)
        return {word: at for at, word in enumerate(self.words)}, self.tokens, own, within, self.counts > 0


def learned_words(counts: DataFrame, shape, hot=HOT) -> Words:
    held, _ = frequent.split(counts, hot)
    end = counts.where(F.col("word") == END)
    held = held.where(F.col("word") != END).unionByName(end).select("word", "tail", "n").toPandas()
    sums = np.zeros((shape.tails, 2), np.int64)
    for tail, n, words in counts.where(F.col("word") != END).groupBy("tail").agg(F.sum("n"), F.count(F.lit(1))).collect():
        sums[tail] = n, words
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    return Words(shape, held, sums, *total)


def encoded(docs: DataFrame, words, text="text", carry=()) -> DataFrame:
    """Documents as ``tokens``, with the logarithms of what is known, and ``rest``, the words that aren't hot."""
    shape = words.value.shape
    kept = [F.col(name).alias(f"kept_{at}") for at, name in enumerate(carry)]
    rows = docs.select(*kept, F.col(text).alias("body"))
    fields = [field for field in rows.schema.fields if field.name != "body"]
    rest_type = ArrayType(StructType([StructField("word", StringType()), StructField("times", LongType())]))
    own = {"place": (LongType(), pa.int64()), "n_tokens": (LongType(), pa.int64()), "n_known": (LongType(), pa.int64()),
           "own_log": (DoubleType(), pa.float64()), "within_log": (DoubleType(), pa.float64()), "tokens": (BinaryType(), pa.binary())}
    schema = StructType([*fields, *(StructField(name, kind) for name, (kind, _) in own.items()), StructField("rest", rest_type)])

    def encode(batches):
        places, tokens, own_logs, within_logs, known = words.value.prepared()
        tail_logs, place = words.value.tail_logs, TaskContext.get().partitionId() << 33
        for batch in (batch for batch in batches if batch.num_rows):
            found, rest_words, rest_times, ends = [], [], [], [0]
            for body in batch.column("body"):
                text_words = words_of(body.as_py())
                at = np.array([places.get(word, -1) for word in text_words], np.int64)
                ids, hot = tokens[at], at >= 0
                missing = [text_words[index] for index in np.flatnonzero(~hot)]
                tails = np.array([tail_of(word, shape.tails) for word in missing], np.int64)
                ids[~hot] = shape.words + tails
                rest = Counter(map(key_of, missing))
                rest_words.extend(rest)
                rest_times.extend(rest.values())
                ends.append(len(rest_words))
                found.append((place, len(ids), int(known[at[hot]].sum()), float(own_logs[at[hot]].sum()),
                              float(within_logs[at[hot]].sum() - tail_logs[tails].sum()), ids.astype(np.uint16).tobytes()))
                place += 1
            columns = {name: batch.column(name) for name in batch.schema.names if name != "body"}
            columns |= {name: pa.array(column, kind) for column, (name, (_, kind)) in zip(zip(*found), own.items())}
            rest = pa.StructArray.from_arrays([pa.array(rest_words, pa.string()), pa.array(rest_times, pa.int64())], ["word", "times"])
            columns["rest"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)
            yield pa.RecordBatch.from_pydict(columns)

    return written(rows.mapInArrow(encode, schema), "encoded")


def _texts(batches):
    """Texts of tokens, in lists of about ``GROUP`` tokens or of one text."""
    texts, size = [], 0
    for batch in batches:
        for cell in batch.column("tokens"):
            texts.append(np.frombuffer(cell.as_py(), np.uint16).astype(np.int32))
            size += len(texts[-1])
            if size >= GROUP:
                yield texts
                texts, size = [], 0
    if texts:
        yield texts


def _learning(shape, model, rate, lanes, repeats):
    def learn(batches):
        groups, trainer, size = _texts(batches), gru.Trainer(shape, model.value, rate, lanes * gru.WINDOW * 3 // 4), 0
        for texts in groups if repeats == 1 else list(groups) * repeats:
            trainer.learn(texts, lanes)
            size += sum(map(len, texts))
        if size:
            blocks = np.array_split(trainer.flat, BLOCKS)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(range(BLOCKS), pa.int32()), "task": pa.array([TaskContext.get().partitionId()] * BLOCKS, pa.int32()),
                "size": pa.array([size] * BLOCKS, pa.int64()), "part": pa.array([block.tobytes() for block in blocks], pa.binary())})

    return learn


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("task")
    parts = np.stack([np.frombuffer(part, np.float32) for part in rows["part"]])
    mean = np.average(parts.astype(np.float64), axis=0, weights=rows["size"]).astype(np.float32)
    return pd.DataFrame({"block": rows["block"].iloc[:1].to_numpy(), "part": [mean.tobytes()]})


def trained(rows: DataFrame, words: Words, rounds=ROUNDS, rates=RATES, task_words=TASK_WORDS, least_words=LEAST_WORDS):
    """The network's numbers after all rounds over ``tokens`` of training documents."""
    spark, shape = rows.sparkSession, words.shape
    flat = gru.started(shape, words.frequencies)
    per_round = words.total // rounds
    tasks = max(1, min(rows.rdd.getNumPartitions(), per_round // task_words))
    repeats = max(1, -(-least_words // max(1, per_round)))
    lanes = int(np.clip(per_round // tasks // 512, 8, LANES))
    for number in range(rounds):
        model = spark.sparkContext.broadcast(flat)
        part = rows.where(F.pmod(F.xxhash64("place"), F.lit(rounds)) == number).select("tokens").coalesce(tasks)
        part = part.mapInArrow(_learning(shape, model, rates[number], lanes, repeats), "block int, task int, size long, part binary")
        found = {row.block: row.part for row in part.groupBy("block").applyInPandas(_averaged, "block int, part binary").collect()}
        if found:
            flat = np.concatenate([np.frombuffer(found[block], np.float32) for block in range(BLOCKS)])
        model.unpersist()
    return flat


def network_scored(rows: DataFrame, shape, flat) -> DataFrame:
    """Rows with ``network_log``, the decimal logarithm that the network gives their tokens."""
    model = rows.sparkSession.sparkContext.broadcast(flat)

    def score(batches):
        for batch in batches:
            totals = [gru.log_likelihoods(shape, model.value, texts, LANES) for texts in _texts([batch])]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "tokens"}
            columns["network_log"] = pa.array(np.concatenate(totals) / np.log(10) if totals else [], pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    fields = [field for field in rows.schema.fields if field.name != "tokens"]
    return rows.mapInArrow(score, StructType([*fields, StructField("network_log", DoubleType())]))


def scored(docs: DataFrame, text="text", doc_id="doc_id", held=None, shape=gru.Shape(), hot=HOT, **training) -> DataFrame:
    """Every row with its base and network scores, decimal logarithms of the whole text.

    ``held`` is a condition on ``docs`` for rows that nothing is learned from. ``own_id`` is
    the id; n_known counts tokens that occur in training, train_tokens all of training's.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("own_id"), F.col(text).alias("own_text"), (held_out(doc_id) if held is None else held).alias("held_out"))
    counts = written(word_counts(docs.where(~F.col("held_out")), shape.tails, "own_text"), "word-counts")
    words = learned_words(counts, shape, hot)
    shared = spark.sparkContext.broadcast(words)
    rows = encoded(docs, shared, "own_text", ["own_id", "held_out"])
    flat = trained(rows.where("NOT kept_1"), words, **training)
    rest = rows.select("place", F.explode("rest").alias("word")).select("place", "word.word", "word.times")
    rest = rest.join(counts.select("word", "n"), "word", "left").groupBy("place").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more_log"))
    found = network_scored(rows.drop("rest"), shape, flat).join(rest, "place", "left")
    more, whole = F.coalesce("more_log", F.lit(0.0)), float(np.log10(words.total + words.distinct + 1))
    return found.select(
        F.col("kept_0").alias("own_id"), F.col("kept_1").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("own_log") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("network_log") + F.col("within_log") + more).alias("score"))

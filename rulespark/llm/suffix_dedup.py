"""Removal of long passages that occur before, by run-length indexes of what recurs.

A passage is a string of ``length`` bytes; each byte of one that starts earlier too is
removed. Texts are put in order once, in blocks of a few megabytes, as a table in the
shared folder that is bucketed by block, so that later steps read it without a shuffle.

1. Each block cuts its windows into runs that share an anchor (``passages``), and sends
   two hashes for each distinct run, dealt by anchor. What comes back says whether an
   equal run is in an earlier block, and whether other runs have its anchor. A run whose
   anchor is nowhere else holds no passage; a run seen before is one all over.
2. For runs that differ and share an anchor, the first of each kind is sent with its
   bytes. Those of some anchors together, in the order of the texts, make a collection
   that repeats itself a lot; a run-compressed Burrows-Wheeler transform is built of it,
   the runs are streamed through it, and windows that match an earlier one are marked.
3. Blocks put the marks together and drop the bytes.

Messages between blocks and parts are packed arrays, a row for each block and part. A
block sends each hash once, whatever the number of copies, so a passage in a third of
all texts gives each part one entry per block. An anchor with more than ``FEW`` kinds of
runs in a block, or ``MANY`` in all (the edge of a passage that many texts go on from),
is one entry: its windows are dealt one by one by their own hash instead, again once per
block. Indexes are built over at most ``INDEX_BYTES``, as the runs of an anchor that is
not split so are few. Nothing is capped: both ways are exact up to 128-bit hashes.

Texts are ordered by id, null ids first, and rows with one id by their bytes. Null and
empty texts have no bytes. Repeated rows repeat each other.
"""

import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from ..session import work_folder, written
from .passages import runs_of, window_hashes, window_starts
from .run_index import RunIndex

LENGTH = 100
BLOCK_BYTES, INDEX_BYTES = 8 << 20, 1 << 20
FEW, MANY = 16, 64

EARLIER, DIFFER, SPLIT = 1, 2, 3
SENT = StructType([StructField("kind", IntegerType()), StructField("part", IntegerType()), StructField("block", LongType()),
                   StructField("packed", BinaryType())])
_SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def _cut(batches):
    """Numbers the rows of a task by block and place."""
    import pyarrow as pa

    block = place = size = 0
    for batch in batches:
        blocks, places = [], []
        for body, part in zip(batch.column("body"), batch.column("part")):
            blocks.append((part.as_py() << 32) + block)
            places.append(place)
            place += 1
            size += len(body.as_buffer()) if body.is_valid else 0
            if size >= BLOCK_BYTES:
                block, place, size = block + 1, 0, 0
        columns = {name: batch.column(name) for name in batch.schema.names if name != "part"}
        yield pa.RecordBatch.from_pydict(columns | {"block": pa.array(blocks, pa.int64()), "place": pa.array(places, pa.int64())})


def in_blocks(docs: DataFrame, doc_id="doc_id", text="text", carry=()) -> DataFrame:
    """A bucketed table of id, bytes and carried columns, in blocks that follow the order."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [F.col(name).alias(f"kept_{place}") for place, name in enumerate(carry)]
    rows = docs.select(*kept, F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))
    rows = rows.repartitionByRange(parts, "id").sortWithinPartitions("id", "body").withColumn("part", F.spark_partition_id().cast("long"))
    fields = [field for field in rows.schema.fields if field.name != "part"]
    rows = rows.mapInArrow(_cut, StructType([*fields, StructField("block", LongType()), StructField("place", LongType())]))
    name = f"blocks_{uuid.uuid4().hex}"
    rows.write.bucketBy(parts, "block").option("path", work_folder(spark, "blocks")).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


class _Block:
    """A block's bytes, its runs, and the distinct ones in the order that they are sent."""

    def __init__(self, table, length):
        table = table.sort_by("place")
        self.table, self.length = table, length
        bodies = [body.as_py() for body in table.column("body")]
        self.sizes = np.array([len(body) for body in bodies], np.int64)
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        self.runs = runs = runs_of(self.data, window_starts(self.sizes, length), length)
        order = np.lexsort((runs.whole, runs.anchor))
        anchor, whole = runs.anchor[order], runs.whole[order]
        new_anchor = np.concatenate((np.ones(min(1, len(order)), bool), anchor[1:] != anchor[:-1]))
        new = new_anchor | np.concatenate((np.ones(min(1, len(order)), bool), whole[1:] != whole[:-1]))
        first = order[new]  # of each kind the run that comes first, as equal ones stay in order
        anchor_of = np.cumsum(new_anchor)[new] - 1
        crowded = np.bincount(anchor_of)[anchor_of] > FEW if len(first) else np.zeros(0, bool)
        entry_new = ~crowded | np.concatenate((np.ones(min(1, len(first)), bool), anchor_of[1:] != anchor_of[:-1]))
        self.anchors = anchor[new][entry_new]
        self.wholes = np.where(crowded, np.uint64(0), whole[new])[entry_new]
        entry_of_kind = np.cumsum(entry_new) - 1
        kind_of_run = np.empty(len(order), np.int64)
        kind_of_run[order] = np.cumsum(new) - 1
        self.entry_of_run = entry_of_kind[kind_of_run] if len(order) else np.zeros(0, np.int64)
        self.is_first = np.zeros(len(order), bool)
        self.is_first[first] = True

    def firsts(self, codes):
        """The first runs of kinds that differ from others with their anchor, in text order."""
        return np.flatnonzero(self.is_first & (codes[self.entry_of_run] == DIFFER))

    def split_windows(self, codes):
        """Starts of the windows that are dealt one by one, and their two hashes."""
        runs = np.flatnonzero(codes[self.entry_of_run] == SPLIT)
        first, count = self.runs.first[runs], self.runs.count[runs]
        starts = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        return starts, window_hashes(self.data, first, count, self.length), np.repeat(self.runs.anchor[runs], count)

    def distinct_windows(self, codes):
        """As ``split_windows``, with the order by hash and where a new one begins in it."""
        starts, hashes, anchors = self.split_windows(codes)
        order = np.lexsort((anchors, hashes))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (anchors[order][1:] != anchors[order][:-1])
        return starts, hashes, anchors, order, new


def _parts_of(hashes, parts):
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _slices(hashes, parts):
    """For sorted hashes, each part that has any with its slice."""
    edges = np.searchsorted(_parts_of(hashes, parts), np.arange(parts + 1))
    return [(part, slice(int(low), int(high))) for part, (low, high) in enumerate(zip(edges, edges[1:])) if low < high]


def _packed(*arrays):
    return zlib.compress(b"".join(len(data).to_bytes(8, "little") + data for data in (array.tobytes() for array in arrays)), 1)


def _unpacked(data, *kinds):
    data, at, out = zlib.decompress(data), 0, []
    for kind in kinds:
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(np.frombuffer(data[at + 8 : at + 8 + size], kind))
        at += 8 + size
    return out


def _sent(rows):
    import pyarrow as pa

    names = SENT.names
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    columns = list(zip(*rows)) or [()] * 4
    return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, columns, kinds)})


def _send_runs(length, parts):
    def send(table):
        block = _Block(table, length)
        number = table.column("block")[0].as_py()
        return _sent([
            (0, part, number, _packed(block.anchors[of], block.wholes[of])) for part, of in _slices(block.anchors, parts)])

    return send


def _answers(table, kind):
    """A block's answers of one kind, put together in the order of parts."""
    rows = sorted((part.as_py(), packed.as_py()) for of, part, packed in zip(
        table.column("kind"), table.column("part"), table.column("packed")) if of.as_py() == kind)
    found = [_unpacked(packed, "u1")[0] for _, packed in rows]
    return np.concatenate(found) if found else np.zeros(0, np.uint8)


def _send_bytes(length, parts):
    def send(table, answers):
        block = _Block(table, length)
        number = table.column("block")[0].as_py()
        codes, rows = _answers(answers, 0), []
        firsts = block.firsts(codes)
        part_of = _parts_of(block.runs.anchor[firsts], parts).astype(np.int64)
        for part in np.unique(part_of).tolist():
            of = firsts[part_of == part]
            first, count = block.runs.first[of], block.runs.count[of]
            bodies = [block.data[begin : begin + many + length - 1] for begin, many in zip(first.tolist(), count.tolist())]
            rows.append((1, part, number, _packed(block.runs.anchor[of], count, np.concatenate(bodies))))
        _, hashes, anchors, order, new = block.distinct_windows(codes)
        hashes, anchors = hashes[order][new], anchors[order][new]
        rows += [(2, part, number, _packed(hashes[of], anchors[of])) for part, of in _slices(hashes, parts)]
        return _sent(rows)

    return send


def _by_part(answer):
    """Applies ``answer`` to all messages of one kind and part, sorted by block."""

    def by_part(batches):
        of, numbers, messages = None, [], []
        for batch in batches:
            for kind, part, block, packed in zip(*(batch.column(name) for name in SENT.names)):
                key = (kind.as_py(), part.as_py())
                if key != of:
                    if of:
                        yield from _sent(answer(of, numbers, messages)).to_batches()
                    of, numbers, messages = key, [], []
                numbers.append(block.as_py())
                messages.append(packed.as_py())
        if of:
            yield from _sent(answer(of, numbers, messages)).to_batches()

    return by_part


def _shared_out(of, numbers, sizes, codes):
    edges = np.cumsum([0, *sizes])
    return [(*of, number, _packed(codes[low:high])) for number, low, high in zip(numbers, edges, edges[1:])]


def _first_flags(*keys):
    """For rows in order: their sorting, and where in it a new key begins, the last key first."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    return order, new


def _compare_runs(of, numbers, messages):
    arrays = [_unpacked(message, "u8", "u8") for message in messages]
    anchors, wholes = (np.concatenate([pair[place] for pair in arrays]) for place in (0, 1))
    order, new = _first_flags(wholes, anchors)
    anchors, wholes = anchors[order], wholes[order]
    anchor_of = np.cumsum(np.concatenate(([True], anchors[1:] != anchors[:-1]))) - 1
    kinds = np.bincount(anchor_of, weights=new)
    crowded = (kinds > MANY) | (np.bincount(anchor_of, weights=wholes == 0) > 0)
    codes = np.where(new, np.where(kinds[anchor_of] > 1, DIFFER, 0), EARLIER)
    out = np.empty(len(order), np.uint8)
    out[order] = np.where(crowded[anchor_of], SPLIT, codes)
    return _shared_out(of, numbers, [len(pair[0]) for pair in arrays], out)


def _compare_windows(of, numbers, messages):
    arrays = [_unpacked(message, "u8", "u8") for message in messages]
    order, new = _first_flags(*(np.concatenate([pair[place] for pair in arrays]) for place in (1, 0)))
    out = np.empty(len(order), np.uint8)
    out[order] = np.where(new, 0, EARLIER)
    return _shared_out(of, numbers, [len(pair[0]) for pair in arrays], out)


def _matched(length):
    def matched(of, numbers, messages):
        """Indexes of the runs of some anchors at a time, each streamed through its own."""
        if of[0] == 2:
            return _compare_windows(of, numbers, messages)
        arrays = [_unpacked(message, "u8", "i8", "u1") for message in messages]
        anchors, counts, data = (np.concatenate([row[place] for row in arrays]) for place in range(3))
        sizes = counts + length - 1
        begins, marks = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint8)
        order = np.argsort(anchors, kind="stable")
        reached = np.cumsum(sizes[order])
        edge = np.flatnonzero(np.concatenate((anchors[order][1:] != anchors[order][:-1], [True]))) + 1
        low = 0
        while low < len(order):
            limit = (reached[low - 1] if low else 0) + INDEX_BYTES
            fitting = edge[(edge > low) & (reached[edge - 1] <= limit)]
            high = int(fitting[-1]) if len(fitting) else int(edge[edge > low][0])
            own = np.sort(order[low:high])  # the order of the texts
            places = np.repeat(begins[own] - np.cumsum(sizes[own]) + sizes[own], sizes[own]) + np.arange(int(sizes[own].sum()))
            into = np.repeat(marks[own] - np.cumsum(counts[own]) + counts[own], counts[own]) + np.arange(int(counts[own].sum()))
            out[into] = RunIndex(data[places], sizes[own], length).matches()
            low = high
        return _shared_out(of, numbers, [int(row[1].sum()) for row in arrays], out)

    return matched


def _remove(length, parts, carried):
    def remove(table, answers):
        import pyarrow as pa

        block = _Block(table, length)
        runs, codes = block.runs, _answers(answers, 0)
        code = codes[block.entry_of_run]
        edge = np.zeros(len(block.data) + 1, np.int32)
        over = np.flatnonzero((code == EARLIER) | (~block.is_first & (code != SPLIT)))
        np.add.at(edge, runs.first[over], 1)
        np.add.at(edge, runs.first[over] + runs.count[over] + length - 1, -1)

        firsts = block.firsts(codes)
        part_of = _parts_of(runs.anchor[firsts], parts).astype(np.int64)
        sent = firsts[np.argsort(part_of, kind="stable")]
        counts = runs.count[sent]
        starts = np.repeat(runs.first[sent] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        starts = starts[_answers(answers, 1) > 0]

        split, _, _, order, new = block.distinct_windows(codes)
        known = ~new
        known[new] = _answers(answers, 2) > 0
        for marked in (starts, split[order][known]):
            np.add.at(edge, marked, 1)
            np.add.at(edge, marked + length, -1)
        gone = np.cumsum(edge[:-1]) > 0

        bodies, removed, spans, at = [], [], [], 0
        for size in block.sizes.tolist():
            own_gone, body = gone[at : at + size], block.data[at : at + size]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], own_gone, [False])).astype(np.int8))).tolist()
            spans.append([{"start": low, "end": high} for low, high in zip(edges[::2], edges[1::2])])
            removed.append(int(own_gone.sum()))
            bodies.append(body[~own_gone].tobytes() if edges else body.tobytes())
            at += size
        columns = {name: block.table.column(name) for name in carried}
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(columns | {
            "n_bytes": pa.array(block.sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, kind), "kept": pa.array(bodies, pa.binary())})

    return remove


def without_repeats(docs: DataFrame, length=LENGTH, carry=("doc_id",), doc_id="doc_id", text="text") -> DataFrame:
    """The carried columns, ``n_bytes``, ``n_removed``, the removed ``spans`` and the bytes ``kept``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = in_blocks(docs, doc_id, text, carry)
    texts = blocks.select("block", "place", "body")

    def answered(sent, answer):
        dealt = sent.repartition(parts, "kind", "part").sortWithinPartitions("kind", "part", "block")
        return dealt.mapInArrow(_by_part(answer), SENT)

    sent = texts.groupBy("block").applyInArrow(_send_runs(length, parts), SENT)
    first = written(answered(sent, _compare_runs), "answers")
    sent = texts.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(_send_bytes(length, parts), SENT)
    answers = first.unionByName(answered(sent, _matched(length)))

    kept = [field for field in blocks.schema.fields if field.name.startswith("kept_")]
    schema = StructType([*kept, StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                         StructField("spans", _SPANS), StructField("kept", BinaryType())])
    remove = _remove(length, parts, [field.name for field in kept])
    rows = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(remove, schema)
    columns = [F.col(field.name).alias(name) for field, name in zip(kept, carry)]
    return rows.select(*columns, "n_bytes", "n_removed", "spans", "kept")

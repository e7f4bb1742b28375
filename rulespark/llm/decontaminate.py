"""Benchmark decontamination with one Aho-Corasick automaton.

Items are lower-cased to words and cut into windows of consecutive words; each window is
a pattern between spaces. A text is brought to the same form in one pass over its bytes
and scanned once. Matches are intervals of words, mapped back to offsets in the
original text only where there are any.

No row is shuffled: documents stream through tasks that hold the automaton. It grows
with the benchmark and not with the documents. Benchmarks beyond ``block_bytes`` of text
are dealt to several automata, one scan each, whose matches are put together; so what is
broadcast at once is bounded, and nothing is left out.

Null and empty texts have no words and no hits. Null item texts have no windows. An item
without an id is listed as ``null``. Each row is judged on its own, whatever its id.
"""

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

WINDOW = 10
BLOCK_BYTES = 32 << 20

#: Bytes of words as they are, A to Z in lower case, all others as spaces.
_TABLE = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A else 0x20
    for byte in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_SPANS = ArrayType(StructType([
    StructField("first", LongType()), StructField("last", LongType()), StructField("items", ArrayType(StringType()))]))


def normalised(text):
    """The words of UTF-8 bytes, lower-cased."""
    return text.translate(_TABLE).split()


def windows(words, size=WINDOW):
    """All runs of ``size`` words; the whole item if it has fewer, but some."""
    if not words:
        return []
    return [words[at : at + size] for at in range(max(1, len(words) - size + 1))]


def _pattern(words):
    return f" {b' '.join(words).decode('latin-1')} "


def _automaton(items, size):
    import ahocorasick

    found = {}
    for item, text in items:
        for window in windows(normalised(text.encode()), size):
            found.setdefault(_pattern(window), (len(window), set()))[1].add(item)
    automaton = ahocorasick.Automaton()
    for pattern, (length, ids) in found.items():
        automaton.add_word(pattern, (length, sorted(ids)))
    if found:
        automaton.make_automaton()
    return automaton if found else None


def matches(automaton, words):
    """(first word, last word, items) of every occurrence of a pattern, in order."""
    if automaton is None or not words:
        return []
    line = _pattern(words)
    found, at, spaces = [], 0, 0
    for end, (length, items) in automaton.iter(line):
        spaces += line.count(" ", at, end + 1)
        at = end + 1
        found.append((spaces - 1 - length, spaces - 2, items))
    return found


def merged(spans):
    """Sorted intervals of words that touch no other."""
    out = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def original_spans(text, spans):
    """Character offsets in the text of intervals of words."""
    data = text.encode()
    wanted = {edge for span in spans for edge in span}
    places = {number: match.span() for number, match in enumerate(_WORD.finditer(data)) if number in wanted}

    def chars(offset):
        return len(data[:offset].decode())

    return [(chars(places[first][0]), chars(places[last][1])) for first, last in spans]


def _scan(items, block, size):
    def scan(batches):
        import pyarrow as pa

        automaton = _automaton(items.value, size)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("items", pa.list_(pa.string()))]))
        for batch in batches:
            counts, found = [], []
            for text in batch.column("body"):
                words = normalised((text.as_py() or "").encode())
                counts.append(len(words))
                found.append([{"first": a, "last": b, "items": ids} for a, b, ids in matches(automaton, words)])
            columns = {name: batch.column(name) for name in batch.schema.names if name != "n_words"}
            columns |= {f"spans_{block}": pa.array(found, kind), "n_words": pa.array(counts, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return scan


def item_blocks(benchmark: DataFrame, text="text", item_id="item_id", block_bytes=BLOCK_BYTES):
    """The items as broadcasts of at most ``block_bytes`` of text each, or of one item."""
    spark = benchmark.sparkSession
    rows = benchmark.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("body"))
    total = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    if total <= block_bytes:
        return [spark.sparkContext.broadcast([tuple(row) for row in rows.collect()])]
    count = -(-2 * total // block_bytes)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(count)))
    return [
        spark.sparkContext.broadcast([tuple(row) for row in dealt.where(F.col("block") == block).drop("block").collect()])
        for block in range(count)
    ]


def scanned(docs: DataFrame, benchmark: DataFrame, text="text", size=WINDOW, carry=("doc_id",), **options) -> DataFrame:
    """The carried columns, ``body``, ``n_words`` and ``spans``: every match in words."""
    kept = [F.col(name).alias(f"kept_{place}") for place, name in enumerate(carry)]
    rows, spans = docs.select(*kept, F.col(text).alias("body")), []
    for block, items in enumerate(item_blocks(benchmark, **options)):
        spans.append(f"spans_{block}")
        fields = [field for field in rows.schema.fields if field.name != "n_words"]
        rows = rows.mapInArrow(_scan(items, block, size), StructType([
            *fields, StructField(spans[-1], _SPANS), StructField("n_words", LongType())]))
    names = [F.col(f"kept_{place}").alias(name) for place, name in enumerate(carry)]
    return rows.select(*names, "body", "n_words", F.concat(*spans).alias("spans"))


def hits(found: DataFrame) -> DataFrame:
    """What ``scanned`` returns, with ``n_hit`` words and the sorted ``items`` that occur."""
    words = F.flatten(F.transform("spans", lambda span: F.sequence(span["first"], span["last"])))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda span: span["items"]))))
    return found.withColumns({"n_hit": F.size(F.array_distinct(words)).cast("long"), "items": items})


@F.pandas_udf(ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())])))
def _located(bodies: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for body, of in zip(bodies, spans):
        whole = merged((span["first"], span["last"]) for span in of)
        out.append([{"start": a, "end": b} for a, b in original_spans(body, whole)])
    return pd.Series(out)


def located(found: DataFrame) -> DataFrame:
    """The contaminated rows of ``scanned`` with ``places``: character offsets, end excluded."""
    return found.where(F.size("spans") > 0).withColumn("places", _located("body", "spans"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text="text", **options) -> DataFrame:
    """The documents without any hit, with all their columns, whatever these are called."""
    others = [name for name in docs.columns if name != text]
    plain = docs.select(F.col(text).alias("own_text"), *(F.col(name).alias(f"own_{place}") for place, name in enumerate(others)))
    carry = [name for name in plain.columns if name != "own_text"]
    rows = scanned(plain, benchmark, "own_text", carry=carry, **options).where(F.size("spans") == 0)
    names = dict(zip(others, carry)) | {text: "body"}
    return rows.select(*(F.col(names[name]).alias(name) for name in docs.columns))

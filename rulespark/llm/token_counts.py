"""Token counts from an exact histogram of encoded lengths.

Texts are encoded once, with a public byte-level vocabulary, and counted by length.
Sums from the longest length downwards then answer, for every context limit at once,
how many documents reach it, how many tokens there are, how many are left when
documents are truncated to it, and which share of documents fits. Rows per source are
the lengths that occur, at most the longest document's tokens, however many documents
there are; counts are combined before the shuffle.

A long run of white space is taken out of the text and encoded as the piece that the
pattern would make of it: matching it there needs a stack as deep as the run is long.

Null and empty texts have no tokens. Null is a source of its own.
"""

import base64

import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Fixed value: the split into pieces that the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space that is encoded apart, where a text has so much of it in a row.
LONG_RUN = 1000
#: All of a text as one piece.
_WHOLE = r"[\s\S]+"

_ENCODINGS = {}


def _encoding(vocabulary, pattern):
    import tiktoken

    if pattern not in _ENCODINGS:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, vocabulary.splitlines())}
        _ENCODINGS[pattern] = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[pattern]


def pieces_apart(text, long_run=LONG_RUN):
    """The text in parts, and for each whether it is one piece of white space.

    The pattern ends a piece of white space at the end of the text or one character before
    other characters, and none of its pieces begins with characters of two kinds, but for one
    space. So a run can be cut out but for its last character, and what is before and after it
    gives the same pieces alone.
    """
    at = 0
    for run in regex.finditer(rf"\s{{{long_run},}}", text):
        last = run.end() if run.end() == len(text) else run.end() - 1
        yield text[at : run.start()], False
        yield text[run.start() : last], True
        at = last
    yield text[at:], False


def _token_count(text, encode, encode_piece, long_run=LONG_RUN):
    return sum(len((encode_piece if alone else encode)(part)) for part, alone in pieces_apart(text, long_run))


def length_of(spark, path, pattern=PATTERN):
    """A function from a text column to its encoded length, for the ranks file at ``path``.

    Another ``pattern`` gets texts as they are, with white space of any length. The driver reads the file, a fixed vocabulary of about a megabyte, and broadcasts it.
    """
    import pandas as pd

    with open(path, "rb") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf(LongType())
    def length(texts: pd.Series) -> pd.Series:
        encode = _encoding(vocabulary.value, pattern).encode_ordinary
        encode_piece = _encoding(vocabulary.value, _WHOLE).encode_ordinary
        if pattern != PATTERN:
            return pd.Series([len(encode(text)) if text else 0 for text in texts], dtype="int64")
        return pd.Series([_token_count(text, encode, encode_piece) if text else 0 for text in texts], dtype="int64")

    return lambda text: length(F.col(text))


def histogram(docs: DataFrame, length, text="text", by="source") -> DataFrame:
    """Documents by ``by`` and ``n_tokens``; ``length`` is what ``length_of`` returns."""
    rows = docs.select(F.col(by).alias("group"), length(text).alias("n_tokens"))
    return rows.groupBy("group", "n_tokens").agg(F.count(F.lit(1)).alias("n_docs")).withColumnRenamed("group", by)


def answers(counts: DataFrame, by="source") -> DataFrame:
    """For each length as a limit: counts at it and from it upwards, and truncated totals.

    ``docs_at_least`` and ``tokens_at_least`` are sums over that length and longer ones,
    ``tokens_truncated`` is the total when every document is cut to the limit, and
    ``share_fitting`` the part of the documents that is not cut.
    """
    rows = counts.select(F.col(by).alias("group"), "n_tokens", "n_docs")
    longest_first = Window.partitionBy("group").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy("group")
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = rows.select(
        "*", F.sum("n_docs").over(longest_first).alias("docs_at_least"), F.sum(tokens).over(longest_first).alias("tokens_at_least"),
        F.sum("n_docs").over(everything).alias("docs_total"), F.sum(tokens).over(everything).alias("tokens_total"))
    shorter = F.col("tokens_total") - F.col("tokens_at_least")
    fitting = F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")
    return rows.select(
        F.col("group").alias(by), "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "docs_total", "tokens_total",
        (shorter + F.col("n_tokens") * F.col("docs_at_least")).alias("tokens_truncated"),
        (fitting / F.col("docs_total")).alias("share_fitting"))


def truncated_totals(sums: DataFrame, limits, by="source") -> DataFrame:
    """Tokens left and documents cut for any limits, from the first length at or above each."""
    rows = sums.select("*", F.explode(F.array(*[F.lit(limit).cast("long") for limit in sorted(set(limits))])).alias("limit"))
    reached = F.when(F.col("n_tokens") >= F.col("limit"), F.struct("n_tokens", "n_docs", "docs_at_least", "tokens_at_least"))
    rows = rows.groupBy(F.col(by), "limit").agg(F.min(reached).alias("at"), F.max("tokens_total").alias("tokens_total"))
    longer = F.coalesce("at.docs_at_least", F.lit(0))
    total = F.col("tokens_total") - F.coalesce("at.tokens_at_least", F.lit(0)) + F.col("limit") * longer
    cut = longer - F.when(F.col("at.n_tokens") == F.col("limit"), F.col("at.n_docs")).otherwise(F.lit(0))
    return rows.select(by, "limit", total.alias("tokens_truncated"), cut.alias("docs_cut"))


def quantiles(sums: DataFrame, shares, by="source") -> DataFrame:
    """The smallest length that at least each share of a source's documents fits."""
    rows = sums.select("*", F.explode(F.array(*[F.lit(float(share)) for share in sorted(set(shares))])).alias("share"))
    fits = F.when(F.col("share_fitting") >= F.col("share"), F.col("n_tokens"))
    return rows.groupBy(F.col(by), "share").agg(F.min(fits).alias("n_tokens"))

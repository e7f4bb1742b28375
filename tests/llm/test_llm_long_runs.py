"""Texts with very long runs of white space."""

import random

import pytest

from conftest import SF_DIR
from rulespark.llm import queries, token_align, token_counts

RUNS = {"spaces": " " * 3_000_000, "newlines": "\n" * 3_000_000, "mixed": "".join(random.Random(1).choices(" \n\t\r ", k=3_000_000))}


def _encoders():
    with open(queries.VOCABULARY, "rb") as file:
        vocabulary = file.read()
    encode = token_counts._encoding(vocabulary, token_counts.PATTERN).encode_ordinary
    return encode, token_counts._encoding(vocabulary, token_counts._WHOLE).encode_ordinary


@pytest.mark.parametrize("long_run", [2, 3, 50])
def test_runs_apart_give_the_same_tokens(spark, long_run):
    """Also runs of two characters, in front of every kind of character and at both ends."""
    encode, encode_piece = _encoders()
    draw = random.Random(long_run)
    spaces = [" ", "\n", "\t", "\r", " ", "　", "\x85"]
    others = ["a", "é", "7", "½", "!", "'s", "'", "漢", "\x00", "\x1c", "_", "the", "I'll"]
    texts = ["".join(draw.choices(spaces * 2 + others, k=draw.randint(0, 60))) for _ in range(3000)]
    texts += [row.text or "" for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    texts += [run[:100_000] + end for run in RUNS.values() for end in ("", "x", " x", "7", "!")]
    for text in texts:
        found = [token for part, alone in token_counts.pieces_apart(text, long_run) for token in (encode_piece if alone else encode)(part)]
        assert found == encode(text)


def test_very_long_runs_are_counted(spark):
    encode, encode_piece = _encoders()
    rows = [(f"some words {run} and more of them", name) for name, run in RUNS.items()] + [(RUNS["mixed"], "alone")]
    length = token_counts.length_of(spark, queries.VOCABULARY)
    found = spark.createDataFrame(rows, "text string, name string").select("name", length("text").alias("n")).collect()
    for (text, name), row in zip(rows, sorted(found, key=lambda row: [name for _, name in rows].index(row.name))):
        assert row.n == sum(len((encode_piece if alone else encode)(part)) for part, alone in token_counts.pieces_apart(text))
        assert row.n > len(text) // 3


def test_very_long_runs_are_aligned(spark):
    a, b = token_align.byte_level_coder(queries.TOKENIZER_A), token_align.piece_coder(queries.TOKENIZER_B)
    text = "words" + "\n" * 200_000 + " " * 200_000 + "end"
    [row] = token_align.compared(spark.createDataFrame([(1, text)], "doc_id long, text string"), a, b).collect()
    assert row.n_a > 200_000 and row.n_groups > 1

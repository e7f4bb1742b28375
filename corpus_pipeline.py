"""From raw documents to a mix for training, stage by stage.

Each stage takes what the one before it has kept and returns documents with their
columns; the last one returns the mix: each copy that it takes as a row. ``corpus``
writes each stage's documents to the shared folder and reads them again, as a stage
reads its input more than once. ``run`` does the same, the mix as well, and returns what
the mix was drawn from: every document once and whole, with the words that the mix has of it.
"""

from pyspark.sql import functions as F

from rulespark.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from rulespark.llm.text import words
from rulespark.session import written


def _measured(rows):
    if "n_chars" in rows.columns:
        length = F.length("text").cast(rows.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", length)
    return rows


def quality_rules(spark, docs, sf_dir):
    """Documents that fail no rule of the current policy."""
    return quality.kept_documents(docs)


def lines(spark, docs, sf_dir):
    """All documents, without lines that ten of them or more have; n_chars follows."""
    return _measured(line_dedup.deduplicated(docs, line_dedup.built(docs)))


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near copies, that of the least id."""
    return ngram_join.one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without any window of a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mix_columns(*names):
    return "row.*", *(F.col(name).alias(f"mix_{name}") for name in names)


def mix_plan(spark, docs, sf_dir):
    """Every document, with its size and the words that the mix takes of it."""
    return mixing.mixed(docs).select(*_mix_columns("size", "source_size", "target", "taken"))


def mix(spark, docs, sf_dir):
    """Each copy that the mix takes, the document at a cut with its first words; n_chars follows.

    The mix_ columns are of the whole document, but for mix_epoch, the number of the copy.
    """
    rows = mixing.corpus(mixing.mixed(docs))
    return _measured(rows.select(*_mix_columns("size", "source_size", "target", "taken", "epoch")))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: Classes of near copies follow links of any length, and links are the forest's; the
#: pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def _ran(spark, sf_dir, stages, docs):
    for name, stage in stages:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def corpus(spark, sf_dir):
    """All stages over the documents, each over what the one before has kept."""
    return _ran(spark, sf_dir, STAGES, _documents(spark, sf_dir))


def run(spark, sf_dir):
    """All stages of ``corpus``, with the documents before the last one and what it took of each.

    ``mix_taken`` counts the words in the rows that the last stage wrote, none for a
    document that it left out; rows are told apart by a number, not by their ids.
    """
    docs = _ran(spark, sf_dir, STAGES[:-1], _documents(spark, sf_dir))
    docs = written(docs.withColumn("mix_row", F.monotonically_increasing_id()), "pipeline-numbered")
    taken = _ran(spark, sf_dir, STAGES[-1:], docs).groupBy("mix_row").agg(F.sum(F.size(words("text"))).alias("words"))
    plan = mix_plan(spark, docs, sf_dir).join(taken, "mix_row", "left")
    return plan.withColumn("mix_taken", F.coalesce("words", F.lit(0).cast("long"))).drop("mix_row", "words")

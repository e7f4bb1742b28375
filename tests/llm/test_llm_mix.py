"""The mix's own texts, not only their number of words."""

import brute
from conftest import SF_DIR
from odd import no_documents, odd_documents, odd_rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from rulespark.llm import mixing


def test_first_words(spark):
    text = " \n one  two\tthree  four\r\n"
    rows = spark.createDataFrame([(at, text) for at in range(1, 5)], "n int, text string")
    found = {row.n: row.first for row in rows.select("n", mixing.first_words(F.col("text"), F.col("n")).alias("first")).collect()}
    assert found == {1: " \n one", 2: " \n one  two", 3: " \n one  two\tthree", 4: " \n one  two\tthree  four"}


def test_corpus(spark):
    """Copies, cut and missing documents follow from what is taken; words equal the budgets."""
    texts = [(at, "\n".join(f"w{at}.{word} " for word in range(1 + at % 7)), "abc"[at % 3] if at % 5 else "d") for at in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    plan = {row.doc_id: row for row in mixing.mixed(docs).select("row.doc_id", "source", "size", "target", "taken").collect()}
    copies, sums = {}, {}
    for row in mixing.corpus(mixing.mixed(docs)).select("row.*", "epoch").orderBy("epoch").collect():
        assert texts[row.doc_id][1].startswith(row.text)
        copies.setdefault(row.doc_id, []).append((row.epoch, len(brute.WORD.findall(row.text)), row.text == texts[row.doc_id][1]))
        sums[row.source] = sums.get(row.source, 0) + copies[row.doc_id][-1][1]
    assert any(not of.taken for of in plan.values()) and any(len(of) > 1 for of in copies.values())
    for doc_id, of in plan.items():
        own = copies.get(doc_id, [])
        assert sum(words for _, words, _ in own) == of.taken and [epoch for epoch, _, _ in own] == list(range(1, len(own) + 1))
        assert all(whole for _, _, whole in own[:-1]) and all(whole == (words == of.size) for _, words, whole in own)
    assert sum(not whole for own in copies.values() for _, _, whole in own) <= len(sums)
    assert all(abs(sums[of.source] - of.target) <= 0.5 for of in plan.values())


def test_corpus_of_odd_rows(spark, odd_documents, no_documents):
    rows = mixing.corpus(mixing.mixed(odd_documents))
    taken = mixing.mixed(odd_documents).agg(F.sum("taken")).first()[0]
    assert sum(len(brute.WORD.findall(row.text)) for row in rows.select("row.text").collect()) == taken > 0
    assert mixing.corpus(mixing.mixed(no_documents)).count() == 0


def test_last_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = dict(corpus_pipeline.STAGES)["mix"](spark, docs, SF_DIR)
    assert rows.columns[:5] == docs.columns
    sums = {}
    for row in rows.collect():
        assert row.mix_taken > 0 and row.n_chars == len(row.text)
        of = sums.setdefault(row.source, [0, row.mix_target])
        of[0] += len(brute.WORD.findall(row.text))
    assert all(abs(words - target) <= 0.5 for words, target in sums.values())


def test_the_plan_counts_what_the_last_stage_wrote(spark, monkeypatch, tmp_path):
    """Rows alike in their ids stay apart, and a last stage that drops a source takes nothing of it."""
    texts = [(at // 2, " ".join(f"w{at}.{word}" for word in range(9)), "en", "abc"[at % 3], 9) for at in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-1:])
    planned = mixing.mixed(spark.read.parquet(f"{tmp_path}/documents.parquet")).select("row.text", "taken").collect()
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((row.text, row.mix_taken) for row in rows) == sorted(map(tuple, planned)) and len({row.mix_taken for row in rows}) > 1

    def without_a(spark, docs, sf_dir):
        return corpus_pipeline.mix(spark, docs, sf_dir).where("source <> 'a'")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("mix", without_a)])
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(rows) == 60 and {row.source for row in rows if row.mix_taken} == {"b", "c"}
